import tempfile

from tallyfold.plans import catalog, standins as S, workflow

from conftest import SF_SMALL, rows


def test_jobs_round_trip_equal_queries(spark):
    out = tempfile.mkdtemp(prefix="tf-wf-")
    places = S.official_places(spark, SF_SMALL)
    legacy = workflow.legacy_job(places, S.legacy_wide(spark, SF_SMALL), out + "/legacy")
    numbered = S.numbered_submissions(spark, SF_SMALL)
    paths = workflow.regional_job(None, S.exclusions(spark, SF_SMALL, numbered.select("submission_id", "n_row")), places,
                                  out + "/regional", numbered=numbered)
    got = spark.read.parquet(paths["regional_matrix"])
    assert rows(got) == rows(catalog.q_regional_matrix(spark, SF_SMALL))
    classified = spark.read.parquet(paths["classified"])
    tidy = classified.where("category is not null")
    dec = S.decisions(spark, SF_SMALL, tidy)
    local = workflow.local_job(spark, paths["classified"], dec, S.attendance(spark, SF_SMALL),
                               out + "/legacy/legacy_long", places,
                               out + "/local")
    got = spark.read.parquet(local["local_matrix"])
    assert rows(got) == rows(catalog.q_indicator_matrix(spark, SF_SMALL))
    assert legacy.count() == catalog.q_legacy_long(spark, SF_SMALL).count()
    cands = spark.read.parquet(paths["candidates"])
    assert cands.count() == catalog.q_candidates(spark, SF_SMALL).count()
