"""Invariants of the jobs on the driver tables."""

from functools import reduce

from pyspark.sql import functions as F

from tallyfold.functions.dates import month_bounds
from tallyfold.operators import quality, review
from tallyfold.plans import jobs, standins as S
from tallyfold.plans.rules import STANDIN

from conftest import SF_SMALL


def test_matrix_and_split_invariants(spark):
    classified = S.classified_submissions(spark, SF_SMALL)
    tidy, quarantine = quality.split_valid(classified, "category")
    assert tidy.count() + quarantine.count() == classified.count()
    places = S.official_places(spark, SF_SMALL)
    m = jobs.regional_matrix(tidy, places)
    assert m.count() == places.select("department").distinct().count()
    names = jobs.regional_names()
    total = m.select(reduce(lambda a, b: a + b, [F.col(c) for c in names])).groupBy().sum().first()[0]
    lo, hi = month_bounds(list(STANDIN.months))
    inside = tidy.where((F.col("event_date") >= lo) & (F.col("event_date") < hi)
                        & F.col("category").isin(list(STANDIN.regional_classes))).count()
    assert total == inside
    local = jobs.local_matrix(places, jobs.merged_facts(jobs.fanned_facts(
        jobs.at_local(tidy, S.decisions(spark, SF_SMALL, tidy)),
        jobs.attendance_long(S.attendance(spark, SF_SMALL)),
        jobs.legacy_long(places, S.legacy_wide(spark, SF_SMALL)))))
    assert local.count() == places.count()
    assert len(local.columns) == 4 + len(STANDIN.months) * len(STANDIN.local_names)


def test_decision_outputs_cover_all_decisions(spark):
    tidy = quality.split_valid(S.classified_submissions(spark, SF_SMALL), "category")[0]
    dec = S.decisions(spark, SF_SMALL, tidy)
    n_reject = dec.where("decision = 'NO'").count()
    n_keep = dec.where("decision != 'NO'").count()
    n_undecided = review.undecided(dec).count()
    assert n_reject + n_keep + n_undecided == dec.count()
    assert review.rejected_rows(tidy, dec).count() == n_reject
    assert review.accepted_codes(dec).count() <= n_keep
