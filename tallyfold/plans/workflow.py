"""The three jobs end to end, with durable hand-overs.

``legacy_job`` runs first and writes the legacy long rows.  ``regional_job``
numbers, cleans and classifies the submissions and publishes the classified
rows (the hand-over, Q10), split by the flag ``accepted``: the rows without a
class are the quarantine.  Split, counts and the check of the departments come
from that one write.  It goes on with the regional matrix and the match candidates, which
are also exported as a sheet.  A person fills in the sheet's decisions, and
``sheet_decisions`` reads them back; ``local_job`` takes the classified rows and
the decisions over and writes the rejects, the undecided rows and the local
matrix.  Sorting happens only at the sinks.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tallyfold.operators import quality, review
from tallyfold.operators.rows import number_rows
from tallyfold.plans import jobs
from tallyfold.plans.rules import STANDIN, Rules
from tallyfold.sources.handover import export_sheet, publish, read_sheet, take_over
from tallyfold.sources.io import write_table

SHEET_KEYS, SHEET_CODE = ["n_row", "ubigeo"], "ubigeo"


def legacy_job(places: DataFrame, wide: DataFrame, out_dir: str,
               rules: Rules = STANDIN) -> DataFrame:
    path = os.path.join(out_dir, "legacy_long")
    publish(jobs.legacy_long(places, wide, rules), path)
    return take_over(places.sparkSession, path, contents=False)


def regional_job(submissions: DataFrame, exclusions: DataFrame | None, places: DataFrame,
                 out_dir: str, rules: Rules = STANDIN, matcher_places: DataFrame | None = None,
                 numbered: DataFrame | None = None) -> dict[str, str]:
    """Number → exclude → clean → classify → quarantine → check → matrix → candidates.

    ``exclusions`` lists row numbers to drop (column ``n_row``).  Pass
    ``numbered`` when the rows are numbered already.
    """
    if numbered is None:
        numbered = number_rows(submissions, "submitted_at", "submission_id",
                               path=os.path.join(out_dir, "numbered"))
    kept = numbered if exclusions is None else quality.exclude_rows(numbered, exclusions, "n_row")
    classified = jobs.classified_submissions(jobs.clean_submissions(kept, rules), rules)
    spark = places.sparkSession
    paths = {k: os.path.join(out_dir, f) for k, f in {
        "classified": "classified", "regional_matrix": "regional_matrix", "candidates": "candidates",
        "review": "review.csv"}.items()}
    audited, measures = quality.audited(classified, "category", "department", places)
    audit = publish(audited, paths["classified"], ["accepted"], **measures)
    if audit["unknown"]:
        raise ValueError(f"department not in the list: department={audit['first_unknown']!r}")
    tidy = accepted_rows(spark, paths["classified"], contents=False)
    write_table(jobs.regional_matrix(tidy, places, rules).orderBy("department"), paths["regional_matrix"])
    cands = jobs.match_candidates(tidy, matcher_places if matcher_places is not None else places,
                                  rules)
    publish(cands.orderBy("n_row"), paths["candidates"])
    export_sheet(spark, paths["candidates"], paths["review"], SHEET_KEYS)
    return paths


def accepted_rows(spark: SparkSession, classified_path: str, contents: bool = True) -> DataFrame:
    """The classified rows that have a class."""
    return take_over(spark, classified_path, contents).where("accepted").drop("accepted", "_unknown")


def quarantined_rows(spark: SparkSession, classified_path: str) -> DataFrame:
    """The rows that no class rule accepted."""
    return take_over(spark, classified_path).where("not accepted").drop("accepted", "_unknown")


def sheet_decisions(spark: SparkSession, paths: dict[str, str], out_dir: str) -> DataFrame:
    """The decisions of the regional job's review sheet, after a person has edited it."""
    return read_sheet(spark, paths["candidates"], paths["review"], os.path.join(out_dir, "decisions"),
                      SHEET_KEYS, SHEET_CODE)


def local_job(spark: SparkSession, classified_path: str, decisions: DataFrame,
              attendance: DataFrame, legacy_long_path: str, places: DataFrame,
              out_dir: str, rules: Rules = STANDIN) -> dict[str, str]:
    """Decisions + attendance + legacy rows → rejects, undecided and the local matrix."""
    tidy = accepted_rows(spark, classified_path)
    write_table(review.rejected_rows(tidy, decisions), os.path.join(out_dir, "rejected"))
    write_table(review.undecided(decisions), os.path.join(out_dir, "undecided"))
    facts = jobs.merged_facts(jobs.fanned_facts(
        jobs.at_local(tidy, decisions, rules), jobs.attendance_long(attendance, rules),
        take_over(spark, legacy_long_path), rules), rules)
    write_table(jobs.local_matrix(places, facts, rules).orderBy("ubigeo"),
                os.path.join(out_dir, "local_matrix"))
    return {k: os.path.join(out_dir, k) for k in ("rejected", "undecided", "local_matrix")}
