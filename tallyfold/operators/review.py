"""Reviewer decisions on match candidates: accept / reject / override."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accepted_codes(decisions: DataFrame, row_id: str = "n_row", code: str = "ubigeo",
                   decision: str = "decision", accept: str = "OK",
                   reject: str = "NO") -> DataFrame:
    """Distinct (code, row id) pairs the reviewer kept.

    ``accept`` keeps the proposed code, any other non-reject text replaces it
    (an override).  Missing decisions are in neither this nor the rejects.
    """
    d = F.col(decision)
    return (decisions.where(d != reject)
                     .select(F.when(d == accept, F.col(code)).otherwise(d).alias(code), row_id)
                     .distinct())


def rejected_rows(rows: DataFrame, decisions: DataFrame, row_id: str = "n_row",
                  decision: str = "decision", reject: str = "NO") -> DataFrame:
    """Rows with a reject decision; a row decided twice appears twice."""
    rej = decisions.where(F.col(decision) == reject).select(row_id)
    return rows.join(rej, row_id, "inner")


def undecided(decisions: DataFrame, decision: str = "decision") -> DataFrame:
    """Candidates the reviewer left without a decision (Q4)."""
    return decisions.where(F.col(decision).isNull())
