"""Cleaning, ordered classification, quarantine and reference checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.logic import first_match


def apply_in_sequence(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Add / overwrite columns one after another; later steps see earlier ones.

    ``withColumns`` or one ``select`` would evaluate every expression
    against the *old* columns, so the steps are chained.
    """
    for name, expr in steps:
        df = df.withColumn(name, expr)
    return df


def classify(df: DataFrame, rules: list[tuple[Column, str]], out: str,
             rewrites: list[tuple[str, Column]] | None = None) -> DataFrame:
    """Apply ``rewrites`` in order, then label rows by the first rule that holds.

    Rows no rule accepts get a missing label (quarantined by
    :func:`split_valid`).  Rule conditions are built lazily from the
    rewritten columns because callers pass ``F.col`` references.
    """
    df = apply_in_sequence(df, rewrites or [])
    return df.withColumn(out, first_match(rules))


def split_valid(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a label, quarantined rows without one)."""
    return df.where(F.col(label).isNotNull()), df.where(F.col(label).isNull())


def exclude_rows(df: DataFrame, exclusions: DataFrame, key: str) -> DataFrame:
    """Drop rows listed in an exclusion table (anti-join on ``key``)."""
    return df.join(exclusions.select(key), key, "left_anti")


def unknown_members(df: DataFrame, key: str, ref: DataFrame, ref_key: str | None = None) -> DataFrame:
    """Distinct values of ``key`` that are absent from the reference list."""
    ref_key = ref_key or key
    vals = df.select(key).where(F.col(key).isNotNull()).distinct()
    refs = ref.select(F.col(ref_key).alias(key)).where(F.col(key).isNotNull())
    return vals.join(refs, key, "left_anti")


def membership(df: DataFrame, key: str, ref: DataFrame, ref_key: str | None = None,
               out: str = "known") -> DataFrame:
    """Each distinct value of ``key`` with a flag: is it in the reference list (U4)."""
    ref_key = ref_key or key
    vals = df.select(key).where(F.col(key).isNotNull()).distinct()
    refs = (ref.select(F.col(ref_key).alias(key)).where(F.col(key).isNotNull()).distinct()
               .withColumn(out, F.lit(True)))
    return vals.join(refs, key, "left").select(key, F.coalesce(F.col(out), F.lit(False)).alias(out))


def assert_members(df: DataFrame, key: str, ref: DataFrame, ref_key: str | None = None,
                   message: str = "unknown value") -> None:
    """Stop the job when any value of ``key`` is outside the reference list.

    Only the first offending value is fetched to the driver.
    """
    bad = unknown_members(df, key, ref, ref_key).take(1)
    if bad:
        raise ValueError(f"{message}: {key}={bad[0][0]!r}")


def audited(df: DataFrame, label: str, key: str, ref: DataFrame,
            accepted: str = "accepted") -> tuple[DataFrame, dict[str, Column]]:
    """Split, audit and reference check as columns and measures of one pass.

    Returns ``df`` with the flag ``accepted`` (has a label), to be written by that
    column, and the measures of the write: number of quarantined rows, number of accepted rows whose ``key``
    the reference list lacks, and the smallest such value.
    """
    refs = ref.select(F.col(key).alias("_ref")).where(F.col("_ref").isNotNull()).distinct()
    rows = df.withColumn(accepted, F.col(label).isNotNull()).join(refs, F.col(key) == F.col("_ref"), "left")
    unknown = F.col(accepted) & F.col(key).isNotNull() & F.col("_unknown")
    rows = rows.withColumn("_unknown", F.col("_ref").isNull()).drop("_ref")
    return rows, {"quarantined": F.coalesce(F.sum((~F.col(accepted)).cast("long")), F.lit(0)),
                  "unknown": F.coalesce(F.sum(unknown.cast("long")), F.lit(0)),
                  "first_unknown": F.min(F.when(unknown, F.col(key)))}
