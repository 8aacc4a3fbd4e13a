"""Legacy wide two-month matrix → long rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.logic import presence_flag


def distinct_non_null(df: DataFrame, key: str, col: str, out: str | None = None) -> DataFrame:
    """Multi-row aggregate: each distinct non-missing value of ``col`` per key,
    or one missing value when the group has none (A3)."""
    out = out or col
    pairs = df.select(key, F.col(col).alias(out)).distinct()
    none = pairs.groupBy(key).agg(F.count(out).alias("_n")).where("_n = 0").select(
        key, F.lit(None).cast(pairs.schema[out].dataType).alias(out))
    return pairs.where(F.col(out).isNotNull()).unionByName(none)


def any_present(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Per key, 1.0 when any row has the column present, else 0.0."""
    return df.groupBy(key).agg(*[F.max(presence_flag(c)).alias(c) for c in cols])


def repeats(own: Column, most: Column, label: str) -> Column:
    """How often each of a group's ``own`` distinct values appears when the group
    is stretched to ``most`` rows as a summarise would: as many values stay, a
    single one is repeated, any other number is an error."""
    return (F.when(own == most, F.lit(1).cast("long")).when(own == 1, most)
             .otherwise(F.raise_error(F.lit(f"incompatible group sizes in {label}")).cast("long")))


def legacy_wide_to_long(master: DataFrame, wide: DataFrame, key: str,
                        months: list[tuple[str, str]], name: str, placeholder: str,
                        mode_yes: str, mode_no: str) -> DataFrame:
    """Turn per-key wide month columns into long facts.

    ``months`` pairs a month key (``MMYYYY``) with the mode column of that
    month.  Keys outside the master list drop out; per key and month every
    distinct mode becomes a row (a single mode is repeated to the key's row
    count); rows without a mode are dropped and the mode is decoded
    (``1`` → ``mode_yes``, else ``mode_no``).
    """
    month = [F.struct(F.lit(fk).alias("fecha"), F.col(c).cast("string").alias("modal")) for fk, c in months]
    modes = (wide.select(key, F.explode(F.array(*month)).alias("_r")).select(key, "_r.*")
                 .where(F.col("modal").isNotNull()).distinct())
    # number of distinct modes of each month, one row per key
    sizes = modes.groupBy(key).agg(*[F.count(F.when(F.col("fecha") == fk, 1)).alias(f"_n{i}")
                                     for i, (fk, _) in enumerate(months)])
    own = F.coalesce(*[F.when(F.col("fecha") == fk, F.col(f"_n{i}")) for i, (fk, _) in enumerate(months)])
    most = F.greatest(F.lit(1).cast("long"), *[F.col(f"_n{i}") for i in range(len(months))])
    kept = (modes.join(sizes, key).join(master.select(key), key)
                 .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), repeats(own, most, key)))))
    return kept.select(
        key, F.lit(name).alias("name"), "fecha",
        F.when((F.col("modal").try_cast("double") == 1) | (F.col("modal") == "1"),
               F.lit(mode_yes)).otherwise(F.lit(mode_no)).alias("modal"),
        F.lit(placeholder).alias("value"))
