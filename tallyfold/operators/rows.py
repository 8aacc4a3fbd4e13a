"""Row numbering and per-group row operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import scratch_path


def _join_back(df: DataFrame, per_group: DataFrame, keys: list[str],
               extra: Column | None = None, salts: int = 16) -> DataFrame:
    """Join a per-group aggregate back to its rows on the group keys.

    Keys are compared null-safely (a missing key is a group of its own) and
    renamed on the aggregate side, so the result keeps ``df``'s columns
    unambiguous.  ``extra`` may add a condition over both sides.  A group that
    holds a large share of all rows is spread over ``salts`` tasks by a hash of
    the row, with a copy of its one aggregate row for each.
    """
    tmp = [f"_gk{i}" for i in range(len(keys))]
    right = per_group.select(*[F.col(k).alias(t) for k, t in zip(keys, tmp)],
                             *[c for c in per_group.columns if c not in keys],
                             F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_gs"))
    columns = df.columns
    df = df.withColumn("_ls", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(salts)).cast("int"))
    tmp += ["_gs", "_ls"]
    cond = F.col("_ls") == F.col("_gs")
    for k, t in zip(keys, tmp):
        c = F.col(k).eqNullSafe(F.col(t))
        cond = cond & c
    if extra is not None:
        cond = cond & extra
    return df.join(right, cond, "inner").drop(*tmp)


_LAST = 2 ** 31 - 1  # the bucket of missing stamps
_CODE_BYTES = 7      # of a text id, as a number that keeps its order


def _order_code(tie_break: Column, low: Column, high: Column) -> Column:
    """A number that keeps the order of ids between ``low`` and ``high``: the first
    bytes after those that both have in common (ids compare byte by byte)."""
    low, high, text = (F.hex(c.cast("string").cast("binary")) for c in (low, high, tie_break))
    same = F.length(F.regexp_extract(F.concat(low, F.lit("/"), high), "^((?:[0-9A-F]{2})*)[0-9A-F]*/\\1", 1))
    return F.conv(F.rpad(F.substring(text, same + 1, F.lit(2 * _CODE_BYTES)), 2 * _CODE_BYTES, "0"), 16, 10).cast("long")


def _split_buckets(rows: DataFrame, buckets: list[str], stamp: str, tie_break: str, split_rows: int,
                   out: str) -> DataFrame:
    """Number the parts of buckets of more than ``split_rows`` rows, in the rows' order.

    A bucket of several stamps is cut into equal stretches of time; one of a single
    stamp into equal stretches of ids.
    """
    numeric = dict(rows.dtypes)[tie_break] in ("tinyint", "smallint", "int", "bigint")
    stats = rows.groupBy(*buckets).agg(
        F.count(F.lit(1)).alias("_n"), F.min(stamp).alias("_lo"), F.max(stamp).alias("_hi"),
        F.min(tie_break).alias("_first"), F.max(tie_break).alias("_last")).where(F.col("_n") > split_rows)
    parts = F.ceil(F.col("_n") * 2 / split_rows)
    joined = rows.join(stats, buckets, "left")

    def stretch(value: Column, low: Column, high: Column) -> Column:
        low, span = low.cast("double"), (high.cast("double") - low.cast("double") + 1)
        return F.floor((value.cast("double") - low) / span * parts)

    def micros(c: Column) -> Column:
        return F.unix_micros(c.cast("timestamp"))

    first, last, tie = F.col("_first"), F.col("_last"), F.col(tie_break)
    by_id = (stretch(tie, first, last) if numeric else
             stretch(*(_order_code(c, first, last) for c in (tie, first, last))))
    part = F.when(F.col("_n").isNull(), F.lit(0)).when(
        F.col("_lo") < F.col("_hi"), stretch(*map(micros, (F.col(stamp), F.col("_lo"), F.col("_hi"))))).otherwise(by_id)
    return joined.withColumn(out, part.cast("long")).drop("_n", "_lo", "_hi", "_first", "_last")


def number_rows(df: DataFrame, order_by: str, tie_break: str, out: str = "n_row",
                num_partitions: int | None = None, path: str | None = None,
                split_rows: int = 1 << 22) -> DataFrame:
    """Global 1..n row number in (``order_by`` nulls last, ``tie_break``) order.

    A plain ``row_number().over(Window.orderBy(...))`` moves every row into one
    partition.  Instead the rows are stored once as Parquet in ``path`` (default: a
    new folder under the shared checkpoint folder), counted by the day of their
    stamp, and each is numbered as the rows of earlier days, a prefix sum over one
    row per day, plus its rank within its day.  A day of more than ``split_rows``
    rows is first cut into stretches of time, or of ids where all its rows have one
    stamp, up to twice, so that a hot stamp is ranked by many tasks.

    Whatever ``df`` takes to compute is computed once, for the stored copy; all its
    columns come back, each row with its number.  The numbers depend only on the
    total order.  ``num_partitions`` sets the number of ranking tasks, which AQE
    chooses otherwise.
    """
    spark, columns = df.sparkSession, df.columns
    path = path or scratch_path(spark, "numbered")
    df.write.mode("overwrite").parquet(path)
    buckets = ["_b0"]
    rows = spark.read.schema(df.schema).parquet(path).withColumn("_b0", F.coalesce(
        F.datediff(F.to_date(order_by), F.lit("1970-01-01").cast("date")), F.lit(_LAST)))
    for level in ("_b1", "_b2"):
        most = rows.groupBy(*buckets).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if (most or 0) <= split_rows:
            break
        rows = _split_buckets(rows, buckets, order_by, tie_break, split_rows, level)
        buckets.append(level)
    earlier = Window.orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*buckets).agg(F.count(F.lit(1)).alias("_rows")).select(
        *buckets, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_off"))
    if num_partitions:
        rows = rows.repartition(num_partitions, *buckets)
    inside = Window.partitionBy(*buckets).orderBy(F.col(order_by).asc_nulls_last(), F.col(tie_break).asc())
    return rows.withColumn("_rank", F.row_number().over(inside)).join(offsets, buckets).select(
        *columns, (F.col("_off") + F.col("_rank")).alias(out))


def keep_first(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Keep the row(s) with the smallest ``order_col`` per group, ties kept.

    Written as aggregate + join rather than a window: the minimum is
    partially aggregated map-side, and the join back can be split by AQE
    when one group holds a large share of all rows.
    """
    mins = df.groupBy(*keys).agg(F.min(order_col).alias("_first"))
    joined = _join_back(df, mins, keys, F.col(order_col) == F.col("_first"))
    return joined.drop("_first")


def attach_joined_distinct(df: DataFrame, keys: list[str], col: str, out: str,
                           sep: str = " y ") -> DataFrame:
    """Attach the group's sorted distinct non-missing values joined by ``sep``.

    A group with no value gets the empty string.  The set is built with a
    partial (map-side) aggregate and joined back on the group key.
    """
    sets = df.groupBy(*keys).agg(
        F.concat_ws(sep, F.array_sort(F.collect_set(col))).alias("_joined"))
    joined = _join_back(df.drop(out) if out != col else df, sets, keys)
    if out == col:
        joined = joined.drop(col)
    return joined.withColumnRenamed("_joined", out)


def group_size(df: DataFrame, keys: list[str], out: str = "reps") -> DataFrame:
    """Attach the number of rows of the row's group."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    joined = _join_back(df.drop(out), sizes, keys)
    return joined.withColumnRenamed("_size", out)
