"""Helpers that several of these operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.session import checkpoint_dir


#: so many rows of 16 bytes are broadcast at most (16 MB)
BROADCAST_FILES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One whole table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    A reliable checkpoint: later jobs read the stored rows, also after an
    executor is lost, and Spark removes the files when the frame is no longer
    referenced (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` and a number of each row, the same however often it is read.

    The rows of a Parquet table are numbered by the order of its files' paths and
    their place in the file, so that nothing depends on how Spark splits the
    files.  Where the rows aren't each row of their files once (rows were
    filtered or multiplied, or come from elsewhere), they are stored once with
    their numbers.  A column called ``name`` is replaced.

    Files are counted by a scan without columns and meet their rows by a 64-bit
    hash of the path, 16 bytes for each file.  Up to ``BROADCAST_FILES`` files these
    go to every worker, more than that meet the rows in a join that Spark plans.
    """
    docs = docs.drop(name)
    file, start, row = (unused(n, [*docs.columns, name]) for n in ("__file", "__start", "__row"))
    try:
        meta = docs.metadataColumn("_metadata")
        rows = docs.withColumns({file: F.xxhash64(meta["file_path"]), row: meta["row_index"]})
        places = docs.select(meta["file_path"].alias("path"), meta["row_index"].cast("decimal(38,0)").alias("row"))
        files = durable(places.groupBy("path").agg(
            F.count(F.lit(1)).alias("n"), F.max("row").alias("last"), F.sum("row").alias("sum"),
            F.sum(F.col("row") * F.col("row")).alias("squares")))
    except PySparkException:  # no files, or a format without row places
        return durable(docs.withColumn(name, F.monotonically_increasing_id()))
    n = F.col("n").cast("decimal(18,0)")
    whole = files.agg(
        F.bool_and((F.col("last") == n - 1) & (F.col("sum") * 2 == n * (n - 1))
                   & (F.col("squares") * 6 == (n - 1) * n * (n * 2 - 1))),
        F.count(F.lit(1)), F.count_distinct(F.xxhash64("path"))).first()
    if whole[0] is False or whole[1] != whole[2]:
        return durable(docs.withColumn(name, F.monotonically_increasing_id()))
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    starts = files.select(F.xxhash64("path").alias(file),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    if whole[1] <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    return rows.join(starts, file).withColumn(name, F.col(start) + F.col(row)).drop(file, start, row)


def unused(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it (names differ in more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold_of(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")),
                  F.lit(folds).cast("long"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty.

    ``lower`` does the same job faster on a text of one-byte characters, all
    others take the character-wise ``translate``.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes add up to at most ``limit`` (one item at least)."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def word_runs(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, about ``size`` bytes at a time."""
    start = 0
    while start < len(data):
        end = start + size
        if end < len(data):
            found = _WHITE.search(data, end)
            end = found.start() if found else len(data)
        yield data[start:end].split()
        start = end
