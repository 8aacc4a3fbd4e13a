"""Hand-overs between jobs that can be trusted, and by way of a person.

A published table has a manifest, written after its rows: schema, number of rows
and a digest of their contents, all observed while the rows were written.  The
job that takes the table over stops if the manifest is missing (the writer did
not finish) or the rows are not those it describes.

A review sheet is a published table as CSV with an empty column for decisions,
small enough files for a spreadsheet each, in order.  Only keys and decisions are
read back, so cells that a spreadsheet rewrites (numbers, dates, zeros in front of a
code) do no harm; a row that is missing, foreign or given twice with different
decisions stops the job.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.sources.io import name_col, read_input, write_table

MANIFEST = "_manifest"  # inside the table's folder; table scans skip names like this
#: rows in a file of a review sheet
SHEET_ROWS = 100_000
DECISION = "decision"


def _digest(df: DataFrame) -> Column:
    """Sum of the rows' hashes: the same for any order of rows and columns."""
    columns = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        cell = name_col(f.name)
        columns += [F.to_json(F.struct(cell)) if "map<" in f.dataType.simpleString() else cell, cell.isNull()]
    return F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(28,0)")), F.lit(0)).cast("string")


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None,
            **measures: Column) -> dict:
    """Write ``df`` and its manifest; ``measures`` are aggregates observed in the same pass.

    Returns the manifest: ``schema``, ``rows``, ``digest`` and the measures.
    """
    seen = Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), _digest(df).alias("digest"),
                         *[m.alias(n) for n, m in measures.items()])
    write_table(watched, path, partition_by=partition_by)
    manifest = {"schema": json.loads(df.schema.json()), **seen.get}
    line = df.sparkSession.createDataFrame([(json.dumps(manifest, default=str),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{path}/{MANIFEST}")
    return manifest


def manifest_of(spark: SparkSession, path: str) -> dict:
    try:
        line = spark.read.text(f"{path}/{MANIFEST}").first()
    except AnalysisException:
        line = None
    if line is None:
        raise ValueError(f"{path}: no manifest, the table was not written to its end")
    return json.loads(line[0])


def _published(spark: SparkSession, path: str, manifest: dict) -> DataFrame:
    """The rows as published, columns in their first order (partition columns come last in files)."""
    schema = T.StructType.fromJson(manifest["schema"])
    rows = spark.read.schema(schema).parquet(path)
    return rows.select(*[name_col(n) for n in schema.names])


def take_over(spark: SparkSession, path: str, contents: bool = True) -> DataFrame:
    """A published table, after a check that it is whole and unchanged.

    The check is one scan of the table; without ``contents`` only rows are
    counted, which reads no column.
    """
    manifest = manifest_of(spark, path)
    rows = _published(spark, path, manifest)
    wanted = [F.count(F.lit(1)).alias("rows"), *([_digest(rows).alias("digest")] if contents else [])]
    found = rows.agg(*wanted).first().asDict()
    for name, value in found.items():
        if value != manifest[name]:
            raise ValueError(f"{path}: altered since it was published: {name} {value}, was {manifest[name]}")
    return rows


def export_sheet(spark: SparkSession, table: str, sheet: str, keys: list[str], sheet_rows: int = SHEET_ROWS) -> None:
    """A published table as CSV for review: a row each, in order of its keys, decisions empty."""
    if not sheet.endswith(".csv"):
        raise ValueError(f"{sheet}: a review sheet's name ends with .csv")
    manifest = manifest_of(spark, table)
    rows = _published(spark, table, manifest).withColumn(DECISION, F.lit(None).cast("string"))
    files = max(1, -(-manifest["rows"] // sheet_rows))
    order = [name_col(k) for k in keys]
    write_table(rows.repartitionByRange(files, *order).sortWithinPartitions(*order), sheet, "csv", escape='"')


def _bare(code: Column) -> Column:
    """A code without the zeros in front that spreadsheets drop."""
    return F.coalesce(F.regexp_replace(code.cast("string"), "^0+", ""), F.lit(""))


def read_sheet(spark: SparkSession, table: str, sheet: str, out: str, keys: list[str], code: str) -> DataFrame:
    """Decisions of an edited sheet: ``keys`` as published and the decision, stored in ``out``.

    ``code`` is the key that a decision may replace by another one; a replacing
    code gets back the zeros in front that it lost.
    """
    rows = take_over(spark, table)
    fields = {f.name: f for f in rows.schema.fields}
    text = T.StructType([T.StructField(k, T.StringType() if k == code else fields[k].dataType)
                         for k in keys] + [T.StructField(DECISION, T.StringType())])
    edited = read_input(spark, sheet, text)
    bare = [_bare(name_col(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    decided = F.nullif(F.trim(name_col(DECISION)), F.lit(""))
    edited = edited.select(*bare, decided.alias(DECISION)).groupBy(*names).agg(
        F.min(DECISION).alias(DECISION), F.max(DECISION).alias("_other"), F.lit(True).alias("_given"),
        F.count(F.lit(1)).alias("_times"), F.count(DECISION).alias("_decided"))
    known = rows.select(*[name_col(k) for k in keys], *bare).distinct().withColumn("_known", F.lit(True))
    met = known.join(edited, names, "full_outer")
    code_col, decision = name_col(code), name_col(DECISION)
    width = F.length(code_col)
    whole = F.when(decision.rlike("^[0-9]+$") & (F.length(decision) < width),
                   F.lpad(decision, width, "0")).otherwise(decision)
    split = (decision != F.col("_other")) | (F.col("_decided") > 0) & (F.col("_decided") < F.col("_times"))

    def number(bad: Column) -> Column:
        return F.coalesce(F.sum(F.coalesce(bad, F.lit(False)).cast("long")), F.lit(0))

    problems = {"foreign": F.col("_known").isNull(), "missing": F.col("_given").isNull(), "contradicted": split}
    marked = met.select(*[name_col(k) for k in keys], whole.alias(DECISION),
                        *[F.coalesce(p, F.lit(False)).alias(f"_{n}") for n, p in problems.items()])
    found = publish(marked, out, **{n: number(F.col(f"_{n}")) for n in problems})
    if wrong := {n: found[n] for n in problems if found[n]}:
        raise ValueError(f"{sheet}: rows that don't fit {table}: {wrong}")
    return _published(spark, out, found).select(*[name_col(k) for k in keys], DECISION)
