"""Scans and sinks.

Every scan takes a declared schema.  Workbook sheets and online forms of
the original workflow arrive here as exported files (CSV / JSON / Parquet).
"""

from __future__ import annotations

import csv
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.dates import read_by_patterns
from tallyfold.session import scratch_path
from tallyfold.sources import schemas
from tallyfold.sources.csv_records import csv_records


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet", **options) -> DataFrame:
    """Scan a table with a declared schema."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", "true"))
        # with a header, check its names against the schema instead of
        # mapping columns by position
        reader = reader.option("enforceSchema", options.get("enforceSchema", "false"))
    return reader.load(path)


def _header(spark: SparkSession, path: str, marks: list[str]) -> list[str]:
    """Names in the header line of a CSV export: the first line that has one of
    ``marks`` as a field, so that a banner above it doesn't count."""
    def fields(line: str) -> list[str]:
        return next(csv.reader([line]), [])

    marked = [F.col("value").contains(m) for m in marks]
    lines = spark.read.text(path).where(marked[0] | marked[-1]).limit(100).collect()
    found = [f for f in (fields(r[0].lstrip("\ufeff")) for r in lines) if set(marks) & set(f)]
    if not found:
        raise ValueError(f"{path}: missing columns {marks}: no header line has them")
    return found[0]


def _unique(names: list[str]) -> list[str]:
    """Header names made distinct (unnamed and repeated cells get their position)."""
    return [n if n and n not in names[:i] else f"{n}_{i + 1}" for i, n in enumerate(names)]


def read_csv_text(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """The records of a CSV export as text columns, without banner and header.

    Records may hold quoted commas, quotes and line ends, in files of any size
    (:mod:`tallyfold.sources.csv_records`).  Besides the columns of ``header`` each
    row has ``_record``: NULL, or the record's text where its number of fields
    differs, and ``_file`` and ``_line``, the place of its first line.
    """
    names = _unique(header)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_record"]])
    cells = F.from_csv("record", _ddl(schema), {
        "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record"})
    parsed = csv_records(spark, path, header).select(cells.alias("_cells"), "file", "line").select(
        *[F.col("_cells").getField(n).alias(f"c{i}") for i, n in enumerate(schema.names)], "file", "line")
    # stored once: accepted and rejected rows are both read from it
    return hand_over(parsed, scratch_path(spark, "csv-cells")).toDF(*schema.names, "_file", "_line")


def _ddl(schema: T.StructType) -> str:
    """A schema of text columns as DDL, whatever characters the names have."""
    return ", ".join("`" + n.replace("`", "``") + "` string" for n in schema.names)


def name_col(name: str):
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def _read_json_text(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The records of a JSON-lines export: the columns of ``names`` that occur, as text.

    One pass, nothing is inferred; names count as they are written.  A name counts as
    there if one of the first records has it as a key or any record has a value for it.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    cells = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    raw = lines.select(cells.alias("_cells"), F.when(cells.isNull(), F.col("value")).alias("_record"))
    first = {k for r in raw.limit(100).select(F.map_keys("_cells").alias("keys")).collect() for k in r["keys"] or []}
    there = [n for n in names if n in first or raw.where(F.col("_cells")[n].isNotNull()).take(1)]
    return raw.select(*[F.col("_cells")[n].alias(n) for n in there], "_record")


def _typed(cell: Column, data_type: T.DataType, patterns: tuple[str, ...] | None) -> tuple[Column, Column]:
    """The cell's value (NULL where it can't be read), and whether its patterns disagree."""
    if patterns is None:
        return cell.cast("string").try_cast(data_type), F.lit(False)
    return read_by_patterns(cell, data_type.simpleString(), patterns)


def split_readable(spark: SparkSession, path: str, schema: T.StructType,
                   aliases: dict[str, str] | None = None, tail: list[str] | None = None,
                   positions: dict[int, str] | None = None, row_id: str | None = None,
                   patterns: dict[str, tuple[str, ...]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Scan an exported input by its extension (csv / json / parquet).

    Returns the rows with the declared columns, and the rows that can't be read
    (``record``, ``reason``): records of a wrong number of fields, and rows with a
    cell that isn't of its declared type.  Columns are matched by the name in the
    file: ``aliases`` gives the original header of a declared name, which counts
    where the file has it.  ``positions`` renames columns by their 1-based place
    and ``tail`` all columns but the first, before that.  A declared column that
    the file lacks is an error, in every format; only ``row_id`` is then made from
    the record's place in the export.  ``patterns`` names the ways in which a date or
    stamp column is written besides ISO text; a cell that they read as different
    values is rejected as ambiguous.
    """
    aliases, patterns = aliases or {}, patterns or {}
    ext = os.path.splitext(path.rstrip("/"))[1].lower().lstrip(".") or "parquet"
    first = schema.fields[0].name
    wrong = F.lit(None).cast("string")
    if ext == "csv":
        known = [aliases[f.name] for f in schema.fields if f.name in aliases]
        header = _header(spark, path, [*known[:1], first])
        raw = read_csv_text(spark, path, header)
        wrong = F.when(F.col("_record").isNotNull(), F.lit("wrong number of fields"))
    elif ext in ("json", "jsonl") and tail is None and not positions:
        raw = _read_json_text(spark, path, list(dict.fromkeys(
            n for f in schema.fields for n in (aliases.get(f.name, f.name), f.name))))
        wrong = F.when(F.col("_record").isNotNull(), F.lit("not a record"))
    elif ext in ("json", "jsonl"):
        raw = spark.read.option("primitivesAsString", "true").option("mode", "PERMISSIVE").option(
            "columnNameOfCorruptRecord", "_record").json(path)
        if "_record" in raw.columns:
            wrong = F.when(F.col("_record").isNotNull(), F.lit("not a record"))
        else:
            raw = raw.withColumn("_record", F.lit(None).cast("string"))
    else:
        raw = spark.read.parquet(path).withColumn("_record", F.lit(None).cast("string"))
    places = [c for c in ("_file", "_line") if ext == "csv"]
    columns = [c for c in raw.columns if c not in ("_record", *places)]
    renamed = list(columns)
    for place, name in (positions or {}).items():
        if place <= len(renamed):
            renamed[place - 1] = name
    if tail is not None:
        if len(tail) != len(renamed) - 1:
            raise ValueError(f"{path}: expected {len(tail) + 1} columns, found {len(renamed)}")
        renamed = [renamed[0], *tail]
    raw = raw.select(*[name_col(c).alias(n) for c, n in zip(columns, renamed)], "_record", *places)
    if row_id and row_id not in renamed and aliases.get(row_id) not in renamed:
        # in a CSV export the place of the record, the same however the files are split
        raw = raw.withColumn(row_id, F.concat_ws(":", "_file", F.format_string("%019d", "_line")) if places else
                             F.format_string("%019d", F.monotonically_increasing_id()))
        renamed.append(row_id)
    source = {f.name: next((n for n in (aliases.get(f.name), f.name) if n in renamed), None)
              for f in schema.fields}
    if missing := [n for n, c in source.items() if c is None]:
        raise ValueError(f"{path}: missing columns {missing}")
    values = []
    for f in schema.fields:
        cell = name_col(source[f.name])
        value, ambiguous = _typed(cell, f.dataType, patterns.get(f.name))
        bad = cell.isNotNull() & value.isNull()
        if ext == "csv":
            bad = bad & (F.trim(cell) != "")
        wrong = F.coalesce(wrong, F.when(bad, F.lit(f"unreadable {f.name}")),
                           F.when(ambiguous, F.lit(f"ambiguous {f.name}")))
        values.append(value.alias(f.name))
    marked = raw.withColumn("_reason", wrong)
    good = marked.where(F.col("_reason").isNull()).select(*values)
    record = F.coalesce("_record", F.to_json(F.struct(*[name_col(n) for n in renamed])))
    rejected = marked.where(F.col("_reason").isNotNull()).select(
        record.alias("record"), F.col("_reason").alias("reason"))
    return good, rejected


def read_input(spark: SparkSession, path: str, schema: T.StructType,
               aliases: dict[str, str] | None = None, rejects: str | None = None,
               **places) -> DataFrame:
    """The readable rows of an exported input; see :func:`split_readable`.

    Unreadable rows are written to ``rejects``; without that path the first of
    them stops the job.
    """
    good, rejected = split_readable(spark, path, schema, aliases, **places)
    if rejects:
        write_table(rejected, rejects)
    elif bad := rejected.take(1):
        raise ValueError(f"{path}: {bad[0]['reason']}: {bad[0]['record'][:200]}")
    return good


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, scanned with its declared schema."""
    return read_table(spark, os.path.join(sf_dir, f"{name}.parquet"),
                      schemas.TABLES.get(name))


def rename_at(df: DataFrame, position: int, name: str) -> DataFrame:
    """Rename the column at 1-based ``position``."""
    cols = list(df.columns)
    cols[position - 1] = name
    return df.toDF(*cols)


def rename_tail(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename every column but the first, by position."""
    if len(names) != len(df.columns) - 1:
        raise ValueError(f"expected {len(df.columns) - 1} names, got {len(names)}")
    return df.toDF(df.columns[0], *names)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, **options) -> None:
    """Write a result table, replacing what is there."""
    w = df.write.mode("overwrite").format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)


def hand_over(df: DataFrame, path: str) -> DataFrame:
    """Durable hand-over between stages (S8): write Parquet, read it back.

    The read-back cuts the lineage, so a later stage (or a person editing
    the file in between) never triggers a recomputation upstream.
    """
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """Inline literal table (S9) — for small parameter lists only."""
    return spark.createDataFrame(rows, schema)
