"""Records of CSV exports, cut by many tasks although cells may hold line ends.

A line may start inside a quoted cell, which only the lines before it tell.  So
each stretch of a file that one task scans is followed under both possibilities,
outside and inside a cell; the lines are stored once with both answers.  What a
stretch does to the state is a function of two values, and the states at the
starts of all stretches are their composition along the file, a window over one row
per stretch.  Then every line knows its state, its number in the file and the
line on which its record starts.  Records of one line need nothing else; only the
lines of longer ones are brought together.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.session import scratch_path, ship_package

# a cell with what may follow its closing quote, or one without quotes
_CELL = r'(?:"(?:[^"]|"")*+"(?!")[^,]*+|(?!")[^,]*+)'
_LEFT_OPEN = re.compile(rf'(?:{_CELL},)*+"(?:[^"]|"")*+')
_CLOSES = re.compile(r'(?:[^"]|"")*+"(?!")[^,]*+')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends within a quoted cell, given whether it starts in one."""
    if inside:
        closed = _CLOSES.match(line)
        if not closed:
            return True
        line = line[closed.end():]
        return line.startswith(",") and ends_inside(line[1:], False)
    return _LEFT_OPEN.fullmatch(line) is not None


class _Stretch:
    """A stretch followed under both possibilities; carried over batches."""

    def __init__(self):
        self.key, self.seq, self.inside, self.start = None, 0, [False, True], [-1, -1]

    def follow(self, lines: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """seq, and for each possibility: inside before, inside after, seq of the record's first line (or -1)."""
        seq = np.arange(self.seq, self.seq + len(lines))
        quoted = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
        # only lines with quotes can change the state: what each makes of both states
        changes = [(ends_inside(t, False), ends_inside(t, True)) for t in lines.filter(pa.array(quoted)).to_pylist()]
        passed = np.cumsum(quoted)
        before, after, first = [], [], []
        for h in (0, 1):
            inside, states = self.inside[h], [self.inside[h]]
            for change in changes:
                inside = change[inside]
                states.append(inside)
            states = np.array(states)
            into = states[passed - quoted]
            start = np.maximum.accumulate(np.concatenate([[self.start[h]], np.where(into, -1, seq)]))[1:]
            before.append(into)
            after.append(states[passed])
            first.append(start)
            self.inside[h], self.start[h] = inside, int(start[-1])
        self.seq += len(lines)
        return seq, before, after, first


def _followed(header: list[str]):
    """mapInArrow body over (file, block, value) lines in scan order."""
    def is_header(line: str) -> bool:
        return [c.strip() for c in next(csv.reader([line.lstrip("﻿")]), [])] == header

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = _Stretch()
        for batch in batches:
            blocks = batch.column(1).to_numpy(zero_copy_only=False)
            files = batch.column(0)
            ids = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(ids) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(batch)]):
                if end == start:
                    continue
                key = (files[start].as_py(), int(blocks[start]))
                if key != stretch.key:
                    stretch = _Stretch()
                    stretch.key = key
                part = batch.slice(start, end - start)
                lines = part.column(2)
                seq, before, after, first = stretch.follow(lines)
                marked = pc.match_substring(lines, header[0]).to_numpy(zero_copy_only=False)
                head = np.zeros(len(part), bool)
                for i in np.flatnonzero(marked):
                    head[i] = is_header(lines[int(i)].as_py())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), lines, pa.array(seq), *map(pa.array, [*before, *after, *first]),
                     pa.array(head)],
                    ["file", "block", "value", "seq", "in0", "in1", "out0", "out1", "first0", "first1", "head"])

    return run


def _xor(a: Column, b: Column) -> Column:
    return F.pmod(a + b, F.lit(2))


def _stretches(lines: DataFrame) -> DataFrame:
    """State, lines before, and the line of the record left open before each stretch; the header's line per file."""
    last = F.max(F.struct("seq", "out0", "out1", "first0", "first1")).alias("last")
    ends = lines.groupBy("file", "block").agg(last, *[
        F.min(F.when(F.col("head") & ~F.col(f"in{h}"), F.col("seq"))).alias(f"head{h}") for h in (0, 1)])
    out0, out1 = F.col("last.out0").cast("int"), F.col("last.out1").cast("int")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # a stretch sets the state, keeps it, or (from outside to inside and back) swaps it
    swaps = F.coalesce(F.sum(F.when((out0 == 1) & (out1 == 0), 1).otherwise(0)).over(earlier), F.lit(0))
    ends = ends.withColumns({"_swaps": swaps, "_before": F.coalesce(
        F.sum(F.col("last.seq") + 1).over(earlier), F.lit(0))})
    ends = ends.withColumn("_set", F.when(out0 == out1, _xor(out0, F.col("_swaps"))))
    ends = ends.withColumn("_state", _xor(F.coalesce(F.last("_set", True).over(earlier), F.lit(0)), F.col("_swaps")))

    def by_state(name: str) -> Column:
        return F.when(F.col("_state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    opened = F.when(by_state("last.out") & (by_state("last.first") >= 0), F.col("_before") + by_state("last.first"))
    heads = F.min(F.col("_before") + by_state("head")).over(Window.partitionBy("file"))
    return ends.withColumn("_opened", opened).select(
        "file", "block", "_state", "_before", F.last("_opened", True).over(earlier).alias("_open"), heads.alias("_head"))


def csv_records(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """file, line and record text of an export's records, without banner and header.

    ``line`` is the number of the record's first line in its file, the same however
    the files are split.  In each file that has the header record, that record and
    what stands above it are left out, once; files without one are read whole.
    """
    ship_package(spark)
    scanned = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    kept = scratch_path(spark, "csv-lines")
    # stored once: the stretches are those of this scan, whatever splits another one would have
    scanned.mapInArrow(_followed([c.strip() for c in header]), (
        "file string, block long, value string, seq long, in0 boolean, in1 boolean, out0 boolean, out1 boolean, "
        "first0 long, first1 long, head boolean")).write.parquet(kept)
    lines = spark.read.parquet(kept)
    lines = lines.join(_stretches(lines), ["file", "block"])

    def by_state(name: str) -> Column:
        return F.when(F.col("_state") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    start = F.when(by_state("first") >= 0, F.col("_before") + by_state("first")).otherwise(F.col("_open"))
    lines = lines.select("file", (F.col("_before") + F.col("seq")).alias("line"), "value", "_head",
                         (by_state("in") | by_state("out")).alias("several"), start.alias("start"))
    lines = lines.where(F.col("_head").isNull() | (F.col("start") > F.col("_head")))
    single = lines.where(~F.col("several")).select("file", "line", F.col("value").alias("record"))
    together = lines.where("several").groupBy("file", "start").agg(
        F.array_sort(F.collect_list(F.struct("line", "value"))).alias("parts"))
    several = together.select("file", F.col("start").alias("line"), F.array_join("parts.value", "\n").alias("record"))
    return single.unionByName(several).where(F.trim("record") != "")
