"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``max_bits`` bits have a common point
within half that radius of both.  Every distinct fingerprint therefore emits
all its variants within ``max_bits / 2`` bits, the variants are shuffled, and
fingerprints that meet at a variant are linked.  A variant has at most as many
fingerprints as its ball has points (65 for two bits), whatever the data.
Inside a variant each fingerprint is linked to its predecessor only: all of
them are within ``max_bits`` of one another, so the chain connects what all
pairs would.  Links are deduplicated, verified by their bit distance and
closed into components by alternating large-star and small-star steps.

Documents meet only as distinct fingerprints, so a group of thousands of
copies is one point here; copies are counted before the shuffle.

Defined results: null and empty texts (and texts of white space) have the
fingerprint zero, linked like any other; fewer words than a shingle make one
shingle; repeated rows are copies; a null ``doc_id`` is never a component's
id unless the component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import durable, numbered, unused, word_runs
from tallyfold.session import ship_package

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def _bit_counts(hashes: list[int]) -> np.ndarray:
    """How often each of the 64 bits is set."""
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set if it is set in over half of the shingles' XXH64."""
    ones, total = np.zeros(64, np.int64), 0
    tail: list[bytes] = []
    for run in word_runs((text or "").encode("utf-8", "surrogatepass").lower()):
        words = tail + run
        shingles = zip(*(islice(words, i, None) for i in range(shingle_words)))
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles]
        ones += _bit_counts(hashes)
        total += len(hashes)
        tail = words[1 - shingle_words:] if shingle_words > 1 else []
    if not total and tail:  # fewer words than a shingle
        hashes = [xxhash.xxh64_intdigest(b" ".join(tail), SEED)]
        ones, total = _bit_counts(hashes), 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS, rid: Column | None = None) -> DataFrame:
    """rid, doc_id, fp (the 64 bits as a signed long), one row per document."""
    ship_package(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(t.as_py(), shingle_words)) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["rid", "doc_id", "fp"])

    rows = docs.select((F.monotonically_increasing_id() if rid is None else rid).alias("rid"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, "rid long, doc_id long, fp long")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a < b: verified links that connect all fingerprints within ``max_bits`` bits."""
    if max_bits % 2 or not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0, 2 or 4")
    masks = [sum(1 << i for i in c) for r in range(max_bits // 2 + 1)
             for c in combinations(range(64), r)]
    around = F.transform(F.array(*[F.lit(_signed(m)).cast("long") for m in masks]),
                         lambda m: F.col("fp").bitwiseXOR(m))
    variants = fps.select("fp", F.explode(around).alias("variant"))
    meet = Window.partitionBy("variant").orderBy("fp")
    met = variants.select(F.lag("fp").over(meet).alias("a"), F.col("fp").alias("b"))
    return met.where(F.col("a").isNotNull()).distinct().where(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of an edge can reach."""
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("low"))

    def turned(pairs: DataFrame) -> DataFrame:
        return pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))

    # u > v in every stored edge
    current = durable(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .where("u <> v").distinct())
    state = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = tuple(mark)
        # large star: every larger neighbour goes to the smallest neighbour
        both = turned(current)
        low = smallest(both).select("u", F.least("u", "low").alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.distinct()
        # small star: every smaller neighbour, and the node, goes to the smallest one
        low = smallest(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(low.select("u", F.col("low").alias("v")))
        current = durable(small.where("u <> v").distinct())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                rid: Column | None = None) -> DataFrame:
    """rid, doc_id, fp, component_id, kept: one row per document.

    ``kept`` marks one row of each component, that of the smallest doc_id.
    ``rid`` is a number that ``docs`` has for each row; without it, one of this scan.
    """
    rows = durable(fingerprints(docs, id_col, text_col, shingle_words, rid))
    points = durable(rows.groupBy("fp").agg(
        F.min("doc_id").alias("first_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")).alias("head")))
    roots = components(links(points.select("fp"), max_bits))
    placed = points.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", "head", F.coalesce("root", "fp").alias("root"))
    groups = placed.groupBy("root").agg(F.min("first_id").alias("component_id"),
                                        F.min("head").alias("head"))
    by_point = placed.select("fp", "root").join(groups, "root").select(
        "fp", "component_id", F.col("head.rid").alias("head"))
    return rows.join(by_point, "fp").select(
        "rid", "doc_id", "fp", "component_id", (F.col("rid") == F.col("head")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns."""
    rows = numbered(docs, rid := unused("__rid", docs.columns))
    dropped = near_groups(rows, id_col, text_col, rid=F.col(rid)).where(~F.col("kept")).select(
        F.col("rid").alias(rid))
    return rows.join(dropped, rid, "left_anti").drop(rid)
