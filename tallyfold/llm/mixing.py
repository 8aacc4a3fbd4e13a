"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of ``block_rows`` documents.  Block ``j`` of a
source with weight ``w`` is released at slot ``floor(j / w)`` and due before
slot ``ceil((j + 1) / w)``; each slot takes the released block that is due
first.  At every prefix of the mix, each source then deviates from its target
by less than one block.

Weights are taken exactly as given, as fractions with one denominator, so no
rounding adds up however long the mix is.  What has been dealt before a slot is
all the state a schedule has.  The driver computes that state for every
``resolution``-th slot and Spark schedules the stretches between in parallel.
A state follows from the one before by array steps, without walking through the
slots: blocks due inside the stretch are all dealt in it and come before any
other; counting their releases gives the slots they leave free, and these, fewer
than there are sources, take the released blocks that are due later.
Sources that run short are read again from their start; the mix ends with the
slot in which the last source has been read completely.  No document is dropped.

Rows are numbered inside their source without gathering it: a hash of the id and
of all other columns deals them to about sqrt(rows) buckets, rows are numbered in each
(source, bucket), and running counts over the buckets give where each bucket
starts.  A bucket is handed the slots of the blocks it touches, in parts of
``PART`` readings, so the rows are shuffled only once and a source that is read
very often is spread.

Defined results: a null source is a source of its own; the order in a source
follows the bucket, then a hash of the id, then the id; null ids and repeated ids are ids like others;
repeated rows are rows of their own (rows alike in every column share a bucket); an
empty table gives an empty mix; a source without a given weight is an error;
columns of any other names come through unchanged.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import ship_package

#: slots that are scheduled at a time, and for each source at least so many
RESOLUTION, SOURCE_SLOTS = 10_000, 64
PART = 256  # readings of a block that are kept together
MAX_SOURCES = 10_000  # more than this is refused, never cut
BLOCK_ROWS = 16
#: weights default to size ** TEMPERATURE: small sources gain, none vanishes
TEMPERATURE = 0.7
ADDED = ["mix_slot", "mix_place", "mix_epoch"]


def integer_shares(weights: dict, resolution: int = RESOLUTION) -> dict:
    """Shares of the period by largest remainder; at least one slot each."""
    if len(weights) > resolution:
        raise ValueError(f"{len(weights)} sources need a period of more than {resolution} slots")
    if any(w <= 0 for w in weights.values()):
        raise ValueError("every weight must be positive")
    total = sum(map(Fraction, weights.values()))
    exact = {k: Fraction(w) * resolution / total for k, w in weights.items()}
    shares = {k: max(1, math.floor(x)) for k, x in exact.items()}
    while (short := resolution - sum(shares.values())) != 0:
        # what is left goes to the largest remainders; what the smallest
        # sources were given beyond their share comes from the largest excess
        step = 1 if short > 0 else -1
        by_rest = sorted((k for k in weights if step > 0 or shares[k] > 1),
                         key=lambda k: (step * (shares[k] - exact[k]), str(k)))
        for k in by_rest[:abs(short)]:
            shares[k] += step
    return shares


def schedule(shares: dict) -> dict:
    """Slots of each source in one period: earliest deadline among released blocks."""
    period = sum(shares.values())
    waiting = [(0, k) for k in range(len(shares))]  # by release
    names, slots = list(shares), {k: [] for k in shares}
    ready: list[tuple[int, int]] = []  # by deadline
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            k = heapq.heappop(waiting)[1]
            done, share = len(slots[names[k]]), shares[names[k]]
            heapq.heappush(ready, (-(-(done + 1) * period // share), k))
        k = heapq.heappop(ready)[1]
        slots[names[k]].append(slot)
        done, share = len(slots[names[k]]), shares[names[k]]
        if done < share:
            heapq.heappush(waiting, (done * period // share, k))
    return slots


def exact_shares(weights: dict) -> dict:
    """The weights as integers in exactly the same proportion."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("every weight must be positive")
    exact = {k: Fraction(w) for k, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    return {k: int(x * scale) for k, x in exact.items()}


def dealt(shares: list[int], done: list[int], start: int) -> Iterator[int]:
    """The source of each slot from ``start`` on, without end; ``done`` is kept up to date."""
    total = sum(shares)
    waiting = [(n * total // share, k) for k, (n, share) in enumerate(zip(done, shares))]  # by release
    heapq.heapify(waiting)
    ready: list[tuple[int, int]] = []  # by deadline
    slot = start
    while True:
        while waiting and waiting[0][0] <= slot:
            k = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (-(-(done[k] + 1) * total // shares[k]), k))
        k = heapq.heappop(ready)[1]
        done[k] += 1
        heapq.heappush(waiting, (done[k] * total // shares[k], k))
        slot += 1
        yield k


def releases(sources: np.ndarray, blocks: np.ndarray, shares: list[int]) -> np.ndarray:
    """``floor(block * total / share)`` of each block, exactly.

    In floating point, but for the few quotients so near to a whole number that
    rounding could hide on which side they lie: these are computed as integers.
    """
    total = sum(shares)
    quotients = blocks * np.array([total / share for share in shares])[sources]
    found = np.floor(quotients).astype(np.int64)
    for i in np.flatnonzero(np.abs(quotients - np.rint(quotients)) <= quotients * 2.0 ** -50):
        found[i] = int(blocks[i]) * total // shares[sources[i]]
    return found


def state_after(shares: list[int], done: np.ndarray, start: int, end: int) -> np.ndarray:
    """Blocks of each source dealt before slot ``end``, from those dealt before ``start``."""
    total = sum(shares)
    due = np.array([end * share // total for share in shares], np.int64)  # deadlines up to ``end``
    counts = np.maximum(due - done, 0)
    sources = np.repeat(np.arange(len(shares)), counts)
    blocks = np.arange(len(sources)) - np.repeat(np.cumsum(counts) - counts, counts) + done[sources]
    arrivals = np.bincount(np.maximum(releases(sources, blocks, shares) - start, 0), minlength=end - start)
    # more slots than released blocks so far: each new low is a slot these leave free
    excess = np.cumsum(arrivals) - np.arange(1, end - start + 1)
    low = np.minimum.accumulate(np.minimum(excess, 0))
    free = np.flatnonzero(np.diff(low, prepend=0) < 0) + start
    after = np.maximum(done, due)
    # one block at most of each source is released before ``end`` and due later
    waiting = [(int(due[k]) * total // share, -(-(int(due[k]) + 1) * total // share), k)
               for k, share in enumerate(shares) if done[k] <= due[k]]
    waiting.sort(reverse=True)
    ready: list[tuple[int, int]] = []  # by deadline
    for slot in free.tolist():
        while waiting and waiting[-1][0] <= slot:
            heapq.heappush(ready, waiting.pop()[1:])
        after[heapq.heappop(ready)[1]] += 1
    return after


def stretches(shares: list[int], blocks: list[int], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """First slot, number of slots and blocks dealt before, until each source was read once."""
    done, slot, need = np.zeros(len(shares), np.int64), 0, np.array(blocks, np.int64)
    while (done < need).any():
        after, slots = state_after(shares, done, slot, slot + length), length
        if (after >= need).all():  # the last one ends inside
            now, left = done.tolist(), int((done < need).sum())
            for slots, k in enumerate(dealt(shares, now, slot), 1):
                left -= now[k] == blocks[k]
                if not left:
                    break
        yield slot, slots, done.tolist()
        done, slot = after, slot + length


def mix(docs: DataFrame, weights: dict | None = None, source_col: str = "source",
        id_col: str = "doc_id", block_rows: int = BLOCK_ROWS,
        resolution: int = RESOLUTION) -> DataFrame:
    """All columns of ``docs`` and the place of each reading in the mix.

    ``mix_slot`` is the block's slot, ``mix_place`` the row's place in its block
    and ``mix_epoch`` how often the source was read before.  (mix_slot,
    mix_place) orders the mix.  Columns of these names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(*ADDED)
    if not docs.columns:
        raise ValueError("nothing to mix")
    named = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    hashed = F.xxhash64(id_col, *(c for c, (_, t) in zip(named, docs.dtypes) if "map<" not in t and t != "variant"))
    # whole rows in one column, so that no name can clash
    rows = docs.select(F.struct(*named).alias("row"), F.col(source_col).alias("source"),
                       F.col(id_col).alias("id"), hashed.alias("hash"))
    sizes = {r[0]: r[1] for r in rows.groupBy("source").count().limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    names = sorted(sizes, key=lambda s: (s is not None, s))
    if weights is None:
        weights = {s: float(sizes[s]) ** TEMPERATURE for s in names}
    if missing := [s for s in names if s not in weights]:
        raise ValueError(f"no target weight for sources {missing[:10]}")
    exact = exact_shares({s: weights[s] for s in names})
    shares, blocks = [exact[s] for s in names], [-(-sizes[s] // block_rows) for s in names]
    sources = spark.createDataFrame(
        list(enumerate(names)), f"sid int, source {docs.schema[source_col].dataType.simpleString()}")
    ship_package(spark)
    # the state of a stretch has a number for each source
    states = spark.createDataFrame(list(stretches(shares, blocks, max(resolution, SOURCE_SLOTS * len(names)))),
                                   "start long, slots long, done array<long>")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, slots, done in zip(*(c.to_pylist() for c in batch.columns)):
                order = dealt(shares, done, start)
                turns = [(k, *divmod(done[k] - 1, blocks[k])) for k, _ in zip(order, range(slots))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _, _ in turns], pa.int32()), pa.array([b for _, _, b in turns], pa.int64()),
                     pa.array([e // PART for _, e, _ in turns], pa.int64()),
                     pa.array(range(start, start + slots), pa.int64())], ["sid", "block", "part", "slot"])

    # a block's slots in order, one for each time its source is read
    places = states.mapInArrow(deal, "sid int, block long, part long, slot long").groupBy(
        "sid", "block", "part").agg(F.array_sort(F.collect_list("slot")).alias("slots"))

    buckets = max(1, math.isqrt(sum(sizes.values())))
    # at most ``MAX_SOURCES`` sources
    rows = rows.withColumnRenamed("source", "of").join(
        F.broadcast(sources), F.col("of").eqNullSafe(F.col("source"))).drop("of", "source")
    rows = rows.withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    counts = rows.groupBy("sid", "bucket").count()
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("sid", "bucket", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    touched = starts.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block_rows), F.floor((F.col("start") + F.col("count") - 1) / block_rows))))
    spans = touched.join(places, ["sid", "block"]).groupBy("sid", "bucket", "start", "part").agg(
        F.map_from_entries(F.collect_list(F.struct("block", "slots"))).alias("span"))
    inside = Window.partitionBy("sid", "bucket").orderBy(F.xxhash64("id"), "id", "hash")
    rows = rows.withColumn("n", F.row_number().over(inside)).join(spans, ["sid", "bucket"])
    rows = rows.withColumn("n", F.col("start") + F.col("n") - 1)
    # the last part may lack some blocks
    slots = F.element_at("span", F.floor(F.col("n") / block_rows))
    rows = rows.select("row", (F.col("n") % block_rows).alias("mix_place"), "part",
                       F.posexplode(slots).alias("turn", "mix_slot"))
    return rows.select("row.*", "mix_slot", "mix_place", (F.col("part") * PART + F.col("turn")).alias("mix_epoch"))


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """The readings as rows in the order of the mix (range-partitioned, sorted)."""
    order = ["mix_slot", "mix_place"]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).drop(*ADDED)
