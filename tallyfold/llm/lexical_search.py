"""Ranked lexical search with MaxScore over bounds of terms and of term pairs.

Every document is reduced to the terms that the searched items use, stored
once, and counted for the collection's statistics.  The stored documents are
then searched in blocks: a block's inverted lists hold each term's impacts and
their maximum, and for pairs of terms that items have in common an
intersection list with the largest joint contribution.  An item's terms are put
into units, such pairs and single terms.  A pair's bound, the largest joint or
single contribution, is at most the sum of the two independent maxima, so that
more units stay below the score that the item's k-th document already has:
these are only looked up for the documents that the remaining lists bring up,
and a block whose bounds add up to less than that score is skipped.

The k-th scores start from a search of a sixteenth of the documents, chosen by
a hash of the id; they only bound, the results come from all documents.  Items
are searched in blocks of bounded text, so what a worker holds depends neither
on the documents nor on the number of items.

Defined results: a null text has no terms, and a document or item without any
finds nothing; items and documents that repeat are searched and ranked each; a
null ``doc_id`` comes last among equal scores; fewer than k documents with a
score above 0 are all returned; other columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import durable, slices
from tallyfold.session import ship_package

ITEM_CHARS = 8 << 20      # text of the items searched together
BLOCK_POSTINGS = 1 << 20  # postings of a block's inverted lists
PAIR_ITEMS = 2            # items that must share a pair for it to get a list
SEED_PART = 16            # the first bounds come from one document in so many
_NO_ID = (1 << 63) - 1

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
# bytes of letters and digits as they are, A-Z lowered, other ASCII to a space
_TO_TERMS = bytes(b if b >= 128 or b in _KEPT else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: str | bytes | None) -> list[bytes]:
    """The terms of a whole text, with repeats."""
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(_TO_TERMS).split()


class Items:
    """A block of items: ids, the vocabulary of their terms, and each one's term numbers."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        self.ids = ids
        self.vocabulary: dict[bytes, int] = {}
        self.terms = [sorted({self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms_of(text)})
                      for text in texts]

    def units(self, weights: np.ndarray, least: int = PAIR_ITEMS) -> list[tuple[list[tuple[int, int]], list[int]]]:
        """Disjoint pairs, and the terms left over, of each item.

        Terms follow each other by weight, the commonest first, which makes
        pairs that several items share; terms of no weight are left out.
        """
        ordered = [sorted((t for t in terms if weights[t] > 0), key=lambda t: (weights[t], t)) for terms in self.terms]
        uses = Counter(pair for terms in ordered for pair in zip(terms, terms[1:]))
        found = []
        for terms in ordered:
            pairs, single, i = [], [], 0
            while i < len(terms):
                if i + 1 < len(terms) and uses[terms[i], terms[i + 1]] >= least:
                    pairs.append((terms[i], terms[i + 1]))
                    i += 2
                else:
                    single.append(terms[i])
                    i += 1
            found.append((pairs, single))
        return found


class Block:
    """Inverted lists of a block of documents, by term number."""

    def __init__(self, doc_ids: np.ndarray, terms: np.ndarray, rows: np.ndarray, values: np.ndarray, size: int):
        order = np.argsort(terms, kind="stable")
        self.doc_ids, self.rows, self.values = doc_ids, rows[order], values[order]
        counts = np.bincount(terms, minlength=size)
        ends = np.cumsum(counts)
        self.starts, self.ends = ends - counts, ends
        #: largest contribution of each term, weight included
        self.most = np.zeros(size, np.int64)
        held = np.flatnonzero(counts)
        if len(held):
            self.most[held] = np.maximum.reduceat(self.values, self.starts[held])
        self._joint: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, int]] = {}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.starts[term], self.ends[term])
        return self.rows[part], self.values[part]

    def pair(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that hold both terms, their joint contributions and the largest of them."""
        if (a, b) not in self._joint:
            (rows_a, values_a), (rows_b, values_b) = self.postings(a), self.postings(b)
            if len(rows_a) > len(rows_b):
                rows_a, values_a, rows_b, values_b = rows_b, values_b, rows_a, values_a
            at = np.searchsorted(rows_b, rows_a)
            at[at == len(rows_b)] = 0
            both = rows_b[at] == rows_a if len(rows_b) else np.zeros(len(rows_a), bool)
            joint = values_a[both] + values_b[at[both]]
            self._joint[a, b] = rows_a[both], joint, int(joint.max(initial=0))
        return self._joint[a, b]

    def values_at(self, term: int, rows: np.ndarray) -> np.ndarray:
        """The term's contribution to each of the given documents."""
        held, values = self.postings(term)
        if not len(held):
            return np.zeros(len(rows), np.int64)
        at = np.minimum(np.searchsorted(held, rows), len(held) - 1)
        return np.where(held[at] == rows, values[at], 0)


class Best:
    """The k best documents of one item so far, and the score that a further one needs."""

    def __init__(self, k: int, floor: int = 0):
        self.k, self.floor = k, max(floor, 1)
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def needed(self) -> int:
        """A document of this score may still count, by a smaller id among equals."""
        return max(self.floor, int(self.scores[-1])) if len(self.scores) == self.k else self.floor

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[first], ids[first]


def search_block(block: Block, pairs: list[tuple[int, int]], single: list[int], best: Best,
                 joint: bool = True) -> tuple[int, int]:
    """Add a block's documents to an item's best; postings read one by one, and looked up.

    ``joint=False`` bounds each term by itself, as plain MaxScore does.
    """
    most = block.most
    units = [((t,), int(most[t])) for t in single if most[t]]
    for a, b in pairs:
        if joint and most[a] and most[b]:
            units.append(((a, b), max(block.pair(a, b)[2], int(most[a]), int(most[b]))))
        else:
            units += [((t,), int(most[t])) for t in (a, b) if most[t]]
    units.sort(key=lambda u: u[1])
    needed, below, i = best.needed, 0, 0
    while i < len(units) and below + units[i][1] < needed:
        below += units[i][1]
        i += 1
    if i == len(units):
        return 0, 0  # no document here can reach the score
    scores, read = np.zeros(len(block.doc_ids), np.int64), 0
    for terms, _ in units[i:]:
        for t in terms:
            rows, values = block.postings(t)
            scores[rows] += values
            read += len(rows)
    rows = np.flatnonzero(scores >= max(needed - below, 1))
    scores, looked = scores[rows], 0
    for terms, bound in reversed(units[:i]):
        if not len(rows):
            break
        for t in terms:
            scores += block.values_at(t, rows)
        looked += len(rows) * len(terms)
        below -= bound
        kept = scores + below >= needed
        rows, scores = rows[kept], scores[kept]
    if len(rows):
        best.add(scores, block.doc_ids[rows])
    return read, looked


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def length_norms(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """m of each document; by Python's integers where 64 bits would not hold a step."""
    if 90 * int(n.max(initial=0)) * documents < 1 << 62:
        return 10 + 90 * n * documents // max(length, 1)
    return np.array([10 + 90 * int(x) * documents // length for x in n], np.int64)


class _Search:
    """What every worker gets: the items, weights, units, statistics and the scores to start from."""

    def __init__(self, items: Items, weights: np.ndarray, documents: int, length: int, k: int, floors: list[int]):
        self.ids, self.weights, self.units = items.ids, weights, items.units(weights)
        self.documents, self.length, self.k, self.floors = documents, length, k, floors

    def blocks(self, batch: pa.RecordBatch) -> Iterator[Block]:
        """Blocks of a batch with doc_id, n, terms and times."""
        counts = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
        for start, end in slices(counts.tolist(), BLOCK_POSTINGS):
            part = batch.slice(start, end - start)
            norms = length_norms(part.column(1).to_numpy(zero_copy_only=False), self.documents, self.length)
            rows = np.repeat(np.arange(end - start), counts[start:end])
            terms = part.column(2).flatten().to_numpy(zero_copy_only=False)
            times = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            impacts = 1_000_000_000 * times // (1000 * times + 8 * norms[rows])
            ids = part.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            yield Block(ids, terms, rows, impacts * self.weights[terms], len(self.weights))

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(self.k, floor) for floor in self.floors]
        for batch in batches:
            for block in self.blocks(batch):
                for (pairs, single), best in zip(self.units, found):
                    search_block(block, pairs, single, best)
        for i, best in enumerate(found):
            if len(best.scores):
                ids = pa.array(best.ids, mask=best.ids == _NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), i, np.int32)), pa.array([self.ids[i]] * len(ids), pa.int64()),
                     ids, pa.array(best.scores)], ["item", "item_id", "doc_id", "score"])


def reduced(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (its terms with repeats), and the numbers and occurrences of the items' terms in it."""
    sent = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for batch in batches:
            held, ns, terms, times = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                words = terms_of(memoryview(text.as_buffer()).tobytes()) if text.is_valid else []
                if words:
                    found = [(t, c) for w, c in Counter(words).items() if (t := number(w)) is not None]
                    held.append(i)
                    ns.append(len(words))
                    terms.append([t for t, _ in found])
                    times.append([c for _, c in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(held, pa.int64())), pa.array(ns, pa.int64()),
                 pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "times"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def frequencies(stored: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term: a vector per task, summed; at most a row for each term comes back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(counts[held])], ["term", "df"])

    found = np.zeros(size, np.int64)
    for r in stored.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(
            F.sum("df").alias("df")).toLocalIterator():
        found[r["term"]] = r["df"]
    return found


def _best_of_all(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_items(docs: DataFrame, items: Items, k: int, id_col: str, text_col: str) -> DataFrame:
    spark, size = docs.sparkSession, max(len(items.vocabulary), 1)
    stored = durable(reduced(docs, items, id_col, text_col))
    total = stored.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    documents, length = total["documents"], total["length"] or 0
    weights = np.array([weight(documents, int(df)) if df else 0 for df in frequencies(stored, size)], np.int64)

    def searched(rows: DataFrame, floors: list[int]) -> DataFrame:
        sent = spark.sparkContext.broadcast(_Search(items, weights, documents, length, k, floors))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from sent.value.run(batches)

        return _best_of_all(rows.mapInArrow(run, "item int, item_id long, doc_id long, score long"), k)

    floors = [0] * len(items.ids)
    seeds = searched(stored.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEED_PART)) == 0), floors)
    for r in seeds.where(F.col("rank") == k).select("item", "score").toLocalIterator():  # a row for each item
        floors[r["item"]] = r["score"]
    return searched(stored, floors)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", item_chars: int = ITEM_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    ship_package(docs.sparkSession)
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    parts, ids, texts, chars = [], [], [], 0

    def finish() -> None:
        found = _search_items(docs, Items(ids, texts), k, id_col, text_col)
        parts.append(found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))

    for r in asked.toLocalIterator():  # a block of items at a time
        if ids and chars + len(r["text"] or "") > item_chars:
            finish()
            ids, texts, chars = [], [], 0
        ids.append(r["item_id"])
        texts.append(r["text"])
        chars += len(r["text"] or "")
    finish()
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found
