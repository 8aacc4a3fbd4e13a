"""Language-model scoring: interpolated modified Kneser-Ney over hashed bigrams.

Counting runs on Spark.  Tasks count the bigrams of some million tokens at a
time, and send each shard of the hash space its part as packed arrays; a
reducer adds up the parts of one shard.  Bigrams are dealt by a hash of both
words, so that a context which very many words follow is spread too; what each
bigram shard knows about a context (count, numbers of followers seen once,
twice, more often) and about a word (number of distinct predecessors) goes
through a second such step.

The model is a folder of sorted hash arrays, one file per table and shard with
its columns one after the other.  Workers map these files into memory and look up
whole batches of sorted keys by binary search, shard after shard, so a model
larger than a worker's memory costs page reads, not memory.  A worker keeps
``MAPPED`` files mapped at a time, however many there are.  Shards and batches
of lookups grow with the input, so that files per batch stay in proportion.  The folder must be mounted where executors run: it lies in the
shared folder of ``spark.checkpoint.dir``.

A text is lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and closed
by one end token.  A word is known by 64 bits of XXH64 (counts) and by 40 of
these in bigrams.

    p(w|v) = max(c(vw) - D(c), 0) / c(v) + g(v) p(w)
    p(w)   = max(k(w) - D'(k), 0) / K    + g' / (V + 1)

k(w) is the number of distinct predecessors, D and D' the three discounts of
each order, g what they take away, V the number of known words.

Defined results: a null or empty text is the end token alone; repeated rows
count as often as they occur; nothing to learn from gives every text score 0;
other columns are ignored.  Whole texts are used; a task holds eight bytes for each
word of its longest text.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.common import unused, word_runs
from tallyfold.session import checkpoint_dir, scratch_run, ship_package

FLUSH_TOKENS = 2_000_000   # counted together in a task
SHARD_BYTES = 4 << 20      # text for each shard, up to MANY_SHARDS; then it grows with the root of the text
MANY_SHARDS, LARGEST_SHARD = 1024, 32 << 20
LEAST_SHARD_BITS = 6
SCORE_TOKENS = 500_000     # looked up together, or so many for each shard
SCORE_TOKENS_PER_SHARD, MOST_SCORE_TOKENS = 256, 2_000_000
MAPPED = 64                # files that a worker keeps mapped
_WORD_BITS = 40
_WORD = np.uint64((1 << _WORD_BITS) - 1)
_START = xxhash.xxh64_intdigest(b" ")
_END = xxhash.xxh64_intdigest(b"\n")  # no word has white space
BIGRAM, WORD, CONTEXT, BEFORE = range(4)


def token_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words and of the end token."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    runs = [np.array([xxhash.xxh64_intdigest(w) for w in run], np.uint64) for run in word_runs(data)]
    return np.concatenate([*runs, np.array([_END], np.uint64)])


def bigram_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of two 40-bit words."""
    x = before * np.uint64(0x9E3779B97F4A7C15) ^ (word + np.uint64(0x7F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys; place of the first of each; sums of each value."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else order
    sums = [np.add.reduceat(v[order], first) if len(keys) else v for v in values]
    return [ordered[first], order[first], *sums]


def _pack(columns: list[tuple[np.ndarray, int]]) -> bytes:
    """Byte planes of whole-number columns, each with its number of low bytes."""
    return b"".join(c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T.tobytes() for c, n in columns)


def _unpack(payloads, widths: list[int]) -> list[np.ndarray]:
    """The columns of several packed parts, one after the other."""
    width, parts = sum(widths), [[] for _ in widths]
    for payload in payloads:
        planes = np.frombuffer(payload, np.uint8).reshape(width, -1)
        at = 0
        for part, n in zip(parts, widths):
            full = np.zeros((planes.shape[1], 8), np.uint8)
            full[:, :n] = planes[at:at + n].T
            part.append(full.view("<u8").reshape(-1))
            at += n
    return [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in parts]


# whole-number columns of a packed part, with their low bytes
_WIDTHS = {BIGRAM: [5, 5, 4], WORD: [8, 6], CONTEXT: [5, 6, 4, 4, 4], BEFORE: [5, 5]}


def _parts(kind: int, key: np.ndarray, bits: int, shard_bits: int,
           columns: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    """One packed part for each shard that has rows; ``key`` is sorted."""
    shard = (key >> np.uint64(bits - shard_bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(shard, prepend=-1))
    for start, end in zip(edges, [*edges[1:], len(shard)]):
        yield kind, int(shard[start]), _pack(
            [(c[start:end], n) for c, n in zip(columns, _WIDTHS[kind])])


def _count_tokens(docs: list[np.ndarray], shard_bits: int) -> Iterator[tuple[int, int, bytes]]:
    words = np.concatenate(docs)
    key, _, n = _summed(words, np.ones(len(words), np.uint64))
    yield from _parts(WORD, key, 64, shard_bits, [key, n])
    short = words & _WORD
    before = np.empty_like(short)
    before[1:] = short[:-1]
    before[np.cumsum([0, *map(len, docs[:-1])])] = np.uint64(_START) & _WORD
    key, at, n = _summed(bigram_key(before, short), np.ones(len(words), np.uint64))
    yield from _parts(BIGRAM, key, 64, shard_bits, [before[at], short[at], n])


def _write(folder: str, table: str, shard: int, columns: list[np.ndarray]) -> None:
    """One shard as a file: number of rows, bytes of a value in each column, the columns (each
    from a multiple of eight bytes on).  A file appears whole or not at all, and a retry replaces it."""
    # whole numbers in as few bytes as the shard needs, but for the key
    narrow = [c if i == 0 or not len(c) else c.astype(np.min_scalar_type(int(c.max())))
              for i, c in enumerate(columns)]
    path = os.path.join(folder, f"{table}-{shard:08d}")
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "wb") as f:
        f.write(np.array([len(columns[0]), *(c.itemsize for c in narrow)], "<u8").tobytes())
        for column in narrow:
            f.write(column.tobytes())
            f.write(bytes(-column.nbytes % 8))
    os.replace(draft, path)


def _read(path: str, columns: int) -> list[np.ndarray]:
    """The mapped columns of a file."""
    data = np.memmap(path, np.uint8, "r")
    at = 8 * (1 + columns)
    rows, *sizes = data[:at].view("<u8").tolist()
    found = []
    for size in sizes:
        found.append(data[at:at + rows * size].view(f"<u{size}"))
        at += -(-rows * size // 8) * 8
    return found


def shard_bits_for(size: int) -> int:
    """Bits of the shard number for so many bytes of text."""
    grown = SHARD_BYTES * max(1.0, size / (MANY_SHARDS * SHARD_BYTES)) ** 0.5
    return max(LEAST_SHARD_BITS, int(size / min(grown, LARGEST_SHARD)).bit_length())


def _of_counts(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def _discounts(of_counts: list[int]) -> np.ndarray:
    """D1, D2 and D3+ from the numbers of counts 1 to 4 (each below its count)."""
    n1, n2, n3, n4 = of_counts
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    found = [k - (k + 1) * y * more / n if n else 0.5 * k
             for k, n, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(min(max(d, 0.05 * k), 0.95 * k) for k, d in enumerate(found, 1))])


@dataclass
class Model:
    """Where the arrays lie, and the few numbers that hold for all of them."""

    folder: str
    shard_bits: int
    tokens: int
    words: int
    distinct: int            # K
    bigram_discounts: np.ndarray
    word_discounts: np.ndarray
    word_backoff: float      # g'
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def lookup(self, table: str, keys: np.ndarray, bits: int, names: list[str]) -> list[np.ndarray]:
        """Columns for sorted keys (0 where a key is absent)."""
        found = [np.zeros(len(keys), np.float64) for _ in names]
        shard = (keys >> np.uint64(bits - self.shard_bits)).astype(np.int64)
        edges = np.flatnonzero(np.diff(shard, prepend=-1))
        for start, end in zip(edges, [*edges[1:], len(keys)]):
            arrays = self._arrays(table, int(shard[start]), ["key", *names])
            if arrays is None or not len(arrays[0]):
                continue
            at = np.minimum(np.searchsorted(arrays[0], keys[start:end]), len(arrays[0]) - 1)
            hit = arrays[0][at] == keys[start:end]
            for out, values in zip(found, arrays[1:]):
                out[start:end] = np.where(hit, values[at], 0)
        return found

    def _arrays(self, table: str, shard: int, names: list[str]) -> list[np.ndarray] | None:
        """A shard's columns; those used longest ago are unmapped."""
        arrays = self._open.pop((table, shard), None)
        if arrays is None:
            path = os.path.join(self.folder, f"{table}-{shard:08d}")
            if not os.path.exists(path):
                return None
            arrays = _read(path, len(names))
            if len(self._open) >= MAPPED:
                del self._open[next(iter(self._open))]
        self._open[table, shard] = arrays
        return arrays

    def score(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        """n_tokens, n_known, base score and score of each document."""
        words = np.concatenate(docs)
        starts = np.cumsum([0, *map(len, docs[:-1])])
        types, of = np.unique(words, return_inverse=True)
        count, = self.lookup("word", types, 64, ["n"])
        base = np.log10((count + 0.5) / (self.tokens + 0.5 * (self.words + 1)))
        if self.tokens:
            short, of_short = np.unique(types & _WORD, return_inverse=True)
            k, = self.lookup("before", short, _WORD_BITS, ["n"])
            plain = np.maximum(k - self.word_discounts[np.minimum(k, 3).astype(int)], 0) / self.distinct
            plain = (plain + self.word_backoff / (self.words + 1))[of_short][of]
            before = np.empty_like(words)
            before[1:] = words[:-1]
            before[starts] = _START
            contexts, of_context = np.unique(before & _WORD, return_inverse=True)
            total, n1, n2, n3 = self.lookup("context", contexts, _WORD_BITS, ["n", "n1", "n2", "n3"])
            d = self.bigram_discounts
            rest = np.where(total > 0, (d[1] * n1 + d[2] * n2 + d[3] * n3) / np.maximum(total, 1), 1.0)
            pairs, of_pair = np.unique(bigram_key(before & _WORD, words & _WORD), return_inverse=True)
            c, = self.lookup("bigram", pairs, 64, ["n"])
            c = np.maximum(c - d[np.minimum(c, 3).astype(int)], 0)[of_pair]
            total, rest = np.maximum(total, 1)[of_context], rest[of_context]
            score = np.log10(np.minimum(c / total + rest * plain, 1.0))
        else:
            score = np.zeros(len(words))
        sizes = np.array([len(d) for d in docs])
        return [sizes, np.add.reduceat((count > 0).astype(np.int64)[of], starts),
                np.add.reduceat(base[of], starts), np.add.reduceat(score, starts)]

    def remove(self) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


def model_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder, as a mounted path."""
    place = urlparse(checkpoint_dir(spark))
    if place.scheme not in ("", "file"):
        raise ValueError("workers map the model into memory: give a folder on a mounted file system")
    return os.path.join(os.path.abspath(place.path), f"lm-{uuid.uuid4().hex}")


def train(docs: DataFrame, folder: str | None = None, text_col: str = "text") -> Model:
    """Count all rows of ``docs`` and write the model's arrays to ``folder``."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or model_folder(spark)
    os.makedirs(folder, exist_ok=True)
    rows = docs.select(F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shard_bits = shard_bits_for(size)
    schema = "kind int, shard long, payload binary"

    def arrow(parts: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        kinds, shards, payloads = zip(*parts)
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.int32()), pa.array(shards, pa.int64()), pa.array(payloads, pa.binary())],
            ["kind", "shard", "payload"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(token_hashes(text.as_py()))
                n += len(held[-1])
                if n >= FLUSH_TOKENS:
                    yield arrow(list(_count_tokens(held, shard_bits)))
                    held, n = [], 0
        if held:
            yield arrow(list(_count_tokens(held, shard_bits)))

    def add_up(group: pd.DataFrame) -> pd.DataFrame:
        kind, shard = int(group["kind"].iloc[0]), int(group["shard"].iloc[0])
        columns = _unpack(group["payload"], _WIDTHS[kind])
        made: list[tuple[int, int, bytes]] = []
        stats = [0] * 6
        if kind == WORD:
            key, _, n = _summed(columns[0], columns[1])
            _write(folder, "word", shard, [key, n])
            stats[4:] = int(n.sum()), len(key)
        elif kind == BIGRAM:
            before, word, parts = columns
            key, at, n = _summed(bigram_key(before, word), parts)
            _write(folder, "bigram", shard, [key, n])
            before, word = before[at], word[at]
            key, _, *sums = _summed(before, n, *((n == k).astype(np.uint64) for k in (1, 2)),
                                    (n > 2).astype(np.uint64))
            made += _parts(CONTEXT, key, _WORD_BITS, shard_bits, [key, *sums])
            key, _, n_before = _summed(word, np.ones(len(word), np.uint64))
            made += _parts(BEFORE, key, _WORD_BITS, shard_bits, [key, n_before])
            stats[:4] = _of_counts(n)
        elif kind == CONTEXT:
            key, _, *sums = _summed(columns[0], *columns[1:])
            _write(folder, "context", shard, [key, *sums])
        else:
            key, _, n = _summed(*columns)
            _write(folder, "before", shard, [key, n])
            stats[:] = *_of_counts(n), int(n.sum()), int((n > 2).sum())
        # the numbers that hold for the whole model travel as a part of shard -1
        made.append((kind, -1, np.array(stats, "<i8").tobytes()))
        return pd.DataFrame(made, columns=["kind", "shard", "payload"])

    def totals(stored: DataFrame, kind: int) -> np.ndarray:
        """Sum of the reducers' numbers: six longs a shard, added by tasks first."""
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(6, np.int64)
            for batch in batches:
                for payload in batch.column(0):
                    total += np.frombuffer(payload.as_py(), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total.tolist()], list("abcdef"))

        sums = stored.where((F.col("kind") == kind) & (F.col("shard") == -1)).select("payload").mapInArrow(
            add, ", ".join(f"{c} long" for c in "abcdef")).agg(*[F.sum(c) for c in "abcdef"]).first()
        return np.array([x or 0 for x in sums], np.int64)

    def reduced(parts: DataFrame) -> DataFrame:
        out = parts.groupBy("kind", "shard").applyInPandas(add_up, schema)
        # stored once: the reducers' files and their numbers come from the same run
        out.write.parquet(target := f"{stage}/{uuid.uuid4().hex}")
        return spark.read.schema(schema).parquet(target)

    with scratch_run(spark) as stage:
        first = reduced(rows.mapInArrow(count, schema))
        second = reduced(first.where("shard >= 0"))
        word, bigram, before = totals(first, WORD), totals(first, BIGRAM), totals(second, BEFORE)
    d = _discounts(before[:4].tolist())
    taken = d[1] * before[0] + d[2] * before[1] + d[3] * before[5]
    return Model(folder, shard_bits, int(word[4]), int(word[5]), max(int(before[4]), 1),
                 _discounts(bigram[:4].tolist()), d, float(taken) / max(int(before[4]), 1))


def score(docs: DataFrame, model: Model, columns: list[str | Column], text_col: str = "text") -> DataFrame:
    """``columns`` of docs, n_tokens, n_known, train_tokens, base_score, score; no shuffle."""
    ship_package(docs.sparkSession)
    kept = docs.select(*columns)
    names = kept.columns
    rows = docs.select(*columns, F.col(text_col).alias(unused("__text", names)))
    together = max(SCORE_TOKENS, min(MOST_SCORE_TOKENS, SCORE_TOKENS_PER_SHARD << model.shard_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, n = 0, [], 0
            for i, text in enumerate(batch.column(len(names)), 1):
                held.append(token_hashes(text.as_py()))
                n += len(held[-1])
                if n >= together or i == batch.num_rows:
                    sizes, known, base, found = model.score(held)
                    yield pa.RecordBatch.from_arrays(
                        [*(c.slice(start, i - start) for c in batch.columns[:len(names)]),
                         pa.array(sizes, pa.int64()), pa.array(known, pa.int64()),
                         pa.array([model.tokens] * len(held), pa.int64()),
                         pa.array(base, pa.float64()), pa.array(found, pa.float64())],
                        [*names, "n_tokens", "n_known", "train_tokens", "base_score", "score"])
                    start, held, n = i, [], 0

    schema = ", ".join(f"`{n}` {t}" for n, t in kept.dtypes)
    return rows.mapInArrow(run, f"{schema}, n_tokens long, n_known long, train_tokens long, "
                                "base_score double, score double")
