"""Alignment of two tokenizers' tokens by the bytes they cover, with counts over the corpus.

A text, with a space before it, is encoded by a byte-level BPE (A) and a piece
model (B).  Where tokens of both end at the same byte, the text is cut into
groups; tokens whose bytes overlap are linked.  Nearly all groups of usual
texts are one token on each side with the same bytes.  For these an identity
map, made once from the vocabularies, holds the B id of every A id, and the
number of documents that have such a link is counted in a vector as long as
A's vocabulary.  Only the links of other, irregular groups become pairs of ids
that are counted by a shuffle.

A is encoded with its merges as ranks where the vocabulary file allows it and the
text's characters have kept their class in all Unicode versions; any other text
goes through the file's own tokenizer.  A batch of texts is aligned at once by
the sorted byte ends of both token rows.  A very long text is cut at single
spaces between two characters that are no white space: neither tokenizer joins
anything over such a space, and both see what follows as they see the start of
a text, so its parts give the tokens of the whole.

Each document's links are stored once.  Counts go back to them in two ways:
the vectors and the pairs with more than 1/``HOT_PAIRS`` of all pair rows, of
which there are fewer than ``HOT_PAIRS``, are sent to every worker; all other
pairs, none of them frequent, meet their counts in a join.

Defined results: a text that is null or empty, or that the bytes of A's or B's
tokens don't give back, has no tokens; repeated rows and equal ids are aligned
and counted each; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.bpe import byte_symbols
from tallyfold.llm.common import durable, slices
from tallyfold.session import scratch_path, ship_package

HOT_PAIRS = 1 << 18
PART_CHARS = 1 << 20
_BATCH_CHARS = 1 << 20
_SPACE = "▁"  # fixed: the piece model's sign for a space
_BYTE = re.compile("<0x([0-9A-F]{2})>")
_CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
# fixed: how the byte-level vocabulary cuts a text into words
_WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# characters outside blocks whose letters and digits are the same in all Unicode versions in use
_UNSETTLED = re.compile(
    "[^\x00-\u052f\u2000-\u206f\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\U0001f300-\U0001f64f]")


def parts_of(text: str, size: int) -> list[str]:
    """The text between some spaces where both tokenizers start anew, in parts of ``size`` characters or more."""
    parts, start = [], 0
    while start + size < len(text) and (cut := _CUT.search(text, start + size)):
        parts.append(text[start:cut.start()])
        start = cut.end()
    return [*parts, text[start:]]


class Aligned(NamedTuple):
    """Alignment of a batch of texts: numbers a text, groups as text, links and the text of each."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    link_text: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_same: np.ndarray


class Aligner:
    """Both tokenizers and the identity map between them."""

    def __init__(self, a_spec: str, b_model: bytes, part_chars: int = PART_CHARS):
        self._a = tokenizers.Tokenizer.from_str(a_spec)
        self._a.encode_special_tokens = True
        self._a.no_truncation()
        self._a.no_padding()
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte_of = {s: bytes([i]) for i, s in enumerate(byte_symbols())}
        self.n_a, self.n_b = self._a.get_vocab_size(), self._b.get_piece_size()
        self.a_bytes = [b""] * self.n_a
        for token, i in self._a.get_vocab().items():
            self.a_bytes[i] = b"".join(byte_of.get(c, c.encode()) for c in token)
        self.b_bytes, plain = [], {}
        for i in range(self.n_b):
            piece = self._b.id_to_piece(i)
            if self._b.is_byte(i):
                self.b_bytes.append(bytes([int(_BYTE.fullmatch(piece)[1], 16)]))
            else:
                self.b_bytes.append(piece.replace(_SPACE, " ").encode())
                if not self._b.is_control(i) and not self._b.is_unknown(i):
                    plain[self.b_bytes[i]] = i
        #: the B id with the same bytes, of every A id; -1 where there is none
        self.same = np.array([plain.get(b, -1) for b in self.a_bytes], np.int64)
        # a piece that holds a space after another character would cross the cuts
        joins = any(re.search(f"[^{_SPACE}]{_SPACE}", self._b.id_to_piece(i)) for i in range(self.n_b))
        self._part_chars = None if joins else part_chars
        self._ranked = self._ranked_encoding(json.loads(a_spec))
        self._a_sizes, self._b_sizes = (np.array([len(x) for x in c], np.int64) for c in (self.a_bytes, self.b_bytes))
        # an id as text with the sign that follows it, inside a group and at the end of its side
        self._signed = np.array([f"{i}{sign}" for n, end in ((self.n_a, "|"), (self.n_b, ";"))
                                 for sign in (",", end) for i in range(n)], object)

    def _ranked_encoding(self, spec: dict) -> tiktoken.Encoding | None:
        """A's merges as ranks, if each merge makes the next id and the words are cut in the usual way."""
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if any(x >= y for x, y in zip(made, made[1:])) or spec["normalizer"] or not (
                usual.items() <= spec["pre_tokenizer"].items()):
            return None
        special = {t["content"] for t in spec["added_tokens"]}
        return tiktoken.Encoding("a", pat_str=_WORDS, special_tokens={}, mergeable_ranks={
            self.a_bytes[i]: i for token, i in vocab.items() if token not in special})

    @property
    def key_type(self) -> str:
        return "int" if self.n_a * self.n_b < 1 << 31 else "long"

    def encode_a(self, text: str) -> np.ndarray:
        if self._ranked is None or _UNSETTLED.search(text):
            return np.array(self._a.encode(text, add_special_tokens=False).ids, np.int64)
        return np.array(self._ranked.encode_ordinary(text), np.int64)

    def align(self, texts: list[str | None]) -> Aligned:
        """The alignment of every text with a space before it; none where bytes differ."""
        parts = [(i, part) for i, text in enumerate(texts) if text
                 for part in (parts_of(text, self._part_chars) if self._part_chars else [text])]
        both = [(i, part, self.encode_a(f" {part}"), b) for (i, part), b in zip(
            parts, self._b.encode([part for _, part in parts], num_threads=1))] if parts else []
        a_bytes, b_bytes = self.a_bytes, self.b_bytes
        other = {i for i, part, a, b in both if not (
            b"".join([a_bytes[x] for x in a.tolist()]) == f" {part}".encode() == b"".join([b_bytes[x] for x in b]))}
        both = [x for x in both if x[0] not in other]
        a = np.concatenate([x[2] for x in both] or [np.empty(0, np.int64)])
        b = np.array([i for x in both for i in x[3]], np.int64)
        text_a = np.repeat([x[0] for x in both], [len(x[2]) for x in both]).astype(np.int64)
        text_b = np.repeat([x[0] for x in both], [len(x[3]) for x in both]).astype(np.int64)
        ends_a, ends_b = np.cumsum(self._a_sizes[a]), np.cumsum(self._b_sizes[b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        # no token ends inside the stretch before an end, so each stretch is one link
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)

        def count(text: np.ndarray) -> np.ndarray:
            return np.bincount(text, minlength=len(texts))

        n_a, n_b = count(text_a), count(text_b)
        signed = np.empty(len(a) + len(b), np.int64)
        signed[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = a + self.n_a * (cuts[group_a] == ends_a)
        signed[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = (
            b + 2 * self.n_a + self.n_b * (cuts[group_b] == ends_b))
        words, stops = self._signed[signed].tolist(), np.cumsum(n_a + n_b).tolist()
        groups = ["".join(words[i:j])[:-1] for i, j in zip([0, *stops], stops)]
        return Aligned(n_a, n_b, count(text_a[np.searchsorted(ends_a, cuts)]), count(text_a[at_a]), groups,
                       text_a[at_a], a[at_a], b[at_b], self.same[a[at_a]] == b[at_b])


_ALIGNERS: dict[str, Aligner] = {}


class _Spec:
    """Both vocabulary files as a broadcast variable (fixed sizes, about 2 MB together)."""

    def __init__(self, spark, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as f:
            a = f.read()
        with open(b_path, "rb") as f:
            b = f.read()
        self.digest = hashlib.sha256(a.encode() + b).hexdigest()
        self.sent = spark.sparkContext.broadcast((a, b))

    def aligner(self) -> Aligner:
        """This worker's aligner; a worker, which Spark uses again, keeps the last one only."""
        if self.digest not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[self.digest] = Aligner(*self.sent.value)
        return _ALIGNERS[self.digest]


def _distinct(text: np.ndarray, value: np.ndarray, size: int, texts: int, kind: pa.DataType) -> list[pa.Array]:
    """The distinct values of each text and how often each occurs, as list columns."""
    found, times = np.unique(text * size + value, return_counts=True)
    offsets = pa.array(np.searchsorted(found, np.arange(texts + 1) * size), pa.int32())
    return [pa.ListArray.from_arrays(offsets, pa.array(x, k)) for x, k in ((found % size, kind), (times, pa.int32()))]


def _batch(aligner: Aligner, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = [v or 0 for v in pc.binary_length(batch.column(1)).to_pylist()]
    key, pair_keys = pa.int32() if aligner.key_type == "int" else pa.int64(), aligner.n_a * aligner.n_b
    for start, end in slices(sizes, _BATCH_CHARS):
        rows, n = aligner.align(batch.column(1).slice(start, end - start).to_pylist()), end - start
        same, other = rows.link_same, ~rows.link_same
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(start, n), *map(pa.array, rows[:4]), pa.array(rows.groups, pa.string()),
             *_distinct(rows.link_text[same], rows.link_a[same], aligner.n_a, n, pa.int32()),
             *_distinct(rows.link_text[other], rows.link_a[other] * aligner.n_b + rows.link_b[other], pair_keys, n, key)],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "same", "same_n", "pairs", "pairs_n"])


class Vocabularies:
    """The two tokenizers, named by the paths of their files."""

    def __init__(self, spark, a_path: str, b_path: str):
        ship_package(spark)
        self.spec = _Spec(spark, a_path, b_path)
        here = self.spec.aligner()
        self.n_a, self.n_b, self.key_type = here.n_a, here.n_b, here.key_type


def align(docs: DataFrame, vocabularies: Vocabularies, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's alignment, one pass without a shuffle.

    doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2``); distinct
    links with their numbers of occurrences: ``same`` holds A ids whose B id is
    that of the identity map, ``pairs`` all others as a * n_b + b.
    """
    spec = vocabularies.spec

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = spec.aligner()
        for batch in batches:
            yield from _batch(aligner, batch)
        pa.default_memory_pool().release_unused()  # the worker lives on, for other stages too

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, same array<int>, "
        f"same_n array<int>, pairs array<{vocabularies.key_type}>, pairs_n array<int>"))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and the number of its row for each."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), lengths)


def same_counts(aligned: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """a, n: documents that link an A id with its identity; a vector per task, summed."""
    size = vocabularies.n_a

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            counts += np.bincount(_flat(batch.column(0))[0], minlength=size)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(counts[held])], ["a", "n"])

    vectors = aligned.select("same").mapInArrow(run, "a int, n long")
    return vectors.groupBy("a").agg(F.sum("n").alias("n"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """key, n: documents that hold a link of any other pair; added up before the shuffle."""
    return aligned.select(F.explode("pairs").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


class _Known:
    """What every worker gets: vectors of A's length and the hot pairs, sorted."""

    def __init__(self, n_same: np.ndarray, most: np.ndarray, hot: np.ndarray, hot_n: np.ndarray):
        self.n_same, self.most, self.hot, self.hot_n = n_same, most, hot, hot_n

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key among the hot pairs, and whether it is one."""
        if not len(self.hot):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.hot, keys), len(self.hot) - 1)
        return at, self.hot[at] == keys


def _vector(rows: DataFrame, value: str, size: int) -> np.ndarray:
    found = np.zeros(size, np.int64)
    for r in rows.select("a", value).toLocalIterator():  # at most a row for each A id
        found[r["a"]] = r[value]
    return found


def score_links(aligned: DataFrame, vocabularies: Vocabularies, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """The columns of ``aligned`` but its lists, with n_best and count_sum.

    n_best: links whose pair is held by as many documents as the most frequent
    pair of their A id; count_sum: the sum of these numbers over the links.
    """
    spark, n_b = aligned.sparkSession, vocabularies.n_b
    lists = ["same", "same_n", "pairs", "pairs_n"]
    kept = [c for c in aligned.columns if c not in lists]
    path, counts_path = scratch_path(spark, "aligned"), scratch_path(spark, "pair-counts")
    aligned.withColumn("rid", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    pair_counts(stored).write.parquet(counts_path)
    pairs = spark.read.parquet(counts_path).withColumn("a", F.expr(f"cast(key div {n_b} as int)"))

    same = durable(same_counts(stored, vocabularies))
    most = durable(same.unionByName(pairs.groupBy("a").agg(F.max("n").alias("n"))).groupBy("a").agg(
        F.max("n").alias("most")))
    least = (pairs.agg(F.sum("n")).first()[0] or 0) // hot_pairs
    hot = pairs.where(F.col("n") > least).select("key", "n").toPandas()  # fewer than hot_pairs rows
    hot = hot.sort_values("key")
    known = spark.sparkContext.broadcast(_Known(
        _vector(same, "n", vocabularies.n_a), _vector(most, "most", vocabularies.n_a),
        hot["key"].to_numpy(np.int64), hot["n"].to_numpy(np.int64)))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = known.value
        for batch in batches:
            total, best = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            ids, row = _flat(batch.column(1))
            times, n = _flat(batch.column(2))[0].astype(np.int64), k.n_same[ids]
            np.add.at(total, row, times * n)
            np.add.at(best, row, times * (n == k.most[ids]))
            keys, row = _flat(batch.column(3))
            times, (at, held) = _flat(batch.column(4))[0].astype(np.int64), k.places(keys)
            n = k.hot_n[at[held]]
            np.add.at(total, row[held], times[held] * n)
            np.add.at(best, row[held], times[held] * (n == k.most[keys[held] // n_b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best), pa.array(total), *batch.columns[5:]],
                ["rid", "n_best", "count_sum", *kept])

    def cold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = known.value
        for batch in batches:
            keys, row = _flat(batch.column(1))
            left = ~k.places(keys)[1]
            rid = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid[row[left]]), pa.array(keys[left], pa.int64()),
                 pa.array(_flat(batch.column(2))[0][left], pa.int32())], ["rid", "key", "times"])

    types = dict(aligned.dtypes)
    rows = stored.select("rid", *lists, *kept).mapInArrow(
        sums, "rid long, n_best long, count_sum long, " + ", ".join(f"`{c}` {types[c]}" for c in kept))
    rare = stored.select("rid", "pairs", "pairs_n").mapInArrow(cold, "rid long, key long, times int")
    # a pair's count and whether it is its A id's highest; n is at most ``least`` here, so no key is hot
    rare_counts = pairs.where(F.col("n") <= least).join(most, "a").select(
        F.col("key").cast("long").alias("key"), "n", (F.col("n") == F.col("most")).alias("best"))
    rare_sums = rare.join(rare_counts, "key").groupBy("rid").agg(
        F.sum(F.col("times") * F.col("n")).alias("more"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    found = durable(rows.join(rare_sums, "rid", "left").select(
        *kept, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum")))
    known.unpersist()
    for used in (path, counts_path):
        gone = spark._jvm.org.apache.hadoop.fs.Path(used)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return found


def digests(aligned: DataFrame) -> DataFrame:
    """``aligned`` with a digest in place of the groups; empty where there are no tokens."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.withColumn("groups_sha256", digest).drop("groups")
