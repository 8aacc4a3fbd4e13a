"""BPE encoding and decoding with a public word-level vocabulary file.

A word starts as a doubly linked list of its symbols.  A priority queue holds
the merge rank of every adjacent pair; the best pair is merged, its two new
neighbour pairs are queued, and entries whose symbols have changed meanwhile
are skipped as stale.  Decoding joins the vocabulary strings of the ids by one
space, as the vocabulary file (which names no decoder) asks for.

The vocabulary file is read on the driver and sent once to each executor.  Its
path is a parameter.  Results of pieces between white space are kept in a
two-generation cache of bounded size per task, so that frequent words cost one
lookup and memory doesn't grow with the corpus.

Defined results: a null text counts as empty; an empty text has no tokens and
decodes to the empty text; repeated rows are encoded each.  Texts of any
length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import slices
from tallyfold.session import ship_package

CACHE_PIECES = 300_000  # entries a generation, about 200 bytes each
_BATCH_CHARS = 4 << 20
_ID, _RANK = 20, 60  # bits of an id, and where a rank begins above id and place
_SYMBOL, _PLACE = (1 << _ID) - 1, (1 << _RANK - _ID) - 1
# fixed: what the white-space class of the vocabulary's normaliser matches
_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
_MARKS = ".,;:!?*#$%&()[]{}|+=<>/~^_-"
_MARK_RUNS = re.compile(r"[.,][ \n](?<![^\W_][.,][ \n])")
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to str.split(), not to the normaliser


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in such vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [hidden.get(b, chr(b)) for b in range(256)]


class _Pieces(dict):
    """Ids (as bytes) of pieces between white space, in two generations.

    When the young generation is full it becomes the old one.  A word followed
    by punctuation is put together from two entries and not kept.
    """

    def __init__(self, make, limit: int):
        super().__init__()
        self._make, self._limit, self._old = make, limit, {}

    def __missing__(self, piece: str) -> bytes:
        word = piece.rstrip(_MARKS)
        if word.isalpha() and word != piece:
            return self[word] + self[piece[len(word):]]
        ids = self._old.get(piece)
        if ids is None:
            ids = self._make(piece)
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, spec: dict, cache: int = CACHE_PIECES):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in [*self.vocab.items(), *self.special.items()]}
        # pair of ids -> rank and merged id, each packed into one integer
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a] << _ID | self.vocab[b]] = rank << _RANK | self.vocab[a + b]
        self._first = [self.vocab[c] for c in byte_symbols()]
        self._last = [self.vocab[c + self.suffix] for c in byte_symbols()]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._words = regex.compile(split["pattern"]["Regex"])
        self._split_special = regex.compile(
            "(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._cache = cache
        self.forget()

    def forget(self) -> None:
        """Give back the memory of the cached pieces."""
        self._pieces = _Pieces(self._merge_piece, self._cache)

    def merge_word(self, word: str) -> list[int]:
        """Ids of one word, merged in order of rank and, among equals, of place."""
        data = word.encode("utf-8", "surrogatepass")
        first, merges = self._first, self.merges
        ids = [first[b] for b in data]
        ids[-1] = self._last[data[-1]]
        end = len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        # an entry holds rank, place and merged id; ``valid`` has the one that
        # still holds for a place, all other entries in the queue are stale
        valid = [0] * end
        for i in range(end - 1):
            if found := merges.get(ids[i] << _ID | ids[i + 1]):
                valid[i] = found | i << _ID
        queue = [entry for entry in valid if entry]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i = entry >> _ID & _PLACE
            if valid[i] != entry:
                continue
            ids[i] = merged = entry & _SYMBOL
            j = after[i]
            ids[j], valid[j], valid[i] = -1, 0, 0
            k = after[i] = after[j]
            if k < end:
                before[k] = i
                if found := merges.get(merged << _ID | ids[k]):
                    valid[i] = found | i << _ID
                    heapq.heappush(queue, valid[i])
            h = before[i]
            if h >= 0:
                valid[h] = 0
                if found := merges.get(ids[h] << _ID | merged):
                    valid[h] = found | h << _ID
                    heapq.heappush(queue, valid[h])
        return [i for i in ids if i >= 0]

    def _merge_piece(self, piece: str) -> bytes:
        words = [piece] if piece.isalpha() else self._words.findall(piece)
        return np.array([i for w in words for i in self.merge_word(w)], "<i4").tobytes()

    def _plain_ids(self, text: str) -> bytes:
        # sigma first, so that no letter is lowered by its context
        plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if not _MARK_RUNS.search(plain):
            # a mark after a letter or digit is a word of its own: set it apart
            for mark in (", ", ". ", ",\n", ".\n"):
                plain = plain.replace(mark, " " + mark)
        if _SEPARATORS.search(plain):
            return b"".join([self._pieces[p] for p in _SPACE.split(plain) if p])
        return b"".join(map(self._pieces.__getitem__, plain.split()))

    def ids_of(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; the strings of special tokens stand for themselves."""
        text = text or ""
        if self._split_special is None or "<|" not in text:
            return np.frombuffer(self._plain_ids(text), "<i4")
        parts = [np.array([self.special[p]], "<i4").tobytes() if p in self.special
                 else self._plain_ids(p) for p in self._split_special.split(text)]
        return np.frombuffer(b"".join(parts), "<i4")

    def encode(self, text: str | None) -> list[int]:
        return self.ids_of(text).tolist()

    def decode(self, ids) -> str:
        strings = self.strings
        return " ".join(map(strings.__getitem__, ids))


_ENCODERS: dict[str, WordBpe] = {}


def _encoder(spec: "_Spec") -> WordBpe:
    """This worker's encoder; a worker, which Spark uses again, keeps the last one only."""
    if spec.digest not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[spec.digest] = WordBpe(json.loads(spec.sent.value))
    return _ENCODERS[spec.digest]


class _Spec:
    """The vocabulary file's content as a broadcast variable (a fixed size, under 2 MB here)."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            text = f.read()
        self.digest = hashlib.sha256(text.encode()).hexdigest()
        self.sent = spark.sparkContext.broadcast(text)


def _encoded(bpe: WordBpe, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = [v or 0 for v in pc.binary_length(batch.column(1)).to_pylist()]
    for start, end in slices(sizes, _BATCH_CHARS):
        found = [bpe.ids_of(batch.column(1)[i].as_py()) for i in range(start, end)]
        offsets = np.cumsum([0, *map(len, found)])
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(start, end - start), ids,
             pa.array([bpe.decode(x.tolist()) for x in found], pa.string()),
             *(c.slice(start, end - start) for c in batch.columns[2:])],
            ["doc_id", "ids", "decoded", *batch.schema.names[2:]])


def bpe_round_trip(docs: DataFrame, vocab_path: str, id_col: str = "doc_id",
                   text_col: str = "text", columns: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ids (array of int), decoded (string) and ``columns``: every whole text, no shuffle."""
    ship_package(docs.sparkSession)
    spec = _Spec(docs.sparkSession, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(spec)
        try:
            for batch in batches:
                yield from _encoded(bpe, batch)
        finally:  # the worker lives on, for other stages too
            bpe.forget()
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *columns)
    kept = "".join(f", `{n}` {t}" for n, t in rows.dtypes[2:])
    return rows.mapInArrow(run, f"doc_id long, ids array<int>, decoded string{kept}")


def bpe_decode(tokens: DataFrame, vocab_path: str, id_col: str = "doc_id",
               ids_col: str = "ids") -> DataFrame:
    """doc_id, decoded: the text of stored ids (null ids decode to the empty text)."""
    ship_package(tokens.sparkSession)
    spec = _Spec(tokens.sparkSession, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(spec)
        for batch in batches:
            texts = [bpe.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "decoded"])

    rows = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded string")


def digests(round_trip: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of :func:`bpe_round_trip`'s rows."""
    return round_trip.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
