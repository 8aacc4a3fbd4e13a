"""Language identification by nearest centroid over TF-IDF character n-grams.

A text becomes a vector of its character 1- to 3-grams (letters lower-cased,
every run of other characters one blank), hashed into ``DIMS`` features,
weighted by log term frequency and inverse document frequency and normalised.
Each language has several centroids, found by spherical k-means; a text gets
the language of the centroid with the largest cosine.  A text that is farther
from its centroid than that centroid's limit is marked as rejected.  The limit
depends on how much a text says, that is on its number of different features,
since short and monotonous texts are far from every centroid: it is a share of a
low quantile of the cosines that the centroid's sample rows of that size have.

Document frequencies are counted over all training rows.  Only the clustering
uses a sample: ``SAMPLE`` different texts of each language (all, if there are
fewer), those of the smallest hashes.  Its size doesn't grow with the corpus, copies of a text
count once, and the model is the same however the rows are stored and split.

Defined results: ``und`` with score 0 for a null text or one without a letter
(and for all texts where nothing could be learned); ties go to the language
that comes first in order; repeated rows are predicted each; a row without
language is never learned from.  Whole texts are used, in pieces of bounded
size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import unused
from tallyfold.session import ship_package

DIMS = 4096
CENTROIDS = 4
SAMPLE = 400  # different texts of each language that the clustering sees
ROUNDS = 10
MAX_LANGUAGES = 1000  # more than this is refused, never cut
#: a text is rejected below this share of the cosine that all but ``LOW`` of the
#: centroid's own sample rows of its size reach (the language's, if it has too few)
REJECT_SHARE = 0.55
LOW = 0.05
LEAST_ROWS = 10  # fewer rows of a size are joined with those of the next larger one
SHORTER = 0.7  # limit of half the size, where there are no rows: about sqrt(1/2), as chance has it
SEEDS = 0.75  # this share of a language's rows, nearest to its mean, can start a cluster
TINY = 0.02  # clusters of a smaller share of the rows are dissolved
UNKNOWN = "und"

_CHUNK = 1 << 18
_BLANK = 32
_SHIFT = np.uint32(32 - DIMS.bit_length() + 1)
_MIX = np.uint32(2654435761)  # fixed: the golden-ratio multiplier


_LETTERS: list[np.ndarray] = []


def _is_letter(codes: np.ndarray) -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0][codes]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed 1- to 3-grams of a whole text; None without a letter."""
    counts, seen = np.zeros(DIMS, np.int64), False
    tail = np.array([_BLANK], np.uint32)
    text = text or ""
    for start in range(0, len(text), _CHUNK):
        piece = text[start:start + _CHUNK].lower().encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(piece, "<u4")
        letters = _is_letter(codes)
        seen = seen or bool(letters.any())
        codes = np.concatenate([tail, np.where(letters, codes, _BLANK).astype(np.uint32)])
        keep = np.ones(len(codes), bool)
        keep[len(tail):] = (codes[len(tail):] != _BLANK) | (codes[len(tail) - 1:-1] != _BLANK)
        codes, old = codes[keep], len(tail)
        grams = np.zeros(len(codes) + 1, np.uint32)
        for n in range(3):
            # grams of n + 1 codes; the first that end in the new codes is at old - n
            grams = grams[:-1] * np.uint32(65599) + codes[n:] + np.uint32(n + 1)
            counts += np.bincount((grams[max(0, old - n):] * _MIX) >> _SHIFT, minlength=DIMS)
        tail = codes[-2:]
    return counts if seen else None


@dataclass
class Model:
    """Everything a worker needs; its size is bounded by the number of languages."""

    idf: np.ndarray
    centroids: np.ndarray  # one row each, normalised
    languages: list[str]   # of each centroid, in order
    limits: np.ndarray     # least cosine that is not rejected, by centroid and size

    def vector(self, counts: np.ndarray) -> np.ndarray:
        return _vector(counts, self.idf)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine and whether the text is rejected."""
        counts = ngram_counts(text) if len(self.languages) else None
        if counts is None:
            return UNKNOWN, 0.0, True
        cosines = self.centroids @ self.vector(counts)
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        return self.languages[best], score, bool(score < self.limits[best, _size(np.count_nonzero(counts))])


def _vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.log1p(counts) * idf
    return weights / max(float(np.linalg.norm(weights)), 1e-12)


SIZES = DIMS.bit_length()


def _size(features: int) -> int:
    """Octave of a number of different features."""
    return max(1, int(features)).bit_length() - 1


def _k_means(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Normalised centres and labels by ``ROUNDS`` rounds.

    The start is farthest-first among the rows near the mean, and clusters of
    few rows are dissolved, so that no centre stands for odd rows only.
    """
    def assigned(centres: np.ndarray) -> np.ndarray:
        return np.argmax(vectors @ centres.T, axis=1)

    nearness = vectors @ vectors.mean(axis=0)
    order = np.argsort(-nearness, kind="stable")
    inner = vectors[order[:max(1, int(np.ceil(SEEDS * len(vectors))))]]
    centres = inner[:1]
    while len(centres) < min(k, len(inner)):
        centres = np.vstack([centres, inner[np.argmin((inner @ centres.T).max(axis=1))]])
    for _ in range(ROUNDS):
        labels = assigned(centres)
        sums = np.array([vectors[labels == i].sum(axis=0) for i in range(len(centres))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
    rows = np.bincount(assigned(centres), minlength=len(centres))
    centres = centres[rows >= min(rows.max(), max(1, TINY * len(vectors)))]
    return centres, assigned(centres)


def _limits(cosines: np.ndarray, features: np.ndarray, usual: np.ndarray | None = None) -> np.ndarray:
    """Least cosine by size; where there are too few rows of a size, ``usual`` holds if it is given."""
    sizes = np.array([_size(n) for n in features])
    if usual is not None:
        rows = [cosines[sizes == size] for size in range(SIZES)]
        return np.array([REJECT_SHARE * np.quantile(own, LOW) if len(own) >= LEAST_ROWS else other
                         for own, other in zip(rows, usual)])
    limits, waiting = np.full(SIZES, np.nan), np.zeros(0)
    for size in range(SIZES - 1, -1, -1):
        waiting = np.concatenate([waiting, cosines[sizes == size]])
        # the smallest size that has rows takes what is left, if there is no other
        if len(waiting) >= LEAST_ROWS or (np.isnan(limits).all() and len(waiting) and size == sizes.min()):
            limits[size] = REJECT_SHARE * np.quantile(waiting, LOW)
            waiting = np.zeros(0)
    known = np.flatnonzero(~np.isnan(limits))
    for size in range(SIZES):
        if np.isnan(limits[size]):
            above, below = known[known > size], known[known < size]
            limits[size] = limits[below[-1]] if len(below) else limits[above[0]] * SHORTER ** (above[0] - size)
    return np.minimum.accumulate(limits[::-1])[::-1]


def _document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts of all rows each feature occurs, and the number of texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(DIMS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts = ngram_counts(text.as_py())
                if counts is not None:
                    found[:DIMS] += counts > 0
                    found[DIMS] += 1
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(found[used])],
                                         ["feature", "n"])

    sums = rows.select("text").mapInArrow(count, "feature long, n long").groupBy("feature").agg(
        F.sum("n").alias("n")).collect()  # DIMS + 1 rows at most
    found = np.zeros(DIMS + 1, np.int64)
    for r in sums:
        found[r.feature] = r.n
    return found[:DIMS], int(found[DIMS])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Learn from every row of ``docs`` whose language is not null."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        F.col("lang").isNotNull())
    hashed = F.xxhash64("text")
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct(hashed).alias("texts")).limit(
        MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    frequency, total = _document_frequencies(rows)
    idf = np.log((total + 1) / (frequency + 1)) + 1
    if not sizes or not total:
        return Model(idf, np.zeros((0, DIMS)), [], np.zeros((0, SIZES)))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text, draw in zip(*(c.to_pylist() for c in batch.columns)):
                counts = ngram_counts(text)
                if counts is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([draw]),
                         pa.array([_vector(counts, idf).astype(np.float32)], pa.list_(pa.float32()))],
                        ["lang", "draw", "vector"])

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("draw").head(sample)
        points = np.array(group["vector"].tolist(), np.float64)
        centres, labels = _k_means(points, centroids)
        own = (points * centres[labels]).sum(axis=1)
        features = np.count_nonzero(points, axis=1)
        used, usual = np.unique(labels), _limits(own, features)
        return pd.DataFrame({
            "lang": group["lang"].iloc[0], "centre": [centres[i].tolist() for i in used],
            "least": [_limits(own[labels == i], features[labels == i], usual).tolist() for i in used]})

    shares = spark.createDataFrame(
        [(r["lang"], min(1.0, (1.2 * sample + 20) / max(1, r["texts"]))) for r in sizes], "lang string, share double")
    draw = (F.pmod(hashed, F.lit(1 << 52)) / (1 << 52)).alias("draw")
    drawn = rows.select("lang", "text", draw).join(F.broadcast(shares), "lang").where("draw < share")
    # copies meet before the shuffle
    drawn = drawn.groupBy("lang", "draw").agg(F.min("text").alias("text"))
    found = drawn.select("lang", "text", "draw").mapInArrow(
        vectors, "lang string, draw double, vector array<float>").groupBy("lang").applyInPandas(
        cluster, "lang string, centre array<double>, least array<double>")
    learned = sorted(found.collect(), key=lambda r: (r["lang"], r["centre"]))
    return Model(idf, np.array([r["centre"] for r in learned]).reshape(-1, DIMS),
                 [r["lang"] for r in learned], np.array([r["least"] for r in learned]).reshape(-1, SIZES))


def predict(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text",
            prefix: str = "") -> DataFrame:
    """``columns`` of docs, then lang_pred, score and rejected; no shuffle.

    ``prefix`` goes before the three names, for frames that have such columns.
    """
    ship_package(docs.sparkSession)
    added = [f"{prefix}{n}" for n in ("lang_pred", "score", "rejected")]
    rows = docs.select(*columns, F.col(text_col).alias(unused("__text", columns)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(len(columns))]
            made = [pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(columns)], *made], [*columns, *added])

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.select(*columns).dtypes)
    types = ", ".join(f"`{n}` {t}" for n, t in zip(added, ("string", "double", "boolean")))
    return rows.mapInArrow(run, f"{schema}, {types}")
