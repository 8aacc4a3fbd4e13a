"""Staged string-distance join of typed place names to an official list.

Semantics (per submitted triple of place texts, duplicates counted):

1. every official row is a candidate; distances are case-insensitive Jaro
   distances per level;
2. level 1: if some candidate matches the first level exactly, keep only
   exact ones; otherwise keep the nearest ``caps[0]`` with ties (min-rank);
3. level 2: the same on the second level among the survivors, cap ``caps[1]``;
4. level 3: keep the survivors with the smallest
   ``(d2 + 1) * (d3 + 1) + d3``, ties kept.

Ranks count each official row once per submission carrying the same
triple (``weight_duplicates=True``), as grouping by the texts does.

How it runs: the records are reduced to distinct triples with their
multiplicity ``k``.  Level 1 takes the distinct typed and the distinct official
first-level texts in fixed-size blocks, bounds every distance by lengths and
character counts, compares only pairs that the bounds let survive and returns
the candidates that can (plus, per block, the limit beyond which nothing can,
which keeps the cut exact).  Levels 2 and 3
are equi-joins of the survivors to the official rows below them, with the
distance computed once per distinct text pair.  Nothing is quadratic in
the records, and a triple shared by many records is handled once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.jaro import jaro_distance, jaro_similarities
from tallyfold.functions.logic import if_else
from tallyfold.session import scratch_path, ship_package

DEFAULT_LEVELS = ("department", "province", "district")


def relabel_by_prefix(gaz: DataFrame, code: str, prefix: str, col: str, label: str) -> DataFrame:
    """Replace ``col`` with ``label`` where the code starts with ``prefix`` (Q6)."""
    return gaz.withColumn(col, if_else(F.substring(code, 1, len(prefix)) == prefix,
                                       F.lit(label), F.col(col)))


def _rank_stats(part: list[str], order: str, weight: str | None = None):
    """(weight strictly below, group minimum) of ``order`` within ``part``.

    Every statistic is a frame of one ``partitionBy(part).orderBy(order)``
    spec, so Spark computes them in one window operator after one sort.
    """
    w = Window.partitionBy(*part).orderBy(order)
    whole = w.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nearest = F.min(order).over(whole)
    if weight is None:
        return None, nearest
    below = (F.sum(weight).over(w.rangeBetween(Window.unboundedPreceding, 0))
             - F.sum(weight).over(w.rangeBetween(0, 0)))
    return below, nearest


_COLUMNS = 128   # of a character count matrix
_FIRST_LOOK = 4   # texts compared with each typed text before its bounds are looked at again


def _char_counts(texts: list[str], alphabet: np.ndarray) -> np.ndarray:
    """How often each character occurs in each text; a column for each of ``alphabet``,
    or for a remainder of the code point if those are too many."""
    lengths = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(len(texts)), lengths)
    if len(alphabet) <= _COLUMNS:
        column = np.searchsorted(alphabet, codes)
        column[column == len(alphabet)] = 0
        known = alphabet[column] == codes if len(alphabet) else np.zeros(len(codes), bool)
        row, column = row[known], column[known]
    else:
        column = codes % _COLUMNS
    counts = np.zeros((len(texts), max(min(len(alphabet), _COLUMNS), 1)), np.int32)
    np.add.at(counts, (row, column.astype(np.int64)), 1)
    return counts


def _least_distances(typed: list[str], official: list[str]) -> np.ndarray:
    """A bound below the Jaro distance of every pair, from lengths and character counts.

    No more characters can match than both texts have in common, so that replacing
    the matches by these, without transpositions, gives the highest similarity.  The
    steps are those of the exact formula, each of them monotone also when rounded.
    """
    alphabet = np.unique(np.frombuffer("".join(official).encode("utf-32-le", "surrogatepass"), "<u4"))
    a, b = _char_counts(typed, alphabet), _char_counts(official, alphabet)
    common = np.zeros((len(typed), len(official)), np.int32)
    for column in range(a.shape[1]):
        common += np.minimum(a[:, column, None], b[None, :, column])
    la, lb = (np.maximum([len(t) for t in texts], 1) for texts in (typed, official))
    most = (common / la[:, None] + common / lb[None, :] + 1.0) / 3.0
    return 1.0 - np.where(common > 0, most, 0.0)


def nearest_in_block(typed: list[str], official: list[str], weights: np.ndarray,
                     cap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """The official texts that can survive a cap, for each typed text of a block.

    Texts are visited in the order of their bounds.  Once the weight of the texts
    up to some distance reaches the cap, nothing beyond this limit can survive, and
    the visit ends where the bounds pass it.  Returns place of the typed text, place
    of the official text and distance of each text within the limit; the limits
    (infinite where the cap isn't reached); and the number of pairs compared.
    """
    least = _least_distances(typed, official)
    order = np.argsort(least, axis=1, kind="stable")
    limit = np.full(len(typed), math.inf)
    exact = np.full(least.shape, math.inf)
    active, start, step, compared = np.arange(len(typed)), 0, _FIRST_LOOK, 0
    while len(active) and start < len(official):
        look = order[active, start:start + step]
        rows = np.repeat(active, look.shape[1])
        columns = look.ravel()
        near = least[rows, columns] <= limit[rows]
        rows, columns = rows[near], columns[near]
        exact[rows, columns] = 1.0 - jaro_similarities([typed[i] for i in rows], [official[j] for j in columns])
        compared += len(rows)
        start, step = start + step, step * 2
        for i in active:
            seen = order[i, :start]
            found = np.argsort(exact[i, seen], kind="stable")
            total = np.cumsum(weights[seen[found]])
            at = np.searchsorted(total, cap)
            if at < len(found):
                limit[i] = min(limit[i], exact[i, seen[found[at]]])
        if start < len(official):
            active = active[least[active, order[active, start]] <= limit[active]]
    rows, columns = np.nonzero((exact <= limit[:, None]) & np.isfinite(exact))
    return rows, columns, exact[rows, columns], limit, compared


def _block_candidates(cap: int):
    """mapInPandas body: per (typed texts, block of official texts) row, the block's
    candidates that can survive a cap of ``cap`` (ties kept) and the limit beyond
    which nothing can."""

    def run(batches):
        for pdf in batches:
            for qs, qkeys, texts, lowered, weights in zip(pdf["_qs"], pdf["_qkeys"], pdf["_vals"],
                                                          pdf["_keys"], pdf["_ws"]):
                weights = np.asarray(weights, dtype=np.int64)
                row, column, dist, limit, _ = nearest_in_block(list(qkeys), list(lowered), weights, cap)
                limit = np.where(np.isfinite(limit), limit, math.nan)
                yield pd.DataFrame({"_q": np.asarray(qs, dtype=object)[row], "_g": np.asarray(texts, dtype=object)[column],
                                    "_d": dist, "_w": weights[column], "_next": limit[row]})

    return run


def _copies(n: Column | int) -> Column:
    """0 … n-1, one row each."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))


def nearest_candidates(queries: DataFrame, qcol: str, refs: DataFrame, rcol: str,
                       wcol: str, cap: int, block_size: int = 2048,
                       salts: int = 64, typed_block: int = 512) -> DataFrame:
    """Nearest official texts for each distinct typed text (Jaro, case-insensitive).

    Returns ``(q, g, d, below, m)``: candidate ``g`` of typed text ``q`` at
    distance ``d``, the weight of official texts strictly nearer (``below``)
    and the nearest distance ``m``.  Every candidate that survives a cut
    ``1 + k * below <= cap`` for some ``k >= 1`` — or is exact — is present.

    Official and typed texts are grouped into blocks of about ``block_size`` and
    ``typed_block`` texts, and each block meets each.  Within a pair of blocks only the
    pairs whose bound (lengths and character counts) lets them survive are compared
    (:func:`nearest_in_block`); bounds are a few vector steps for a whole block.  The
    join is on (block, salt), the salt taken from the block of typed texts and each
    official block copied once per salt, so a block is no hot key; AQE broadcasts the
    blocks when their measured size is small.
    """
    q = queries.select(F.col(qcol).alias("_q")).where(F.col("_q").isNotNull()).distinct()
    r = refs.select(F.col(rcol).alias("_g"), F.col(wcol).cast("long").alias("_w"))
    n_blocks = r.agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_size), F.lit(1)).alias("n")).scalar()
    blocks = (r.withColumn("_blk", F.pmod(F.xxhash64("_g"), n_blocks))
               .groupBy("_blk")
               .agg(F.collect_list("_g").alias("_vals"),
                    F.collect_list(F.lower("_g")).alias("_keys"),
                    F.collect_list("_w").alias("_ws"))
               .withColumn("_salt", _copies(salts)))
    n_typed = q.agg(F.greatest(F.ceil(F.count(F.lit(1)) / typed_block), F.lit(1)).alias("n")).scalar()
    qb = (q.groupBy(F.pmod(F.xxhash64("_q"), n_typed).alias("_chunk"))
           .agg(F.collect_list("_q").alias("_qs"), F.collect_list(F.lower("_q")).alias("_qkeys"))
           .withColumn("_salt", F.pmod(F.xxhash64("_chunk"), F.lit(salts)))
           .withColumn("_blk", _copies(n_blocks)))
    pairs = qb.join(blocks, ["_blk", "_salt"])
    ship_package(q.sparkSession)
    found = pairs.select("_qs", "_qkeys", "_vals", "_keys", "_ws").mapInPandas(
        _block_candidates(cap), "_q string, _g string, _d double, _w long, _next double")
    found = found.withColumn("_next", F.when(~F.isnan("_next"), F.col("_next")))
    # the bound is the least limit of any block; each block returned all up to its
    # limit, rows beyond the bound cannot survive, and dropping them changes neither
    # "below" nor "m" of the rows that remain, so all three come from one window pass
    below, nearest = _rank_stats(["_q"], "_d", "_w")
    whole = (Window.partitionBy("_q").orderBy("_d")
             .rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    found = found.select("_q", "_g", "_d", below.alias("below"), nearest.alias("m"),
                         F.min("_next").over(whole).alias("_bound"))
    found = found.where(F.col("_bound").isNull() | (F.col("_d") <= F.col("_bound")))
    return found.select(F.col("_q").alias("q"), F.col("_g").alias("g"),
                        F.col("_d").alias("d"), "below", "m")


def _survives(m: Column, d: Column, below: Column, k: Column, cap: int) -> Column:
    """Exact-match rule, else min-rank ``1 + k * below <= cap`` (ties kept);
    the product is taken in double so a very common triple cannot overflow."""
    rank_ok = (below == 0) | (k.cast("double") * below.cast("double") <= cap - 1)
    return ((m == 0) & (d == 0)) | ((m > 0) & rank_ok)


def _pair_distances(pairs: DataFrame, typed: str, official: str, out: str) -> DataFrame:
    """Case-insensitive distance once per distinct (typed, official) text pair."""
    return (pairs.select(typed, official).distinct()
                 .withColumn(out, jaro_distance(F.lower(typed), F.lower(official))))


def _join_spread(left: DataFrame, right: DataFrame, keys: list[str], by: list[str],
                 salts: int = 16) -> DataFrame:
    """Equi-join in which a key that very many rows of ``left`` carry is spread
    over ``salts`` tasks by its ``by`` columns; ``right`` is copied per salt."""
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)))
    return left.join(right.withColumn("_salt", _copies(salts)), [*keys, "_salt"]).drop("_salt")


def _cut(df: DataFrame) -> DataFrame:
    """Write a level's rows as Parquet to the shared checkpoint folder and read
    them back: later levels never recompute earlier ones, a lost executor
    does not send the job back to the first level, and the copy is columnar
    and compressed."""
    path = scratch_path(df.sparkSession, "match")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fuzzy_cascade(records: DataFrame, gazetteer: DataFrame, row_id: str = "n_row",
                  code: str = "ubigeo", levels: tuple[str, str, str] = DEFAULT_LEVELS,
                  caps: tuple[int, int] = (3, 2), weight_duplicates: bool = True,
                  block_size: int = 2048) -> DataFrame:
    """Nearest official rows for each record; see the module doc for the rules.

    Output columns: ``code``, ``gaz_<level>`` ×3, ``sub_<level>`` ×3,
    ``row_id``, ``dist_<level>`` ×3 and ``dist`` (their sum).  Records with a
    missing level get no candidate (see :func:`records_without_candidates`).
    An empty input gives an empty table with the full schema.
    """
    l1, l2, l3 = levels
    recs = records.select(row_id, *levels).where(
        F.col(l1).isNotNull() & F.col(l2).isNotNull() & F.col(l3).isNotNull())
    triples = recs.groupBy(*levels).agg(F.count(F.lit(1)).alias("_k"))
    if not weight_duplicates:
        triples = triples.withColumn("_k", F.lit(1).cast("long"))
    tkey = [f"_t{i}" for i in (1, 2, 3)]
    # both readers of the triples share the exchange of their aggregate: no write
    triples = triples.select(*[F.col(lv).alias(t) for lv, t in zip(levels, tkey)], "_k")
    gaz = gazetteer.select(code, *levels).where(
        F.col(l1).isNotNull() & F.col(l2).isNotNull() & F.col(l3).isNotNull())

    # level 1: blocked nearest-candidate lookup on distinct texts
    g1 = gaz.groupBy(l1).agg(F.count(F.lit(1)).alias("_w1"))
    c1 = nearest_candidates(triples, "_t1", g1, l1, "_w1", caps[0], block_size)
    s1 = (triples.join(c1, triples["_t1"] == c1["q"])
                 .where(_survives(F.col("m"), F.col("d"), F.col("below"), F.col("_k"), caps[0]))
                 .select(*tkey, "_k", F.col("g").alias("_g1"), F.col("d").alias("_d1")))

    # level 2: survivors × official (l1, l2) pairs below them
    s1 = _cut(s1)
    g2 = gaz.groupBy(l1, l2).agg(F.count(F.lit(1)).alias("_w2")).select(
        F.col(l1).alias("_g1"), F.col(l2).alias("_g2"), "_w2")
    d2 = _pair_distances(_join_spread(s1.select("_t2", "_g1").distinct(), g2, ["_g1"], ["_t2"]),
                         "_t2", "_g2", "_d2")
    x2 = _join_spread(s1, g2, ["_g1"], tkey).join(d2, ["_t2", "_g2"])
    below2, nearest2 = _rank_stats(tkey, "_d2", "_w2")
    s2 = (x2.select("*", nearest2.alias("_m2"), below2.alias("_b2"))
            .where(_survives(F.col("_m2"), F.col("_d2"), F.col("_b2"), F.col("_k"), caps[1]))
            .select(*tkey, "_g1", "_d1", "_g2", "_d2"))

    # level 3: survivors × official rows; best combined score, ties kept
    s2 = _cut(s2)
    g3 = gaz.select(code, F.col(l1).alias("_g1"), F.col(l2).alias("_g2"), F.col(l3).alias("_g3"))
    pair = ["_g1", "_g2"]
    d3 = _pair_distances(_join_spread(s2.select("_t3", *pair).distinct(), g3.select(*pair, "_g3").distinct(),
                                      pair, ["_t3"]), "_t3", "_g3", "_d3")
    x3 = (_join_spread(s2, g3, pair, tkey).join(d3, ["_t3", "_g3"])
            .withColumn("_score", (F.col("_d2") + 1) * (F.col("_d3") + 1) + F.col("_d3")))
    best_score = _rank_stats(tkey, "_score")[1]
    best = x3.withColumn("_best", best_score).where(F.col("_score") == F.col("_best"))

    # back to the records carrying each triple
    out = best.join(recs, (best["_t1"] == recs[l1]) & (best["_t2"] == recs[l2])
                    & (best["_t3"] == recs[l3]))
    return out.select(
        F.col(code),
        F.col("_g1").alias(f"gaz_{l1}"), F.col("_g2").alias(f"gaz_{l2}"),
        F.col("_g3").alias(f"gaz_{l3}"),
        F.col("_t1").alias(f"sub_{l1}"), F.col("_t2").alias(f"sub_{l2}"),
        F.col("_t3").alias(f"sub_{l3}"),
        F.col(row_id),
        F.col("_d1").alias(f"dist_{l1}"), F.col("_d2").alias(f"dist_{l2}"),
        F.col("_d3").alias(f"dist_{l3}"),
        (F.col("_d1") + F.col("_d2") + F.col("_d3")).alias("dist"))


def records_without_candidates(records: DataFrame, row_id: str = "n_row",
                               levels: tuple[str, str, str] = DEFAULT_LEVELS) -> DataFrame:
    """Records the matcher cannot place because a level is missing (Q5)."""
    miss = None
    for lv in levels:
        c = F.col(lv).isNull()
        miss = c if miss is None else miss | c
    return records.select(row_id, *levels).where(miss)
