"""Staged matcher == brute-force all-pairs matcher (pure Python, reference rules)."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyfold.functions.jaro import jaro_similarities
from tallyfold.operators.fuzzy import (fuzzy_cascade, nearest_in_block, records_without_candidates,
                                       relabel_by_prefix)
from tallyfold.plans import standins as S

from conftest import SF_SMALL as SF
from conftest import rows

GAZ_SCHEMA = "ubigeo string, department string, province string, district string"
REC_SCHEMA = "n_row long, department string, province string, district string"


def _d(a, b):
    return 1.0 - float(jaro_similarities([a.lower()], [b.lower()])[0])


def _cut(group, key, cap):
    vals = [key(r) for r in group]
    return [r for r, v in zip(group, vals) if 1 + sum(w < v for w in vals) <= cap]


def brute_force(records, gaz, caps=(3, 2)):
    groups = defaultdict(list)
    for n, sd, sp, sdi in records:
        if None in (sd, sp, sdi):
            continue
        for code, gd, gp, gdi in gaz:
            groups[(sd, sp, sdi)].append((code, gd, gp, gdi, sd, sp, sdi, n,
                                          _d(gd, sd), _d(gp, sp), _d(gdi, sdi)))
    out = []
    for g in groups.values():
        m = min(r[8] for r in g)
        g = [r for r in g if m > 0 or r[8] == m]
        g = _cut(g, lambda r: r[8], caps[0])
        m = min(r[9] for r in g)
        g = [r for r in g if m > 0 or r[9] == m]
        g = _cut(g, lambda r: r[9], caps[1])
        g = _cut(g, lambda r: (r[9] + 1) * (r[10] + 1) + r[10], 1)
        out += [r[:8] + (round(r[8], 9), round(r[9], 9), round(r[10], 9)) for r in g]
    return sorted(out)


def staged(spark, records, gaz, **kw):
    g = spark.createDataFrame(gaz, GAZ_SCHEMA)
    r = spark.createDataFrame(records, REC_SCHEMA)
    out = fuzzy_cascade(r, g, **kw)
    return sorted(tuple(x[:8]) + tuple(round(v, 9) for v in x[8:11]) for x in out.collect())


def _mutate(rng, s):
    k = rng.randrange(5)
    if k == 0 and len(s) > 1:
        i = rng.randrange(len(s))
        return s[:i] + s[i + 1:]
    if k == 1:
        return s.upper()
    if k == 2 and len(s) > 1:
        i = rng.randrange(len(s) - 1)
        return s[:i] + s[i + 1] + s[i] + s[i + 2:]
    return s


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_staged_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    deps = ["lima", "limon", "puno", "cusco"]
    provs = ["alto", "bajo", "alta", "centro", "norte"]
    dists = ["san juan", "san jose", "santa rosa", "miraflores", "la punta", "los olivos"]
    gaz = []
    for i in range(40):
        gaz.append((f"{i:04d}", rng.choice(deps), rng.choice(provs), rng.choice(dists)))
    records = []
    for n in range(60):
        _, d, p, s = rng.choice(gaz)
        rec = (n, _mutate(rng, d), _mutate(rng, p), _mutate(rng, s))
        records += [rec] * 1
        if rng.random() < 0.2:  # duplicates: same texts, another row (Q1)
            records.append((1000 + n,) + rec[1:])
    records.append((5000, "lima", None, "san juan"))  # Q5
    want = brute_force(records, gaz)
    assert staged(spark, records, gaz) == want
    # several blocks in the first level give the same answer
    assert staged(spark, records, gaz, block_size=1) == want


def test_q1_duplicates_change_ranks(spark):
    gaz = [("01", "abcd", "p", "d"), ("02", "abce", "p", "d"), ("03", "zzzz", "p", "d")]
    once = [(1, "abcf", "p", "d")]
    thrice = [(1, "abcf", "p", "d"), (2, "abcf", "p", "d"), (3, "abcf", "p", "d")]
    assert staged(spark, once, gaz) == brute_force(once, gaz)
    assert staged(spark, thrice, gaz) == brute_force(thrice, gaz)


def test_q3_exact_level_closes(spark):
    gaz = [("01", "lima", "a", "x"), ("02", "limb", "a", "x")]
    got = staged(spark, [(1, "LIMA", "a", "x")], gaz)
    assert [r[0] for r in got] == ["01"]


def test_q5_missing_level_and_q14_empty(spark):
    gaz = [("01", "lima", "a", "x")]
    recs = spark.createDataFrame([(1, "lima", None, "x")], REC_SCHEMA)
    out = fuzzy_cascade(recs, spark.createDataFrame(gaz, GAZ_SCHEMA))
    assert out.count() == 0
    assert rows(records_without_candidates(recs), "n_row") == [(1,)]
    empty = fuzzy_cascade(spark.createDataFrame([], REC_SCHEMA), spark.createDataFrame(gaz, GAZ_SCHEMA))
    assert empty.count() == 0
    assert empty.columns == ["ubigeo", "gaz_department", "gaz_province", "gaz_district",
                             "sub_department", "sub_province", "sub_district", "n_row",
                             "dist_department", "dist_province", "dist_district", "dist"]


def test_q6_relabel_and_q13_codes(spark):
    g = spark.createDataFrame([("150101", "LIMA M", "a", "b"), ("010101", "X", "a", "b"),
                               (None, "Y", "a", "b")], GAZ_SCHEMA)
    got = rows(relabel_by_prefix(g, "ubigeo", "15", "department", "LIMA"), "ubigeo", "department")
    assert got == [(None, None), ("010101", "X"), ("150101", "LIMA")]


def test_plan_has_no_cartesian_product(spark):
    gaz = [("01", "lima", "a", "x"), ("02", "puno", "b", "y")]
    recs = spark.createDataFrame([(1, "lima", "a", "x")], REC_SCHEMA)
    out = fuzzy_cascade(recs, spark.createDataFrame(gaz, GAZ_SCHEMA))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_blocks_and_salts_do_not_change_candidates(spark):
    from tallyfold.operators.fuzzy import nearest_candidates
    q = spark.createDataFrame([("lima",), ("limon",), ("pun",), ("cusko",)], "t string")
    refs = spark.createDataFrame([("lima", 2), ("limo", 1), ("puno", 3), ("cusco", 1), ("ica", 1)],
                                 "v string, w long")
    small = nearest_candidates(q, "t", refs, "v", "w", 3, block_size=2)
    salted = nearest_candidates(q, "t", refs, "v", "w", 3, block_size=2, salts=3)
    assert rows(small) == rows(salted) and small.count() > 0


def test_per_record_ranks_without_duplicate_weights(spark):
    rng = random.Random(11)
    gaz = [(f"{i:03d}", rng.choice(["lima", "limon", "puno"]), rng.choice(["alto", "alta", "bajo"]),
            rng.choice(["san juan", "san jose", "la punta"])) for i in range(30)]
    base = [(n,) + tuple(_mutate(rng, t) for t in rng.choice(gaz)[1:]) for n in range(25)]
    records = base + [(100 + r[0],) + r[1:] for r in base[:10]]      # duplicated texts
    # brute force per record: each record is its own group (k = 1)
    want = sorted(x for r in records for x in brute_force([r], gaz))
    assert staged(spark, records, gaz, weight_duplicates=False) == want


def _survivors(typed, official, weights, cap):
    """Every text with less than ``cap`` of weight strictly nearer, from all pairs."""
    out = set()
    for i, t in enumerate(typed):
        d = [1.0 - float(x) for x in jaro_similarities([t] * len(official), official)]
        out |= {(i, j, d[j]) for j in range(len(d)) if sum(w for w, x in zip(weights, d) if x < d[j]) < cap}
    return out


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.text("abcñ #é1", max_size=9), min_size=1, max_size=40, unique=True),
       st.lists(st.text("abcñ #é1", max_size=9), min_size=1, max_size=25, unique=True),
       st.integers(1, 6), st.integers(0, 2**32))
def test_bounded_search_of_a_block_equals_all_pairs(official, typed, cap, seed):
    weights = np.random.default_rng(seed).integers(1, 4, len(official))
    row, column, dist, limit, compared = nearest_in_block(typed, official, weights, cap)
    assert set(zip(row.tolist(), column.tolist(), dist.tolist())) == _survivors(typed, official, weights.tolist(), cap)
    assert compared <= len(typed) * len(official)
    full = weights.sum() >= cap
    assert all(np.isfinite(x) == full for x in limit)


def test_bounds_of_texts_with_many_different_characters():
    official = ["".join(chr(0x4E00 + (i * 37 + j * 11) % 900) for j in range(6)) for i in range(60)]
    typed = [t[1:] + "x" for t in official[:20]] + [""]
    row, column, dist, *_ = nearest_in_block(typed, official, np.ones(60, int), 3)
    assert set(zip(row.tolist(), column.tolist(), dist.tolist())) == _survivors(typed, official, [1] * 60, 3)


def test_few_pairs_of_the_part_names_are_compared(spark):
    sf = SF.replace("0.001", "0.01")
    names = F.lower(F.concat_ws(" ", "department", "province", "district"))
    official = [r[0] for r in S.part_gazetteer(spark, sf).select(names).distinct().collect()]
    typed = [r[0] for r in S.part_records(spark, sf).where("province is not null").select(names).distinct().collect()]
    assert len(official) > 1500 and len(typed) > 1500
    compared = nearest_in_block(typed[:512], official, np.ones(len(official), int), 3)[-1]
    assert compared < 0.1 * 512 * len(official)
