"""Ranked search against a plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import lexical_search as ls
from tallyfold.llm import queries, sql

from conftest import SF_SMALL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """(item_id, rank, doc_id, score) of every item's best documents."""
    counted = [(d, Counter(words(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    total, length = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in counted:
            m = 100 - 90 + (90 * n * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(words(text)) if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, n long, item_id string")
    i = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, score long")
    return sorted((tuple(r) for r in ls.search(d, i, **more).collect()), key=str)


def corpus(n, seed=1, size=(0, 40)):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)]
    weights = [1 / (i + 1) for i in range(80)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(*size)))) for i in range(n)]


def test_terms():
    text = "Ab-c_D9 É\x00ñÑ  x\x7fy ‐ K 'q' a.b"
    assert [t.decode() for t in ls.terms_of(text)] == words(text)
    assert ls.terms_of(None) == ls.terms_of(" -.!") == []


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.text())
def test_terms_of_any_text(text):
    text = text.encode(errors="ignore").decode()
    assert [t.decode() for t in ls.terms_of(text)] == words(text)


@pytest.mark.parametrize("postings", [ls.BLOCK_POSTINGS, 60])
def test_equals_a_plain_scoring(spark, monkeypatch, postings):
    monkeypatch.setattr(ls, "BLOCK_POSTINGS", postings)
    docs = corpus(300) + [(1000 + i, d[1]) for i, d in enumerate(corpus(40))]
    docs += [(5, "w1 w2 W79"), (5, "w1 w2 W79"), (None, "w1 w2 w79"), (None, None), (7, ""), (8, "..."), (9, "É é w79")]
    items = [(i, t) for i, t in corpus(25, 2, (1, 25))]
    items += [(3, "w1 w2"), (None, "w79"), (90, None), (91, ""), (92, "nowhere"), (93, "É"), (94, "w0 w0 w0")]
    assert run(spark, docs, items) == brute(docs, items)


def test_items_in_blocks_and_other_k(spark):
    docs, items = corpus(120, 3), corpus(9, 4, (1, 12))
    assert run(spark, docs, items, k=3, item_chars=60) == brute(docs, items, 3)


def test_ties_go_to_the_smaller_id_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(ls, "BLOCK_POSTINGS", 7)
    docs = [(i, "same words here") for i in random.Random(1).sample(range(500), 400)]
    got = run(spark, docs + [(900, "other")], [(1, "words here")])
    assert [(r, d) for _, r, d, _ in sorted(got)] == list(zip(range(1, 11), sorted(d for d, _ in docs)))


def test_empty_tables_and_a_long_document(spark):
    assert run(spark, [], [(1, "a")]) == [] == run(spark, [(1, "a b")], [])
    docs = [(1, "lorem " * 200_000 + "ipsum"), (2, "ipsum"), (3, "dolor")]
    assert run(spark, docs, [(1, "ipsum lorem")]) == brute(docs, [(1, "ipsum lorem")])


def test_length_norms_beyond_64_bits():
    n = np.array([1, 10**7, 10**9])
    assert ls.length_norms(n, 10**12, 10**15).tolist() == [10 + 90 * int(x) * 10**12 // 10**15 for x in n]


def searched(docs, items, joint, block=400, k=10):
    """Postings read and looked up, and results, of a search over blocks of documents."""
    asked = ls.Items([i for i, _ in items], [t for _, t in items])
    counted = [(d, Counter(w.encode() for w in words(t))) for d, t in docs]
    df, total = Counter(t for _, c in counted for t in c), len(counted)
    length = sum(sum(c.values()) for _, c in counted)
    weights = np.array([ls.weight(total, df[t]) if df[t] else 0 for t in asked.vocabulary])
    units, found, touched = asked.units(weights), [ls.Best(k) for _ in items], 0
    for start in range(0, total, block):
        part = counted[start:start + block]
        rows, terms, times = zip(*[(r, asked.vocabulary[t], n) for r, (_, c) in enumerate(part)
                                   for t, n in c.items() if t in asked.vocabulary])
        norms = ls.length_norms(np.array([sum(c.values()) for _, c in part]), total, length)
        times, rows, terms = map(np.array, (times, rows, terms))
        impacts = 1_000_000_000 * times // (1000 * times + 8 * norms[rows])
        b = ls.Block(np.array([d for d, _ in part]), terms, rows, impacts * weights[terms], len(weights))
        for (pairs, single), best in zip(units, found):
            for a, c in pairs:  # a pair's list: the documents of both, and their largest joint contribution
                both, values, most = b.pair(a, c)
                assert set(both) == set(b.postings(a)[0]) & set(b.postings(c)[0])
                assert most == max(values, default=0) <= b.most[a] + b.most[c]
            touched += sum(ls.search_block(b, pairs, single, best, joint))
    return touched, [(x.scores.tolist(), x.ids.tolist()) for x in found]


def test_pair_bounds_skip_more_than_single_maxima():
    rng = random.Random(9)
    # common words that seldom meet, and rare ones that decide
    docs = [(i, " ".join([rng.choice(["left", "right"])] * rng.randint(1, 6) + rng.choices(
        [f"r{j}" for j in range(400)], k=rng.randint(3, 12)))) for i in range(8000)]
    items = [(i, f"left right r{i} r{i + 50}") for i in range(40)]
    (single, plain), (paired, result) = searched(docs, items, False), searched(docs, items, True)
    assert result == plain
    whole = sum(sum(w in t.split() for w in x.split()) for _, x in items for _, t in docs)
    assert paired < 0.8 * single < single < 0.7 * whole


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    df, res = queries.op13_lexical_search(spark, SF_SMALL), con.sql(sql.LEXICAL_SEARCH)
    assert df.columns == res.columns
    assert sorted(tuple(r) for r in df.collect()) == sorted(res.fetchall())
