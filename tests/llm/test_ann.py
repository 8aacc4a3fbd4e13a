"""Nearest neighbours against all distances: recall, ties, copies and unusable vectors."""

import math
import random

import numpy as np
import pytest

from tallyfold.llm import ann, queries
from tallyfold.llm.common import table

from conftest import SF_SMALL


def brute(points, every, k):
    """query id -> [(distance, id)], nearest first."""
    out = {}
    for q in sorted({i for i, _ in points if i % every == 0}):
        vector = next(v for i, v in points if i == q)
        near = sorted({(math.dist(vector, v), i) for i, v in points if i != q})
        out[q] = near[:k]
    return out


def recall(got, want):
    hits = total = 0
    for q, near in want.items():
        found = {r.vec_id for r in got if r.query_id == q}
        hits += sum(i in found for _, i in near)
        total += len(near)
    return hits / total


@pytest.mark.parametrize("freedom,p,value", [(2, 0.95, 5.991), (8, 0.95, 15.507), (8, 0.5, 7.344), (4, 0.99, 13.277)])
def test_chi_square(freedom, p, value):
    assert ann.chi_square_quantile(p, freedom) == pytest.approx(value, abs=2e-3)


def test_tree_yields_every_point_in_bounds():
    rng = np.random.default_rng(1)
    points = np.round(rng.standard_normal((500, 4)), 1)
    tree, query = ann.KdTree(points), rng.standard_normal(4)
    seen, apart = set(), ((points - query) ** 2).sum(axis=1)
    for places, bound in tree.nearest(query):
        assert not seen & set(places.tolist())
        seen |= set(places.tolist())
        rest = [i for i in range(500) if i not in seen]
        assert not rest or apart[rest].min() >= bound - 1e-9
    assert seen == set(range(500))


def test_points_come_in_order_of_projected_distance():
    points = np.random.default_rng(5).standard_normal((1000, 6))
    tree, query = ann.KdTree(points), np.zeros(6)
    apart = (points ** 2).sum(axis=1)
    seen = np.concatenate([places for places, _ in tree.nearest(query)])
    assert len(seen) == 1000 and (np.diff(apart[seen]) >= 0).all()


def test_the_stopping_test_saves_most_of_the_work(spark):
    rows = table(spark, SF_SMALL.replace("sf0.001", "sf0.1"), "embeddings").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    block = ann.Block(ids, vectors, ann.PROJECTIONS, ann.CONFIDENCE)
    hits, asked = 0, ids[ids % 100 == 0]
    for q in asked:
        query = vectors[ids == q][0]
        near = np.argsort(((vectors - query) ** 2).sum(axis=1))[:11]
        hits += len({i for _, i in block.search(int(q), query, 10)} & set(ids[near].tolist()))
    assert hits / (10 * len(asked)) >= 0.9
    assert block.verified < 0.6 * len(ids) * len(asked)


def test_one_id_with_many_vectors_and_clashing_names(spark):
    rng = np.random.default_rng(6)
    points = [(100, rng.standard_normal(4).tolist()) for _ in range(50)] + [
        (i, rng.standard_normal(4).tolist()) for i in range(1, 60)]
    frame = spark.createDataFrame([(*p, 1, 2, 3) for p in points],
                                  "vec_id long, embedding array<double>, b int, vector int, dim int")
    got = ann.nearest(frame, every=100).collect()
    assert {r.query_id for r in got} == {100} and all(r.vec_id != 100 for r in got)
    assert sorted(r["rank"] for r in got) == list(range(1, 11))


def test_clusters_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROWS_PER_BLOCK", 300)
    monkeypatch.setattr(ann, "QUERIES_PER_BLOCK", 5)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 16))
    points = [(i, (centres[i % 20] + 0.2 * rng.standard_normal(16)).tolist()) for i in range(1500)]
    frame = spark.createDataFrame(points, "vec_id long, embedding array<double>")
    got = ann.nearest(frame, every=100).collect()
    assert recall(got, brute(points, 100, 10)) >= 0.9
    places = {i: v for i, v in points}
    for q in range(0, 1500, 100):
        rows = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 11))
        assert [r.score for r in rows] == sorted(r.score for r in rows)
        assert all(r.score == pytest.approx(math.dist(places[q], places[r.vec_id]), abs=1e-12) for r in rows)


def test_copies_and_ties_go_to_the_smaller_id(spark):
    random.seed(3)
    points = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(1000 + i, [1.0, 2.0, 3.0 + i]) for i in range(1, 20)]
    frame = spark.createDataFrame(points + [(7, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>")
    got = ann.nearest(frame, every=100).collect()
    for q, near in brute(points, 100, 10).items():
        assert [(r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == near


def test_unusable_vectors_few_candidates_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (9, [1.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(frame, every=100).collect())
    assert got == [(0, 1, 9, 0.0), (0, 2, 1, 1.0)]
    assert ann.nearest(frame.limit(0)).collect() == []


def test_query_recall(spark):
    rows = table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding").collect()
    want = brute([(r.vec_id, r.embedding) for r in rows], 100, 10)
    got = queries.op9_ann(spark, SF_SMALL).collect()
    assert recall(got, want) >= 0.9 and len(got) == 10 * len(want)
