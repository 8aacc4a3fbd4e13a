"""The lookup table against its definition, and placement against a plain computation."""

import hashlib
from collections import Counter

import pytest

from tallyfold.llm import queries, sharding
from tallyfold.llm.common import table

from conftest import SF_SMALL


def brute_table(shards, weights, size):
    """Whole permutations, written out."""
    orders = []
    for s in shards:
        d = hashlib.blake2b(s.encode(), digest_size=16).digest()
        offset, step = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:], "big") % (size - 1) + 1
        orders.append(iter([(offset + j * step) % size for j in range(size)]))
    table = {}
    while True:
        for i, turns in enumerate(weights):
            for _ in range(turns):
                slot = next(x for x in orders[i] if x not in table)
                table[slot] = i
                if len(table) == size:
                    return [table[x] for x in range(size)]


@pytest.mark.parametrize("shards,weights,size", [(3, None, 7), (5, [1, 2, 1, 3, 1], 101), (64, None, 251), (1, None, 2)])
def test_table_equals_brute_force(shards, weights, size):
    names = [f"n{i}" for i in range(shards)]
    got = sharding.lookup_table(names, weights, size)
    assert got == brute_table(names, weights or [1] * shards, size)
    counts, total = Counter(got), sum(weights or [1] * shards)
    for i, w in enumerate(weights or [1] * shards):
        assert abs(counts[i] - size * w / total) <= w + 1


def test_removing_a_shard_moves_little_else():
    names = [f"n{i}" for i in range(20)]
    before, after = sharding.lookup_table(names, size=4099), sharding.lookup_table(names[:-1], size=4099)
    moved = sum(b != a for b, a in zip(before, after) if b != 19)
    assert moved < 0.06 * 4099


def test_wrong_tables_are_refused():
    for bad in (dict(shards=[]), dict(shards=["a", "a"]), dict(shards=["a", "b"], size=100),
                dict(shards=["a", "b", "c"], size=2), dict(shards=["a"], weights=[0])):
        with pytest.raises(ValueError):
            sharding.lookup_table(**bad)


def test_placement(spark):
    docs = spark.createDataFrame([(1, "x"), (None, "y"), (1, "x"), (-7, None)], "doc_id long, slot string")
    names = ["a", "b", "c"]
    placed = sharding.place(docs, names, size=101)
    assert placed.columns == ["doc_id", "slot", "shard", "shard_name"]
    lookup = sharding.lookup_table(names, size=101)
    for r in placed.collect():
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard, r.shard_name) == (slot, lookup[slot], names[lookup[slot]])
    assert placed.count() == 4 and sharding.place(docs.limit(0), names).collect() == []


def test_query_places_every_document(spark):
    got = queries.op4_sharding(spark, SF_SMALL).collect()
    assert len(got) == table(spark, SF_SMALL, "documents").count()
    lookup = sharding.lookup_table(queries.SHARDS)
    assert all(r.shard == lookup[r.slot] for r in got)
