"""The mix against its definition: windows, deviation, completeness."""

import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import mixing, queries
from tallyfold.llm.common import table

from conftest import SF_SMALL


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=12))
def test_schedule_meets_every_window(shares):
    named = {f"s{i}": s for i, s in enumerate(shares)}
    period, slots = sum(shares), mixing.schedule(named)
    assert sorted(x for v in slots.values() for x in v) == list(range(period))
    for name, share in named.items():
        for j, slot in enumerate(slots[name]):
            assert j * period // share <= slot < -(-(j + 1) * period // share)


def test_integer_shares_add_up_and_are_refused_when_wrong():
    shares = mixing.integer_shares({"a": 1, "b": 0.001, "c": 2.5}, 100)
    assert sum(shares.values()) == 100 and min(shares.values()) >= 1 and shares["c"] > shares["a"]
    with pytest.raises(ValueError):
        mixing.integer_shares({"a": 0, "b": 1})
    with pytest.raises(ValueError):
        mixing.integer_shares({str(i): 1 for i in range(11)}, 10)


def check_mix(got, weights, sizes, block_rows):
    """Every slot is one block of one source; each prefix is within a block of target."""
    blocks = {}
    for r in got:
        blocks.setdefault(r.mix_slot, []).append(r)
    end = max(blocks) + 1
    assert sorted(blocks) == list(range(end))
    total, have = sum(weights.values()), Counter()
    for slot in range(end):
        rows = blocks[slot]
        assert len({r.source for r in rows}) == 1
        assert sorted(r.mix_place for r in rows) == list(range(len(rows))) and len(rows) <= block_rows
        have[rows[0].source] += 1
        for s, w in weights.items():
            assert abs(have[s] - (slot + 1) * w / total) < 1
    # every epoch but the last has every row of its source once
    for s, n in sizes.items():
        epochs = Counter(r.mix_epoch for r in got if r.source == s)
        assert sorted(epochs) == list(range(len(epochs)))
        assert all(epochs[e] == n for e in range(len(epochs) - 1)) and epochs[0] == n


def test_mix_to_given_weights(spark):
    data = [(i, None if i % 10 < 5 else f"s{i % 3}", i) for i in range(700)] + [(9999, "s1", 1)] * 3
    docs = spark.createDataFrame(data, "doc_id long, source string, mix_slot int")
    sizes = Counter(s for _, s, _ in data)
    weights = {None: 20, "s0": 30, "s1": 45, "s2": 5}
    mixed = mixing.mix(docs, weights, block_rows=4, resolution=100)
    assert mixed.columns == ["doc_id", "source", *mixing.ADDED]
    got = mixed.collect()
    check_mix(got, weights, sizes, 4)
    assert {r.doc_id for r in got} == {d for d, _, _ in data}
    with pytest.raises(ValueError, match="no target weight"):
        mixing.mix(docs, {"s0": 1})


def test_order_of_the_mix_is_that_of_the_rows(spark):
    docs = spark.createDataFrame([(i, f"s{i % 2}") for i in range(50)], "doc_id long, source string")
    mixed = mixing.mix(docs, block_rows=2)
    want = [r.doc_id for r in sorted(mixed.collect(), key=lambda r: (r.mix_slot, r.mix_place))]
    stored = mixing.in_mix_order(mixed)
    assert stored.columns == docs.columns and [r.doc_id for r in stored.collect()] == want


def test_one_source_and_no_rows(spark):
    one = spark.createDataFrame([(i, "s") for i in range(20)], "doc_id long, source string")
    assert sorted(r.doc_id for r in mixing.mix(one, block_rows=3).collect()) == list(range(20))
    assert mixing.mix(one.limit(0)).collect() == []


def test_query(spark):
    sizes = {r["source"]: r["count"] for r in table(spark, SF_SMALL, "documents").groupBy("source").count().collect()}
    shares = mixing.integer_shares({s: float(n) ** mixing.TEMPERATURE for s, n in sorted(sizes.items())})
    check_mix(queries.op2_mixing(spark, SF_SMALL).collect(), shares, sizes, mixing.BLOCK_ROWS)


def test_no_source_drifts_from_its_true_weight_over_many_periods():
    sizes = {f"s{i}": 3 + 41 * i * i for i in range(19)} | {"one": 1, "large": 7_000}
    weights = {s: float(n) ** mixing.TEMPERATURE for s, n in sizes.items()}
    shares, total = list(mixing.exact_shares(weights).values()), sum(weights.values())
    done = [0] * len(shares)
    for slot, k in zip(range(1, 120_001), mixing.dealt(shares, done, 0)):
        if slot % 97 == 0 or slot > 119_000:
            assert all(abs(n - slot * w / total) < 1 for n, w in zip(done, weights.values()))


def test_mix_to_true_weights_in_stretches(spark):
    data = [(i, f"s{min(i % 7, i % 5, i % 3)}") for i in range(4000)] + [(9999, "one")]
    docs = spark.createDataFrame(data, "doc_id long, source string")
    sizes = Counter(s for _, s in data)
    weights = {s: float(n) ** mixing.TEMPERATURE for s, n in sizes.items()}
    got = mixing.mix(docs, block_rows=1, resolution=25).collect()
    check_mix(got, weights, sizes, 1)
    assert mixing.mix(docs).schema == mixing.mix(docs, resolution=25).schema


def walked(shares, blocks, length):
    """The states of the schedule by going through all its slots."""
    done, left, slot = [0] * len(shares), len(shares), 0
    found, source = [], mixing.dealt(shares, done, 0)
    while left:
        begin, before = slot, done.copy()
        while left and slot < begin + length:
            k = next(source)
            left -= done[k] == blocks[k]
            slot += 1
        found.append((begin, slot - begin, before))
    return found


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5000), st.integers(1, 40)), min_size=1, max_size=15),
       st.integers(1, 70), st.sampled_from([1, 0.7, 0.31]))
def test_states_are_those_of_the_walk(sources, length, power):
    shares = list(mixing.exact_shares({i: s ** power for i, (s, _) in enumerate(sources)}).values())
    blocks = [b for _, b in sources]
    assert list(mixing.stretches(shares, blocks, length)) == walked(shares, blocks, length)


def test_a_hundred_million_slots_take_seconds_and_stay_within_one_block():
    sizes = {f"s{i}": 3 + 41 * i * i for i in range(99)} | {"one": 1}
    weights = {s: float(n) ** mixing.TEMPERATURE for s, n in sizes.items()}
    shares, total = list(mixing.exact_shares(weights).values()), sum(weights.values())
    true = np.array(list(weights.values())) / total
    done, length, began = np.zeros(len(shares), np.int64), 1_000_000, time.monotonic()
    for start in range(0, 100 * length, length):
        done = mixing.state_after(shares, done, start, start + length)
        assert done.sum() == start + length
        assert np.abs(done - (start + length) * true).max() < 1.0001  # doubles, for the test's own arithmetic
    assert time.monotonic() - began < 60  # the walk takes minutes


def test_null_and_repeated_ids_and_clashing_names(spark):
    data = [(None if i % 3 else 7, f"s{i % 2}", f"t{i}", i, i, i, {"a": i}) for i in range(300)] + [
        (None, "s0", None, None, None, None, None)] * 20
    docs = spark.createDataFrame(
        data, "doc_id long, source string, `a.b` string, row long, __n long, bucket long, m map<string,long>")
    got = mixing.mix(docs, {"s0": 1, "s1": 3}, block_rows=4)
    assert got.columns == [*docs.columns, *mixing.ADDED]
    rows = got.collect()
    check_mix(rows, {"s0": 1, "s1": 3}, Counter(s for _, s, *_ in data), 4)
    first = Counter((r.doc_id, r["a.b"], r.row, r.bucket) for r in rows if r.mix_epoch == 0 and r.source == "s0")
    assert first == Counter((d, t, n, n) for d, s, t, n, *_ in data if s == "s0")


def test_a_small_source_that_is_read_very_often(spark):
    docs = spark.createDataFrame([(i, "large") for i in range(3000)] + [(-i, "small") for i in (1, 2, 3)],
                                 "doc_id long, source string")
    rows = mixing.mix(docs, {"large": 1, "small": 2}, block_rows=2).collect()
    assert max(r.mix_epoch for r in rows) > 4 * mixing.PART
    check_mix(rows, {"large": 1, "small": 2}, {"large": 3000, "small": 3}, 2)
