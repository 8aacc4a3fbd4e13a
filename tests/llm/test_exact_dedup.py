"""Exact groups against a dictionary of normalised texts."""

import hashlib
import random
from collections import defaultdict

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
import pytest

from tallyfold.llm import common, exact_dedup, queries, simhash
from tallyfold.llm.common import numbered

from conftest import SF_SMALL, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(data):
    """(doc_id, keep_id, group_size, sha) of each row, and rows that stay per group."""
    groups = defaultdict(list)
    for doc_id, text in data:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str), len(groups)


def check(spark, data, block_chars):
    docs = spark.createDataFrame([(*r, 5, "x") for r in data],
                                 "doc_id long, text string, group_size int, name string")
    got = exact_dedup.exact_groups(docs, block_chars=block_chars).collect()
    want, groups = brute(data)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)


def test_blocks_of_every_number_and_remainder(spark):
    base = "abcdefghij" * 4
    data = [(i, base[:i]) for i in range(35)] + [(100 + i, base[:i].upper()) for i in range(0, 35, 3)]
    data += [(200, "abcdabcd"), (201, "abcdabcdabcd"), (202, "abcdabcdabcdabcd"), (203, "ABCDabcd")]
    check(spark, data, 4)


def test_nulls_empty_texts_repeated_rows_and_other_letters(spark):
    data = [(None, None), (None, ""), (3, None), (3, None), (4, "É"), (5, "é"), (6, "x\n"), (7, "x"), (7, "X"),
            (8, "😀" * 9), (9, "😀" * 9), (10, "😀" * 8)]
    check(spark, data, 4)
    check(spark, data, exact_dedup.BLOCK_CHARS)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_groups(docs).collect() == []
    assert exact_dedup.drop_exact_copies(docs).collect() == []


def test_dropping_keeps_one_whole_row_of_each_group(spark):
    docs = spark.createDataFrame([(1, "A", "p"), (2, "a", "q"), (2, "a", "r"), (3, None, "s")],
                                 "doc_id long, text string, source string")
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    found = rows(left, "doc_id", "text")
    assert found == [(2, "a"), (3, None)]


@pytest.mark.parametrize("seed", range(2))
def test_random_texts(spark, seed):
    @settings(max_examples=1, deadline=None, derandomize=True)
    @given(st.lists(st.tuples(st.integers(0, 30), st.text("abAB", max_size=20)), min_size=60, max_size=120))
    def run(data):
        check(spark, data, 2 + seed)

    run()


def test_main_path_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "A")], "doc_id long, text string")
    plan = exact_dedup.exact_groups(docs)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    df = queries.op5_exact_dedup(spark, SF_SMALL)
    res = con.sql(queries.SQL["op5_exact_dedup"])
    assert df.columns == res.columns
    assert sorted(tuple(r) for r in df.collect()) == sorted(res.fetchall())


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_copies, simhash.drop_near_copies])
@pytest.mark.parametrize("plain", [True, False])
def test_rows_to_drop_hold_however_the_files_are_split(spark, tmp_path, drop, plain):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    texts = [" ".join(random.Random(i % 20).choices(words, k=40)) for i in range(60)]
    spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string") \
        .repartition(12).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    docs = docs if plain else docs.where("doc_id >= 0")
    key = "spark.sql.files.openCostInBytes"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, str(1 << 27))  # a split for each file
        left = drop(docs)
        spark.conf.set(key, "0")           # few splits
        kept = [r.text for r in left.collect()]
    finally:
        spark.conf.set(key, old)
    assert left.columns == docs.columns and sorted(kept) == sorted(set(texts))


@pytest.mark.parametrize("most", [common.BROADCAST_FILES, 2])
def test_row_numbers_follow_the_files(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(common, "BROADCAST_FILES", most)
    spark.range(50, numPartitions=5).write.parquet(str(tmp_path / "t"))
    got = numbered(spark.read.parquet(str(tmp_path / "t")), "n").collect()
    assert sorted((r.id, r.n) for r in got) == [(i, i) for i in range(50)]
    assert numbered(spark.read.parquet(str(tmp_path / "t")).limit(0), "n").columns == ["id", "n"]


def test_rows_that_are_not_their_files_rows_once_are_numbered_apart(spark, tmp_path):
    spark.range(50, numPartitions=5).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    twice = docs.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    for df in (docs.where("id % 7 <> 3"), docs.unionByName(docs), twice, spark.range(30), docs.join(docs, "id")):
        got = numbered(df, "n").collect()
        assert len({r.n for r in got}) == len(got) == df.count()


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_copies, simhash.drop_near_copies])
def test_columns_of_any_names_come_through(spark, tmp_path, drop):
    names = ["__file", "__start", "__row", "__rid", "__RID_", "_metadata", "rid", "a.b", "fp"]
    columns = ", ".join(f"`{n}` string" for n in names)
    data = [(i, f"text number {i % 4} of some", *(f"{n}{i}" for n in names)) for i in range(12)]
    spark.createDataFrame(data, f"doc_id long, text string, {columns}").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    got = drop(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert len(rows) == 4 and all(tuple(r) == data[r.doc_id] for r in rows)
