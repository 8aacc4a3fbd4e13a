"""The pipeline against a plain version of its stages, on the smallest tables."""

import os
import re
from collections import Counter

import corpus_pipeline
from tokenizers import Tokenizer

from tallyfold.llm import langid, mixing, queries, simhash
from tallyfold.llm.common import table
from tallyfold.session import scratch_run

from conftest import SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_stages_and_result(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "tokens"]
    docs = table(spark, SF_SMALL, "documents")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    # language: every document with letters is clean here
    model = langid.fit(docs)
    left = {i for i, r in rows.items() if not model.predict(r.text)[2]}
    assert left == {i for i, r in rows.items() if any(c.isalpha() for c in r.text or "")}
    # exact copies: the largest id of equal texts
    last = {}
    for i in left:
        key = (rows[i].text or "").translate(LOWER)
        last[key] = max(i, last.get(key, i))
    left2 = set(last.values())
    # near copies: the smallest id of each component
    fps = {i: simhash.fingerprint(rows[i].text) for i in left2}
    root = {i: i for i in left2}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(left2)
    for x, a in enumerate(order):
        for b in order[x + 1:]:
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    left3 = {i for i in left2 if find(i) == i}
    # mixing: readings of each document follow from the schedule
    sizes = Counter(rows[i].source for i in left3)
    shares = mixing.integer_shares({s: float(n) ** mixing.TEMPERATURE for s, n in sorted(sizes.items())})
    slots, blocks = mixing.schedule(shares), {s: -(-n // mixing.BLOCK_ROWS) for s, n in sizes.items()}
    period = sum(shares.values())
    turns = {s: [p * period + x for p in range(-(-blocks[s] // shares[s]) + 5) for x in slots[s]] for s in sizes}
    end = max(turns[s][blocks[s] - 1] for s in sizes) + 1
    used = {s: sum(x < end for x in turns[s]) for s in sizes}

    current, folder = docs, str(tmp_path)
    for (name, stage), want in zip(corpus_pipeline.STAGES[:3], (left, left2, left3)):
        stage(spark, current, SF_SMALL).write.parquet(path := os.path.join(folder, name))
        current = spark.read.parquet(path)
        assert current.columns == columns and sorted(r.doc_id for r in current.collect()) == sorted(want), name
    corpus_pipeline.STAGES[3][1](spark, current, SF_SMALL).write.parquet(path := os.path.join(folder, "mixing"))
    mixed = spark.read.parquet(path)
    assert mixed.columns == columns
    readings = Counter(r.doc_id for r in mixed.collect())
    assert set(readings) == left3
    for s, n in sizes.items():
        ids = [i for i in left3 if rows[i].source == s]
        whole, extra = divmod(used[s], blocks[s])
        assert all(whole <= readings[i] <= whole + (extra > 0) for i in ids)
    tk = Tokenizer.from_file(queries.VOCABULARY)
    tk.no_padding()
    tk.no_truncation()
    final = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter(r.doc_id for r in final) == readings
    for r in final:
        ids = tk.encode(rows[r.doc_id].text or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.decoded == tk.decode(ids, skip_special_tokens=False)


def test_the_result_has_the_place_in_the_mix(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"s{i % 3 % 2}", f"text {i}") for i in range(300)],
                                 "doc_id long, source string, text string")
    mixed = mixing.mix(docs)
    want = [r.doc_id for r in sorted(mixed.collect(), key=lambda r: (r.mix_slot, r.mix_place))]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        corpus_pipeline.mixed_sources(spark, docs, "").write.parquet(str(tmp_path / "mix"))
    finally:
        spark.conf.set(key, old)
    stored = spark.read.parquet(str(tmp_path / "mix"))
    assert len(stored.inputFiles()) > 1
    got = sorted(corpus_pipeline.tokens(spark, stored, "").collect(), key=lambda r: r.place)
    assert [r.place for r in got] == list(range(len(want))) and [r.doc_id for r in got] == want


def test_columns_of_any_names_come_through_all_stages_and_no_copy_stays(spark, tmp_path):
    names = ["__file", "__start", "__rid", "__text", "__rejected", "place", "row", "mix_slot_"]
    data = [(i, f"s{i % 2}", "en", f"the cat number {i} and the dog of the house", *(f"{n}{i}" for n in names))
            for i in range(60)]
    columns = ", ".join(f"{n} string" for n in names)
    spark.createDataFrame(data, f"doc_id long, source string, lang string, text string, {columns}").write.parquet(
        str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    current = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        stage(spark, current, str(tmp_path)).write.parquet(str(tmp_path / name))
        current = spark.read.parquet(str(tmp_path / name))
        assert current.columns == docs.columns
        assert current.count() and all(tuple(r) == data[r.doc_id] for r in current.collect()), name
    with scratch_run(spark) as folder:
        assert corpus_pipeline.run(spark, str(tmp_path)).collect()
        assert [n.split("-")[:2] for n in os.listdir(folder)] == [["pipeline", "mixing"]]
    assert not os.path.exists(folder)


def test_nothing_else_imports_the_subpackage():
    top = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for folder, _, names in os.walk(os.path.join(top, "tallyfold")):
        for name in names:
            if name.endswith(".py") and not folder.endswith("llm"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert not re.search(r"\bllm\b", f.read()), name
