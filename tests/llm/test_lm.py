"""The language model against interpolated modified Kneser-Ney over dictionaries."""

import math
import os
import resource
import zlib
from collections import Counter

import pytest

from tallyfold.llm import lm, queries
from tallyfold.llm.common import table

from conftest import SF_SMALL

START, END = "<s>", "</s>"


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for white in "\t\n\v\f\r":
        lowered = lowered.replace(white, " ")
    return [w for w in lowered.split(" ") if w] + [END]


def discounts(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return [0.0, *(min(max(d, 0.05 * k), 0.95 * k) for k, d in enumerate(found, 1))]


class Brute:
    def __init__(self, texts):
        self.word, self.pair = Counter(), Counter()
        for t in texts:
            words = tokens(t)
            self.word.update(words)
            self.pair.update(zip([START, *words], words))
        self.total, self.v = sum(self.word.values()), len(self.word)
        self.context, self.before = Counter(), Counter(w for _, w in self.pair)
        for (v, _), c in self.pair.items():
            self.context[v] += c
        self.d, self.k = discounts(list(self.pair.values())), discounts(list(self.before.values()))
        self.taken = Counter()
        for (v, _), c in self.pair.items():
            self.taken[v] += self.d[min(c, 3)]

    def score(self, text):
        n_known = base = score = 0
        words = tokens(text)
        distinct = sum(self.before.values())
        rest = sum(self.k[min(c, 3)] for c in self.before.values()) / max(distinct, 1)
        for v, w in zip([START, *words], words):
            n_known += self.word[w] > 0
            base += math.log10((self.word[w] + 0.5) / (self.total + 0.5 * (self.v + 1)))
            if self.total:
                low = max(self.before[w] - self.k[min(self.before[w], 3)], 0) / distinct + rest / (self.v + 1)
                c = self.pair[v, w]
                p = low if not self.context[v] else (
                    max(c - self.d[min(c, 3)], 0) + self.taken[v] * low) / self.context[v]
                score += math.log10(p)
        return len(words), n_known, self.total, base, score


def check(docs, model, brute):
    found = lm.score(docs, model, ["doc_id", "text"]).collect()
    for r in found:
        want = brute.score(r.text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3], r.text
        assert r.base_score == pytest.approx(want[3], abs=1e-9, rel=1e-9)
        assert r.score == pytest.approx(want[4], abs=1e-7, rel=1e-7), r.text
    return found


def test_scores_equal_the_definition(spark, tmp_path):
    texts = ["the cat sat on the mat", "The cat\tran", None, "", "the dog sat", "a b a b a b a c", "É é",
             "the cat sat on the mat", "x " * 50, "the the the the"]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    model = lm.train(docs, str(tmp_path / "model"))
    more = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "never seen words", "cat the", "é \x1f"])],
                                 "doc_id long, text string")
    assert len(check(more, model, Brute(texts))) == len(texts) + 3
    assert lm.score(more.limit(0), model, ["doc_id"]).collect() == []


def test_probabilities_of_all_next_words_add_up_to_one(spark, tmp_path):
    texts = ["a b c a b d", "b a", "c c d a a b"]
    model = lm.train(spark.createDataFrame([(t,) for t in texts], "text string"), str(tmp_path / "model"))
    brute = Brute(texts)
    for v in ("a", "b", "zzz"):
        total = 0.0
        for w in [*brute.word, "unseen"]:
            if w == END:
                total += 10 ** (float(model.score([lm.token_hashes(v)])[3][0]) - first(model, v))
            else:
                total += 10 ** (second(model, v, w) - first(model, v))
        assert total == pytest.approx(1, abs=1e-9), v


def first(model, v):
    """log10 of the first word's probability."""
    return float(model.score([lm.token_hashes(v)[:1]])[3][0])


def second(model, v, w):
    return float(model.score([lm.token_hashes(f"{v} {w}")[:2]])[3][0])


def test_nothing_to_learn_from(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = lm.train(docs.limit(0), str(tmp_path / "model"))
    assert [(r.score, r.train_tokens, r.n_known) for r in lm.score(docs, model, ["doc_id"]).collect()] == [(0.0, 0, 0)] * 2


def test_small_flushes_give_the_same_model(spark, tmp_path, monkeypatch):
    texts = [f"w{i % 7} w{i % 3} w{i % 5} the" for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(lm, "FLUSH_TOKENS", 9)
    monkeypatch.setattr(lm, "SCORE_TOKENS", 11)
    monkeypatch.setattr(lm, "SCORE_TOKENS_PER_SHARD", 0)
    check(docs, lm.train(docs, str(tmp_path / "model")), Brute(texts))


def test_many_shards_need_few_open_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lm, "LEAST_SHARD_BITS", 12)
    texts = [" ".join(f"w{(i * 31 + j * j) % 4000}" for j in range(400)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = lm.train(docs, str(tmp_path / "model"))
    shards = {name for name in os.listdir(model.folder) if name.startswith("bigram-")}
    assert model.shard_bits == 12 and len(shards) > 3500
    assert not any("." in name for name in os.listdir(model.folder))
    brute, before = Brute(texts), resource.getrlimit(resource.RLIMIT_NOFILE)
    resource.setrlimit(resource.RLIMIT_NOFILE, (256, before[1]))
    try:
        for text in [*texts[:3], "w1 unseen w2"]:
            found = [float(x[0]) for x in model.score([lm.token_hashes(text)])]
            want = brute.score(text)
            assert found == pytest.approx([want[0], want[1], want[3], want[4]], rel=1e-7)
        everything = model.score([lm.token_hashes(t) for t in texts])
        assert len(everything[0]) == 60 and len(model._open) <= lm.MAPPED
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, before)


def test_shards_grow_with_the_text():
    gib = 1 << 30
    assert [lm.shard_bits_for(n) for n in (0, 100 << 20, 4 * gib, 30 * gib)] == [6, 6, 11, 12]
    assert 100_000 * gib / 2 ** lm.shard_bits_for(100_000 * gib) <= lm.LARGEST_SHARD


def test_long_texts_null_ids_and_clashing_names(spark, tmp_path):
    texts = ["a b " * 30_000, "c", None]
    docs = spark.createDataFrame([(None, t, 1, 2) for t in texts], "doc_id long, text string, shard int, `__text` int")
    model = lm.train(docs, str(tmp_path / "model"))
    assert len(check(docs, model, Brute(texts))) == 3
    assert lm.score(docs, model, ["shard", "__text"]).columns[:2] == ["shard", "__text"]


def test_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    brute = Brute([t for i, t in docs.items() if not held[i]])
    found = queries.op7_lm(spark, SF_SMALL).collect()
    assert len(found) == len(docs)
    for r in found:
        want = brute.score(docs[r.doc_id])
        assert r.held_out == held[r.doc_id] and (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert r.base_score == pytest.approx(want[3], rel=1e-9) and r.score == pytest.approx(want[4], rel=1e-6)
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
