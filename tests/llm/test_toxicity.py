"""The grammar's patterns, the search for insults, held-out results."""

import itertools
import random
import zlib

import numpy as np
import pytest

from tallyfold.llm import queries, toxicity
from tallyfold.llm.common import table

from conftest import SF_SMALL

SF = SF_SMALL.replace("sf0.001", "sf0.01")


@pytest.mark.parametrize("text,patterns", [
    (None, []), ("", []), ("a harmless text, no more.", []),
    ("some idiot was here", ["insult"]), ("You are an idiot", ["insult+aimed"]), ("IDIOT you", ["insult+aimed"]),
    ("you are not an idiot", ["insult+negated+aimed"]), ("not here. an idiot", ["insult"]),
    ("he said you are an idiot", ["insult+aimed+reported"]), ("we kill time", []), ("I will kill you", ["threat+aimed"]),
    ("I will not kill them", ["threat+negated+aimed"]), ("she wrote that they kill you", ["threat+aimed+reported"]),
    ("idiotically", []), ("xidiot", []), ("idiot, moron; you clown", ["insult", "insult", "insult+aimed"]),
    ("you went home after a long day to find an idiot", ["insult"]),
    # punctuated speech
    ('He said: "you are an idiot"', ["insult+aimed+reported"]), ("she said, you idiot", ["insult+aimed+reported"]),
    ('"you idiot", he said', ["insult+aimed+reported"]), ('“You idiot!” she told us.', ["insult+aimed+reported"]),
    ('"hello", he said. You idiot', ["insult+aimed"]), ('He said so. "You idiot"', ["insult+aimed"]),
    ('"fine words" are not what a good man ever said; you idiot', ["insult+aimed+reported"]),
    ('"you idiot" is a thing which nobody ever said', ["insult+aimed"]),
    ("you, idiot", ["insult+aimed"]), ("you went home, idiot", ["insult"]),
    ("you are not, in my view, an idiot", ["insult+negated"]), ("not here, an idiot", ["insult"]),
    ("No, you idiot", ["insult+aimed"]), ("no, that is wrong, you idiot", ["insult+aimed"]),
    ('you are not "an idiot"', ["insult+negated+aimed"])])
def test_patterns(text, patterns):
    matcher = toxicity.Matcher()
    assert sorted(matcher.match(text).elements()) == sorted(patterns)
    features = dict(zip(toxicity.FEATURES, matcher.features(text)))
    assert all(features[p] == (p in patterns) for p in toxicity.PATTERNS)
    assert features["several"] == (sum("negated" not in p for p in patterns) > 1)


def test_composition_equals_one_machine_after_the_other():
    first, second = toxicity.Transducer(0, toxicity._negate), toxicity.Transducer(False, toxicity._report)
    tags = "target negation other insult report insult other threat insult".split()
    assert (first >> second).run(tags) == second.run(first.run(tags))


def test_stems_and_long_clauses():
    insults = toxicity.Insults(frozenset(["bad"]), frozenset(["vequ"]))
    matcher = toxicity.Matcher(insults)
    assert matcher.match("vequté avequ vequ bad badly")["insult"] == 2
    long = "word " * 50_000 + "he said " + "word " * 5000 + "vequsse"
    assert list(matcher.match(long)) == ["insult+reported"]


def test_insults_are_learned_without_near_copies(spark):
    rng, words = random.Random(4), ["".join(p) + "o" for p in itertools.product("bcdfghjk", repeat=3)]
    docs, labels = [], []
    for i in range(300):
        toxic = i % 5 == 0
        text = " ".join(rng.choice(words) for _ in range(30)) + (" glurk snorb" if toxic else "")
        docs.append((i, text))
        labels.append((i, int(toxic)))
    copied = "alone these words stand in twenty copies of one text and nowhere else at all"
    docs += [(1000 + i, copied) for i in range(20)]
    labels += [(1000 + i, 1) for i in range(20)]
    insults = toxicity.learn_insults(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "glurk" in insults and "snorb" in insults and "nowhere" not in insults and not any(w in insults for w in words)
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.learn_insults(spark.createDataFrame(docs, "doc_id long, text string"), nothing) == toxicity.Insults()


def test_held_out_results(spark):
    got = {r.doc_id: r for r in queries.op10_toxicity(spark, SF).collect()}
    assert len(got) == table(spark, SF, "documents").count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    labels = [(r.doc_id, r.toxic) for r in table(spark, SF, "labels").collect() if got[r.doc_id].held_out]
    clean, toxic = ([got[i].score for i, t in labels if t == v] for v in (0, 1))
    better = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert better > 0.8 and sum(s >= 0.5 for s in clean) <= 0.02 * len(clean)


def test_query_equals_a_plain_reading_of_every_document(spark):
    got = {r.doc_id: r for r in queries.op10_toxicity(spark, SF_SMALL).collect()}
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    train = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0")
    insults = toxicity.learn_insults(train, labels)
    matcher = toxicity.Matcher(insults)
    found = {r.doc_id: matcher.features(r.text) for r in docs.collect()}
    truth = {}
    for r in labels.collect():
        if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 5:
            truth[r.doc_id] = max(truth.get(r.doc_id, 0), int(r.toxic))
    x = np.array([[1, *found[i]] for i in truth if i in found], float)
    y = np.array([truth[i] for i in truth if i in found], float)
    start = toxicity.prior_weights()
    weights = start.copy()
    for _ in range(5000):  # plain gradient steps to the same optimum
        p = 1 / (1 + np.exp(-x @ weights))
        weights += 2 / len(y) * (x.T @ (y - p) - toxicity.PENALTY * (weights - start))
    for i, features in found.items():
        want = 1 / (1 + np.exp(-(weights[0] + np.dot(weights[1:], features))))
        assert got[i].score == pytest.approx(want, abs=0.02)


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "you idiot", "x"), (3, "you idiot", "x"), (3, "you idiot", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    matched = toxicity.matches(docs, ["doc_id"])
    labels = spark.createDataFrame([(3, 1), (3, 0), (1, None), (None, 1), (99, 1), (2, 0)], "doc_id long, toxic int")
    weights = toxicity.fit(matched, labels)
    found = toxicity.scored(matched, weights).collect()
    assert len(found) == 5 and {r.predicted for r in found if r.doc_id in (1, 2)} == {0}
    assert all(r.predicted == 1 for r in found if r.doc_id == 3)
    assert (toxicity.fit(matched, labels.limit(0)) == toxicity.prior_weights()).all()
    assert toxicity.scored(matched.limit(0), weights).collect() == []
    clash = docs.withColumnRenamed("score", "__text")
    assert {r["__text"] for r in toxicity.matches(clash, ["doc_id", "__text"]).collect()} == {"x"}
