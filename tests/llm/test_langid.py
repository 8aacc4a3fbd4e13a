"""Language identification: held-out accuracy, edge cases, the n-gram counts."""

import base64
import random

import numpy as np
from pyspark.sql import functions as F

from tallyfold.llm import langid, queries
from tallyfold.llm.common import table

from conftest import SF_SMALL

SF = SF_SMALL.replace("sf0.001", "sf0.01")


def brute_counts(text):
    plain = " " + "".join(c if c.isalpha() else " " for c in text.lower())
    while "  " in plain:
        plain = plain.replace("  ", " ")
    counts = np.zeros(langid.DIMS, np.int64)
    for end in range(1, len(plain)):
        for n in range(1, 4):
            if end - n + 1 >= 0:
                h = 0
                for i, c in enumerate(plain[end - n + 1:end + 1]):
                    h = (h * 65599 + ord(c) + i + 1) % (1 << 32)
                counts[(h * 2654435761 % (1 << 32)) >> 20] += 1
    return counts


def test_counts_equal_a_plain_loop():
    for text in ("abc", "Ab  c, d!", "é😀𝔸x", "  x", "a", "one two  three"):
        assert (langid.ngram_counts(text) == brute_counts(text)).all(), text
    for text in (None, "", "12 -- 3", "\n"):
        assert langid.ngram_counts(text) is None


def test_long_texts_are_counted_whole(monkeypatch):
    text = "the quick brown fox. " * 40
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "_CHUNK", 7)
    assert (langid.ngram_counts(text) == whole).all()


def test_held_out_accuracy_and_folds(spark):
    import zlib
    got = queries.op6_langid(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in table(spark, SF, "documents").select("doc_id", "lang").collect()}
    assert sorted(r.doc_id for r in got) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and not any(r.rejected for r in got)


def test_edge_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"),
            (4, "", None), (5, "123 !", "de"), (None, "the dog", None), (6, "the cat and the dog", "en"),
            (6, "the cat and the dog", "en"), (7, "日本語のテキスト", None)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    model = langid.fit(docs)
    found = langid.predict(docs, model, ["doc_id", "lang"]).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    assert by_id[1].lang_pred == by_id[6].lang_pred == by_id[None].lang_pred == "en" and by_id[2].lang_pred == "de"
    for i in (3, 4, 5):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[7].rejected and by_id[7].lang_pred in ("de", "en")
    clash = langid.predict(docs, model, docs.columns, prefix="__")
    assert clash.columns == [*docs.columns, "__lang_pred", "__score", "__rejected"]
    assert {r.score for r in clash.collect()} == {0.5}
    empty = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, empty, ["doc_id"]).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model, ["doc_id"]).collect() == []


FINNISH = ("Suomen kieli kuuluu itämerensuomalaisiin kieliin ja sitä puhuu noin viisi miljoonaa ihmistä. Talvella on "
           "kylmä ja lunta sataa paljon, mutta kesällä aurinko paistaa melkein koko yön. ")
POLISH = ("Język polski należy do grupy języków słowiańskich i jest używany przez około czterdzieści milionów ludzi. "
          "Zimą jest zimno i pada śnieg, ale latem słońce świeci długo. ")
TURKISH = ("Türkçe yaklaşık seksen milyon kişi tarafından konuşulan bir dildir. Kışın hava soğuk olur ve kar yağar, "
           "ama yazın güneş uzun süre parlar. ")


def test_noise_and_unseen_languages_are_rejected_and_clean_rows_are_not(spark):
    docs = table(spark, SF, "documents").withColumn("held_out", queries.fold_of("doc_id", 3) == 1)
    model = langid.fit(docs.where("not held_out"))
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(300))
    for text in ("".join(rng.choices(letters, k=2000)), words, base64.b64encode(rng.randbytes(3000)).decode(),
                 FINNISH, POLISH, TURKISH):
        assert model.predict(text)[2], text[:40]
    assert not any(model.predict(r.text)[2] for r in docs.where("held_out").select("text").collect())


def test_odd_rows_get_no_centre_and_set_no_limit():
    rng = np.random.default_rng(1)
    points = np.vstack([rng.random((300, 50)) + 3 * (np.arange(50) % 2), np.eye(50)[:3]])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres, labels = langid._k_means(points, 4)
    assert np.bincount(labels, minlength=len(centres)).min() > 3
    own = (points * centres[labels]).sum(axis=1)
    limits = langid._limits(own, np.full(len(own), 50))
    assert limits[langid._size(50)] > 0.9 * langid.REJECT_SHARE * np.median(own)
    assert (np.diff(limits) >= 0).all()


def test_the_model_is_the_same_however_the_rows_are_split(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    copies = docs.where("lang = 'en'").limit(1).select(F.explode(F.sequence(F.lit(1), F.lit(3000))).alias("n"), "*")
    copies = copies.drop("n").checkpoint()
    docs = docs.unionByName(copies)  # a hot group of copies counts as one text of the sample
    one, many = langid.fit(docs.coalesce(1)), langid.fit(docs.repartition(7))
    assert one.languages == many.languages and (one.centroids == many.centroids).all()
    assert (one.limits == many.limits).all() and (one.idf == many.idf).all()
    clean = table(spark, SF, "documents").select("text").limit(300).collect()
    assert not any(one.predict(r.text)[2] for r in clean)
