"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import (
    ann, bpe, exact_dedup, html_extract, langid, lexical_search, lm, mixing, secret_scan, sharding,
    simhash, sql, token_alignment, toxicity)
from tallyfold.llm.common import durable, fold_of, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ALIGNED_A, ALIGNED_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; digests of ids and decoded text."""
    return bpe.digests(bpe.bpe_round_trip(table(spark, sf_dir, "documents"), VOCABULARY))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every reading of every document in a mix by tempered source sizes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), SHARDS)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("rid")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from two folds of three."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of("doc_id", 3) == 1)
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, ["doc_id", "held_out"])


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned from four folds of five."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of("doc_id", 5) == 1)
    model = lm.train(docs.where(~F.col("held_out")))
    found = durable(lm.score(docs, model, ["doc_id", "held_out"]))
    model.remove()
    return found


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"), ["page_id", "url"]).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every vector whose id is divisible by 100."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from four folds of five."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold_of("doc_id", 5) == 0)
    labels = table(spark, sf_dir, "labels").where(fold_of("doc_id", 5) != 0)
    insults = toxicity.learn_insults(docs.where(~F.col("held_out")), labels)
    matched = durable(toxicity.matches(docs, ["doc_id", "held_out"], insults))
    weights = toxicity.fit(matched.where(~F.col("held_out")), labels)
    return toxicity.scored(matched, weights).select("doc_id", "held_out", "score", "predicted")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    return secret_scan.digests(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of byte-level and piece tokens of every document, links with corpus-wide counts."""
    vocabularies = token_alignment.Vocabularies(spark, ALIGNED_A, ALIGNED_B)
    aligned = token_alignment.align(table(spark, sf_dir, "documents"), vocabularies)
    return token_alignment.score_links(token_alignment.digests(aligned), vocabularies)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for each benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe, op2_mixing, op3_simhash, op4_sharding, op5_exact_dedup,
                            op6_langid, op7_lm, op8_html, op9_ann, op10_toxicity, op11_secret_scan,
                            op12_token_alignment, op13_lexical_search)}

SQL: dict[str, str] = {"op5_exact_dedup": sql.EXACT_DEDUP, "op11_secret_scan": sql.secrets(),
                       "op13_lexical_search": sql.LEXICAL_SEARCH}
