"""From raw documents to tokens, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  Each stage
learns from, and works on, all that its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import bpe, exact_dedup, langid, mixing, simhash
from tallyfold.llm.common import numbered, table, unused
from tallyfold.llm.queries import VOCABULARY
from tallyfold.session import remove_path, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that language identification doesn't reject."""
    # names that no column of docs begins with
    prefix = unused("__", [c[:i] for c in docs.columns for i in range(len(c) + 1)])
    found = langid.predict(docs, langid.fit(docs), docs.columns, prefix=prefix)
    return found.where(f"not {prefix}rejected").drop(*(f"{prefix}{n}" for n in ("lang_pred", "score", "rejected")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, that of the smallest doc_id."""
    return simhash.drop_near_copies(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a row for each reading of a document, stored in its order."""
    return mixing.in_mix_order(mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, decoded text and place in the mix of every reading.

    The place is that of the row in the stored mix, by file and row in the file.
    """
    return bpe.bpe_round_trip(numbered(docs, "place"), VOCABULARY, columns=("place",))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language), ("exact_dedup", exact_copies), ("near_dedup", near_copies),
    ("mixing", mixed_sources), ("tokens", tokens)]

# centroids, fingerprints, schedules and tokens have no SQL form: tests hold the
# pipeline against a brute-force version instead
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it.

    A stage's copy goes when the next stage is stored.  The last copy is read by
    the result: it stays until the caller's ``session.scratch_run`` ends.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(path := scratch_path(spark, f"pipeline-{name}"))
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
