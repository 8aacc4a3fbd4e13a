"""Exact deduplication by deterministic block naming.

A text is cut into blocks of ``block_chars`` characters.  Equal blocks are
brought together by a shuffle on their content and get one integer name, the
smallest number of a block row that bears it.  Then adjacent names are paired
and the pairs named the same way, until every document is left with a single
integer.  Names are given per distinct content, never per hash value, so two
documents end with the same (level, name) if and only if their texts are equal.

The text moves in the first step only; each later step handles half as many
rows of four integers.  Everything is DataFrame code.  A block or pair that
very many documents share is counted before its shuffle (partial aggregation)
and the join that hands its name back can be split by AQE.

Defined results: a null text counts as empty and all empty texts are equal; a
null ``doc_id`` is smaller than any other; among rows of equal text and equal
``doc_id`` exactly one stays; other columns are ignored.  Dropping copies goes by
row numbers that hold in every scan (:func:`tallyfold.llm.common.numbered`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import durable, lower_ascii, numbered, unused

BLOCK_CHARS = 4096


def _blocks(docs: DataFrame, id_col: str, text_col: str, block_chars: int,
            rid: Column | None = None) -> DataFrame:
    """One row per block: document row number, position, block and its own number."""
    whole = docs.select(
        (F.monotonically_increasing_id() if rid is None else rid).alias("rid"),
        F.col(id_col).cast("long").alias("doc_id"),
        lower_ascii(F.col(text_col)).alias("norm"))
    cut = whole.select(
        "rid", "doc_id", F.sha2("norm", 256).alias("text_sha256"),
        F.expr(f"regexp_extract_all(norm, '(?s).{{1,{block_chars}}}', 0)").alias("cut"))
    cut = cut.withColumn("cut", F.when(F.size("cut") == 0, F.array(F.lit(""))).otherwise(F.col("cut")))
    rows = cut.select("rid", "doc_id", "text_sha256", F.size("cut").alias("n"),
                      F.posexplode("cut").alias("pos", "block"))
    return rows.withColumn("bid", F.monotonically_increasing_id())


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Replace the key columns by ``name``: the smallest ``bid`` among equal keys."""
    names = rows.groupBy(*keys).agg(F.min("bid").alias("name"))
    return rows.join(names, keys).drop(*keys)


def document_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block_chars: int = BLOCK_CHARS, rid: Column | None = None) -> DataFrame:
    """rid, doc_id, text_sha256, level, name: equal (level, name) means equal text."""
    rows = durable(_named(_blocks(docs, id_col, text_col, block_chars, rid), ["block"]))
    most = rows.agg(F.max("n")).first()[0] or 0
    heads = rows.where("pos = 0").select("rid", "doc_id", "text_sha256", "n", "name")
    current = rows.where("n > 1").select("rid", "pos", "n", "bid", "name")
    done, level = [heads.where("n = 1").select("rid", F.lit(0).alias("level"), "name")], 0
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        left = F.col("pos") % 2 == 0
        pairs = current.groupBy("rid", F.floor(F.col("pos") / 2).cast("int").alias("pos"),
                                F.floor((F.col("n") + 1) / 2).cast("int").alias("n")).agg(
            F.min("bid").alias("bid"),
            F.max(F.when(left, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(~left, F.col("name"))), F.lit(-1)).alias("b"))
        named = durable(_named(pairs, ["a", "b"]))
        done.append(named.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))
        current = named.where("n > 1")
    names = done[0]
    for more in done[1:]:
        names = names.unionByName(more)
    return heads.drop("n", "name").join(names, "rid")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_chars: int = BLOCK_CHARS, rid: Column | None = None) -> DataFrame:
    """rid, doc_id, keep_id, group_size, kept, text_sha256: one row per input row.

    ``rid`` is a number that ``docs`` has for each row; without it, one of this scan.
    """
    rows = durable(document_names(docs, id_col, text_col, block_chars, rid))
    # stored, so that the join below has a shuffle of its own on both sides and
    # AQE can split a group of very many copies
    groups = durable(rows.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct("doc_id", "rid")).alias("last")))
    return rows.join(groups, ["level", "name"]).select(
        "rid", "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("last.rid")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = numbered(docs, rid := unused("__rid", docs.columns))
    dropped = exact_groups(rows, id_col, text_col, rid=F.col(rid)).where(~F.col("kept")).select(
        F.col("rid").alias(rid))
    return rows.join(dropped, rid, "left_anti").drop(rid)
