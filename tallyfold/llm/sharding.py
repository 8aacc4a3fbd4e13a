"""Sharding through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size, an arithmetic progression from two hashes of its name.  The shards take
turns; each turn claims the first slot in the shard's order that is still free.
A shard with weight ``w`` takes its turns ``w`` times as often.  Each shard ends
with its share of the slots to within one, and when a shard goes, nearly only
its own slots change hands.

The table has a fixed number of rows, so it is broadcast; placing a document
is one hash and one lookup, with no shuffle.

Defined results: equal ids, null included, share a shard; repeated rows stay
rows; an empty table gives no rows; no shards, repeated names and a table
smaller than the shards need are errors.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65537  # prime


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], weights: list[int] | None = None,
                 size: int = TABLE_SIZE) -> list[int]:
    """The shard (its place in ``shards``) of each slot."""
    weights = weights or [1] * len(shards)
    if not shards or len(set(shards)) < len(shards) or len(weights) != len(shards):
        raise ValueError("shards need distinct names, and a weight each")
    if not _is_prime(size) or sum(weights) > size or min(weights) < 1:
        raise ValueError("the table's size must be a prime of at least the sum of weights")
    digests = [hashlib.blake2b(s.encode(), digest_size=16).digest() for s in shards]
    place = [int.from_bytes(d[:8], "big") % size for d in digests]
    step = [int.from_bytes(d[8:], "big") % (size - 1) + 1 for d in digests]
    table, free = [-1] * size, size
    while True:
        for i, turns in enumerate(weights):
            for _ in range(turns):
                while table[place[i]] >= 0:
                    place[i] = (place[i] + step[i]) % size
                table[place[i]] = i
                free -= 1
                if not free:
                    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: 60 bits of the MD5 of its text (null: of the empty text)."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size).cast("int")


def place(docs: DataFrame, shards: list[str], weights: list[int] | None = None,
          key_col: str = "doc_id", size: int = TABLE_SIZE) -> DataFrame:
    """All columns of ``docs`` and ``slot``, ``shard`` (number) and ``shard_name``.

    Columns of these names are replaced.
    """
    table = docs.sparkSession.createDataFrame(
        [(slot, i, shards[i]) for slot, i in enumerate(lookup_table(shards, weights, size))],
        "slot int, shard int, shard_name string")
    docs = docs.drop(*[c for c in ("slot", "shard", "shard_name") if c != key_col])
    rows = docs.withColumn("slot", slot_of(F.col(key_col), size))
    return rows.join(F.broadcast(table), "slot").select(*rows.columns, "shard", "shard_name")
