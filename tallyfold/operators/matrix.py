"""Dense entity-by-name matrices.

The spine (every entity × every name) is produced by exploding the
parameter list on each entity row — a narrow Generate, not a cross join —
so it grows linearly with the entity list and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spine(entities: DataFrame, dims: list[tuple[str, list[str]]]) -> DataFrame:
    """Distinct entity rows × each listed dimension.

    ``dims`` are (column name, ordered values) pairs taken from parameters,
    so their size is fixed by the caller, not by the data.
    """
    out = entities.distinct()
    for name, values in dims:
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def dense_count_matrix(facts: DataFrame, entities: DataFrame, entity: str, name: str,
                       names: list[str], fill: int = 0) -> DataFrame:
    """Count facts per (entity, name); every entity × name present, zero-filled.

    Counting happens on the facts with a partial map-side aggregate and the
    pivot runs on the (small) counts; the entity list is joined last so
    entities without facts appear with zeros.  Facts whose name is not in
    ``names`` or whose entity is not listed never reach the output.
    """
    counts = facts.where(F.col(name).isin(names)).groupBy(entity, name).agg(
        F.count(F.lit(1)).alias("_n"))
    wide = counts.groupBy(entity).pivot(name, names).agg(F.first("_n"))
    ents = entities.select(entity).distinct()
    out = ents.join(wide, entity, "left")
    return out.select(entity, *[F.coalesce(F.col(f"`{n}`"), F.lit(fill)).cast("long").alias(n)
                                for n in names])
