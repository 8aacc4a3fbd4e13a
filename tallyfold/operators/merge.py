"""Multi-source merge into long facts with a placeholder precedence rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.logic import first_match, in_list, to_number

FACT_COLS = ["ubigeo", "name", "fecha", "modal", "value"]


def lookup_to_long(df: DataFrame, key: str, month_col: str, month_numbers: dict[str, str],
                   year: str, name: str, modal: str, value: str) -> DataFrame:
    """A (key, month name) list as long facts; unknown month names give no month."""
    month = first_match([(F.col(month_col) == n, F.lit(mm)) for n, mm in month_numbers.items()])
    return df.select(F.col(key).alias("ubigeo"), F.lit(name).alias("name"),
                     F.concat(month, F.lit(year)).alias("fecha"),
                     F.lit(modal).alias("modal"), F.lit(value).alias("value"))


def indicator_fanout(df: DataFrame, presence_value: str = "1", role_name: str = "CARGO_PPSS",
                     mode_name: str = "MODALIDAD", role_if: Column | None = None) -> DataFrame:
    """One fact row → presence, role and mode indicator rows.

    * presence: same name, value ``presence_value``;
    * role: name ``role_name``, value kept — only where ``role_if`` holds;
    * mode: name ``mode_name``, value = the mode text.

    One scan of the source, three rows generated per input row.
    """
    def fact(name, value):
        return F.struct(name.alias("name"), value.alias("value"))

    role = fact(F.lit(role_name), F.col("value"))
    if role_if is not None:
        role = F.when(F.coalesce(role_if, F.lit(False)), role)
    kinds = F.array(fact(F.col("name"), F.lit(presence_value)), role,
                    fact(F.lit(mode_name), F.col("modal")))
    out = df.select("ubigeo", "fecha", "modal", F.explode(kinds).alias("_f"))
    return out.where(F.col("_f").isNotNull()).select(
        "ubigeo", F.col("_f.name").alias("name"), "fecha", "modal",
        F.col("_f.value").alias("value"))


def drop_placeholders(df: DataFrame, keys: list[str], value: str = "value",
                      modal: str = "modal", token: str = "-",
                      keep_one_if_all_placeholder: bool = False) -> DataFrame:
    """Placeholder precedence inside groups of more than one row (X11).

    Rule: count the group's rows; in groups of more than one drop rows whose
    value is the placeholder; recount; in groups still larger than one drop
    rows whose mode is the placeholder; drop the mode and de-duplicate.  A
    group made only of placeholders vanishes (the reference's rule);
    ``keep_one_if_all_placeholder=True`` keeps such a group's values instead
    (opt-in repair: a doubled attendance row then still counts).

    Plan: rows are first reduced to distinct (keys, value, mode) with their
    multiplicity — a partial map-side aggregate, so a group holding a large
    share of all rows ships a handful of rows — and both counts are window
    sums over that small table.
    """
    by = Window.partitionBy(*keys)
    not_value_token = F.coalesce(F.col(value) != token, F.lit(False))
    not_modal_token = F.coalesce(F.col(modal) != token, F.lit(False))
    dist = df.groupBy(*keys, value, modal).agg(F.count(F.lit(1)).alias("_m"))
    dist = dist.withColumn("_n1", F.sum("_m").over(by))
    first = dist.where((F.col("_n1") == 1) | not_value_token)
    first = first.withColumn("_n2", F.sum("_m").over(by))
    keep = (F.col("_n2") == 1) | not_modal_token
    if keep_one_if_all_placeholder:
        first = first.withColumn("_any_mode", F.max(not_modal_token).over(by))
        keep = keep | ~F.col("_any_mode")
    second = first.where(keep)
    return second.select(*keys, value).distinct()


def dense_indicator_matrix(entities: DataFrame, facts: DataFrame, entity: str,
                           months: list[str], names: list[str], zero_names: list[str],
                           numeric_prefixes: list[str]) -> DataFrame:
    """Entity × (name, month) matrix of merged facts.

    Cells of ``zero_names`` without a fact become ``"0"``; other empty cells
    stay missing.  Columns starting with a ``numeric_prefixes`` entry are
    turned into numbers.  The facts are reduced to one row per cell, those of
    listed months and names pivoted and joined to the entities once; a cell of a
    listed entity with several values stops the job, naming it (Spark's pivot
    would silently keep one).
    """
    ids = list(entities.columns)
    # the pivot's value list leaves out unlisted months and names
    cells = (facts.select(entity, F.concat_ws("_", "name", "fecha").alias("_cell"), "value")
                  .groupBy(entity, "_cell").agg(F.count(F.lit(1)).alias("n"), F.first("value").alias("v"))
                  .select(entity, "_cell", F.struct("n", "v").alias("_c")))
    # month-major, as the spine is crossed month then name
    columns = [(n, f"{n}_{m}") for m in months for n in names]
    wide = cells.groupBy(entity).pivot("_cell", [c for _, c in columns]).agg(F.first("_c"))
    joined = entities.distinct().join(wide, entity, "left")
    out = []
    for name, c in columns:
        several = F.raise_error(F.concat(F.lit("several values in one matrix cell: "),
                                         F.col(entity).cast("string"), F.lit(f"/{c}"))).cast("string")
        cell = F.when(F.col(f"`{c}`.n") > 1, several).otherwise(F.col(f"`{c}`.v"))
        if name in zero_names:
            cell = F.coalesce(cell, F.lit("0"))
        if any(c.lower().startswith(p.lower()) for p in numeric_prefixes):
            cell = to_number(cell)
        out.append(cell.alias(c))
    return joined.select(*ids, *out)


def union_facts(frames: list[DataFrame]) -> DataFrame:
    """Stack fact frames by column name; absent columns become missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
