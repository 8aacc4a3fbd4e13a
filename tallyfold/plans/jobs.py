"""The workflow's steps, composed from the operators.

* regional: submissions → clean → classify → quarantine / check → dense
  class-by-month count matrix per department;
* matcher: local submissions → staged fuzzy join → candidates for review;
* local: reviewer decisions + attendance list + legacy rows → merged facts
  → dense indicator matrix per official place.

Each function takes DataFrames and a rule set and returns a DataFrame, so
the same code runs on real exports (``rules.FIELD``) and on the stand-in
tables (``rules.STANDIN``, the default).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.dates import month_bounds, month_key, month_key_to_date, to_day
from tallyfold.functions.logic import if_else, in_list, matches
from tallyfold.functions.text import fold_text
from tallyfold.operators.fuzzy import fuzzy_cascade, relabel_by_prefix
from tallyfold.operators.legacy import legacy_wide_to_long
from tallyfold.operators.matrix import dense_count_matrix, spine
from tallyfold.operators.merge import (dense_indicator_matrix, drop_placeholders,
                                       indicator_fanout, lookup_to_long, union_facts)
from tallyfold.operators.quality import classify
from tallyfold.operators.review import accepted_codes
from tallyfold.operators.rows import attach_joined_distinct
from tallyfold.plans.rules import STANDIN, Rules


# cleaning and classification ---------------------------------------------------
def clean_submissions(numbered: DataFrame, rules: Rules = STANDIN,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Fold texts, day of the event; keep rows with a department whose
    intervention matches the pattern.  Expects not-excluded rows, numbered
    unless they are only counted; ``keep`` carries further columns."""
    out = numbered.select(
        *[c for c in ("n_row",) if c in numbered.columns], "submission_id",
        fold_text("department").alias("department"),
        fold_text("province").alias("province"),
        fold_text("district").alias("district"),
        to_day("event_date").alias("event_date"),
        fold_text("responsible").alias("responsible"),
        F.col("mode"),
        fold_text("position").alias("position"),
        F.col("intervention"),
        F.col("recipient"), *keep)
    return out.where(F.col("department").isNotNull()
                     & matches("intervention", rules.intervention_pattern))


def classification_rewrites(rules: Rules = STANDIN) -> list[tuple[str, Column]]:
    old, new = rules.department_rewrite
    return [
        ("department", F.when(F.col("department") == old, F.lit(new))
                        .otherwise(F.col("department"))),
        ("responsible", F.when(in_list("position", rules.coordinator_positions),
                               F.lit(rules.coordination)).otherwise(F.col("responsible"))),
    ]


def classification_rules(rules: Rules = STANDIN) -> list[tuple[Column, str]]:
    out = []
    for r in rules.class_rules:
        unit = (F.col("responsible") == rules.coordination if r.units is None
                else in_list("responsible", r.units))
        out.append((in_list("recipient", r.recipients) & unit, r.label))
    return out


def classified_submissions(clean: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    """Rewrites in order, then the ordered class rules; drops ``position``."""
    return classify(clean, classification_rules(rules), "category",
                    rewrites=classification_rewrites(rules)).drop("position")


def local_submissions(tidy: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    """Rows sent to the place matcher / reviewer."""
    return tidy.where((F.col("event_date") >= F.lit(rules.local_start))
                      & F.col("district").isNotNull()
                      & (F.col("district") != rules.sentinel_missing)
                      & in_list("category", rules.local_classes))


def match_candidates(tidy: DataFrame, places: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    """Candidates for review: local rows against the official list."""
    local = local_submissions(tidy, rules).select("n_row", "department", "province", "district")
    gaz = relabel_by_prefix(places, "ubigeo", rules.special_prefix, "department",
                            rules.special_label)
    return fuzzy_cascade(local, gaz, caps=rules.match_caps)


# regional ------------------------------------------------------------------
def regional_names(rules: Rules = STANDIN) -> list[str]:
    return [f"{c}_{m}" for m in rules.months for c in rules.regional_classes]


def regional_facts(tidy: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    """(department, class_MMYYYY) for classified rows inside the month list."""
    _, hi = month_bounds(list(rules.months))
    d = F.col("event_date")
    # lower bound parsed from the first key (as the reference does); the upper
    # bound is added so scans can prune (same result: later months have no column)
    lo = month_key_to_date(F.lit(rules.months[0]))
    return tidy.where((d >= lo) & (d < F.lit(hi))
                      & in_list("category", rules.regional_classes)).select(
        "department", F.concat_ws("_", "category", month_key(d)).alias("name"))


def month_counts(tidy: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    return regional_facts(tidy, rules).groupBy("department", "name").agg(
        F.count(F.lit(1)).alias("n"))


def regional_spine(places: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    return spine(places.select("department"), [("name", regional_names(rules))])


def regional_matrix(tidy: DataFrame, places: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    return dense_count_matrix(regional_facts(tidy, rules), places.select("department"),
                              "department", "name", regional_names(rules))


# local -----------------------------------------------------------------------
def _accepted_with_rows(tidy: DataFrame, decisions: DataFrame, rules: Rules) -> DataFrame:
    """Accepted (code, row) pairs with the row's class, month, type, mode and unit."""
    acc = accepted_codes(decisions)
    ce, ppss = rules.type_labels
    right = tidy.where(F.col("event_date") >= F.lit(rules.local_start)).select(
        "n_row", F.col("category").alias("name"), month_key("event_date").alias("fecha"),
        if_else(F.col("responsible") == rules.coordination, ce, ppss).alias("type"),
        F.col("mode").alias("modal"), F.col("responsible").alias("value"))
    return acc.join(right, "n_row", "left")


def enriched_local(tidy: DataFrame, decisions: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    """Every accepted row with its place-month's joined distinct mode text."""
    return attach_joined_distinct(_accepted_with_rows(tidy, decisions, rules),
                                  ["ubigeo", "fecha"], "modal", "modal", rules.mode_separator)


def at_local(tidy: DataFrame, decisions: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    """First accepted row per (place, class, type, month) with the mode text.

    One aggregate per (place, month, class, type) group keeps the first
    row's unit and the group's distinct modes; the place-month mode text is
    then a window over those group rows (a few per place-month), so no pass
    goes back to the submission rows.  A row number is unique within a
    place, so the first row of a group is unique too.
    """
    rows = _accepted_with_rows(tidy, decisions, rules)
    groups = rows.groupBy("ubigeo", "fecha", "name", "type").agg(
        F.min(F.struct("n_row", "value")).alias("_first"),
        F.collect_set("modal").alias("_modes"))
    per_month = Window.partitionBy("ubigeo", "fecha")
    text = F.concat_ws(rules.mode_separator, F.array_sort(F.array_distinct(
        F.flatten(F.collect_list("_modes").over(per_month)))))
    return groups.select("ubigeo", "name", "fecha", text.alias("modal"),
                         F.col("_first.value").alias("value"))


def attendance_long(att: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    return lookup_to_long(att, "ubigeo", "month_name", rules.month_numbers, rules.year,
                          rules.presence_class, rules.placeholder, rules.attendance_label)


def legacy_long(places: DataFrame, wide: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    return legacy_wide_to_long(places, wide, "ubigeo", list(rules.legacy_months),
                               rules.presence_class, rules.placeholder,
                               rules.mode_yes, rules.mode_no)


def fanned_facts(local: DataFrame, attendance: DataFrame, legacy: DataFrame,
                 rules: Rules = STANDIN) -> DataFrame:
    kw = dict(presence_value=rules.presence_value, role_name=rules.role_name,
              mode_name=rules.mode_name)
    return union_facts([
        indicator_fanout(local, role_if=F.col("value") != rules.coordination, **kw),
        indicator_fanout(attendance, **kw),
        indicator_fanout(legacy, **kw),
    ])


def merged_facts(fanned: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    return drop_placeholders(fanned, ["ubigeo", "name", "fecha"], token=rules.placeholder)


def local_matrix(places: DataFrame, facts: DataFrame, rules: Rules = STANDIN) -> DataFrame:
    return dense_indicator_matrix(places, facts, "ubigeo", list(rules.months),
                                  list(rules.local_names), list(rules.zero_filled),
                                  list(rules.numeric_prefixes))
