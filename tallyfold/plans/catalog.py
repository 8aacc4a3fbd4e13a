"""Registered queries: one per operator group, each over whole driver tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``oracle.SQL[name]``
is an independent DuckDB statement expected to give the same rows.
Dates leave as ``yyyy-MM-dd`` text and distances are rounded to 6 places
so both engines render values alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.jaro import jaro_distance
from tallyfold.functions.text import fold_text
from tallyfold.operators import fuzzy, legacy, quality, review
from tallyfold.plans import jobs, standins as S
from tallyfold.plans.rules import STANDIN
from tallyfold.session import scratch_path
from tallyfold.operators.rows import group_size, keep_first
from tallyfold.sources.io import (driver_table, hand_over, literal_table, rename_at, rename_tail,
                                  split_readable)


def _day(df: DataFrame, col: str = "event_date") -> DataFrame:
    return df.withColumn(col, F.date_format(col, "yyyy-MM-dd"))


def _tidy(spark, sf, numbered=True, keep=()):
    return quality.split_valid(S.classified_submissions(spark, sf, numbered, keep), "category")[0]


def q_scan_declared(spark, sf):
    o = driver_table(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day"),
                    "o_orderpriority")


EXPORT_HEADERS = {"o_orderkey": "Order key", "o_custkey": "Customer", "o_orderstatus": "Status",
                  "o_totalprice": "Total, gross", "order_day": "Day", "o_orderpriority": "Priority"}


def q_banner_csv(spark, sf):
    """A sheet export with a banner line above its own headers (S2), as the jobs
    read theirs: missing, quoted and multi-line cells, and records cut short,
    which come back as rejected with what could be read of them."""
    o = driver_table(spark, sf, "orders")
    priority = (F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
                 .when(F.col("o_orderpriority") == "1-URGENT", F.lit('1-URGENT, "now"'))
                 .when(F.col("o_orderpriority") == "5-LOW", F.lit("5-LOW\nany time"))
                 .otherwise(F.col("o_orderpriority")))
    cells = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_totalprice"),
             F.date_format("o_orderdate", "yyyy-MM-dd"), priority]
    style = {"escape": '"'}
    whole = F.to_csv(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cells)]), style)
    short = F.to_csv(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cells[:3])]), style)
    body = o.select(F.when(F.col("o_orderstatus") == "P", short).otherwise(whole).alias("value"))
    header = ",".join(f'"{h}"' for h in EXPORT_HEADERS.values())
    top = spark.createDataFrame([(f"ORDERS EXPORT\n{header}",)], "value string")
    path = scratch_path(spark, "sheet") + ".csv"
    top.unionByName(body).write.text(path)
    schema = T.StructType([T.StructField(c, t) for c, t in zip(EXPORT_HEADERS, [
        T.LongType(), T.LongType(), T.StringType(), T.DoubleType(), T.StringType(), T.StringType()])])
    good, rejected = split_readable(spark, path, schema, EXPORT_HEADERS)
    key = F.split("record", ",")[0].cast("long").alias("o_orderkey")
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejected.select(key, "reason"), allowMissingColumns=True)


DATED_PATTERNS = {"stamp": ("d/M/yyyy H:mm:ss", "d/M/yyyy H:mm"), "day": ("d/M/yyyy", "M/d/yyyy", "dd.MM.yyyy")}


def q_dated_export(spark, sf):
    """An export whose stamps and days are written in several ways (S1, C2, C3):
    day-first and ISO stamps, days that are day-first or month-first, so that some
    are ambiguous, and stamps of no calendar day; read by declared patterns."""
    o = driver_table(spark, sf, "orders")
    at, status, priority = F.col("o_orderdate"), F.col("o_orderstatus"), F.col("o_orderpriority")
    stamp = (F.when(status == "P", F.concat(F.lit("31/2/"), F.date_format(at, "yyyy H:mm:ss")))
              .when(status == "O", F.date_format(at, "d/M/yyyy H:mm:ss"))
              .when(priority == "5-LOW", F.date_format(at, "dd/MM/yyyy HH:mm"))
              .otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")))
    day = (F.when(priority == "1-URGENT", F.date_format(at, "M/d/yyyy"))
            .when(priority == "2-HIGH", F.date_format(at, "dd.MM.yyyy"))
            .when(priority == "3-MEDIUM", F.lit(None))
            .otherwise(F.date_format(at, "d/M/yyyy")))
    path = scratch_path(spark, "dated") + ".csv"
    o.select("o_orderkey", stamp.alias("stamp"), day.alias("day")).write.option("header", "true").csv(path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("stamp", T.TimestampNTZType()),
                           T.StructField("day", T.DateType())])
    good, rejected = split_readable(spark, path, schema, patterns=DATED_PATTERNS)
    shown = good.select("o_orderkey", F.date_format("stamp", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
                        F.date_format("day", "yyyy-MM-dd").alias("day"), F.lit(None).cast("string").alias("reason"))
    key = F.get_json_object("record", "$.o_orderkey").cast("long").alias("o_orderkey")
    return shown.unionByName(rejected.select(key, "reason"), allowMissingColumns=True)


def q_positional_rename(spark, sf):
    p = rename_tail(driver_table(spark, sf, "part"),
                    ["name", "brand", "kind", "size", "price"])
    return rename_at(p, 1, "part_id")


def q_fold_text(spark, sf):
    d = driver_table(spark, sf, "documents")
    return d.select("doc_id", fold_text("text").alias("folded"))


def q_row_number(spark, sf):
    return S.row_numbers(spark, sf)


def q_exclude_rows(spark, sf):
    numbers = S.row_numbers(spark, sf)
    return quality.exclude_rows(numbers, S.exclusions(spark, sf, numbers), "n_row")


def q_clean(spark, sf):
    return _day(S.clean_submissions(spark, sf))


def q_classify(spark, sf):
    return _day(S.classified_submissions(spark, sf))


def q_quarantine(spark, sf):
    return _day(quality.split_valid(S.classified_submissions(spark, sf), "category")[1])


def q_unknown_members(spark, sf):
    """Departments of the classified rows that the list of regions, which knows
    no rewritten name, doesn't have."""
    return quality.unknown_members(_tidy(spark, sf, False), "department", S.region_names(spark, sf))


def q_member_check(spark, sf):
    """Every department of the classified rows, flagged as in that list or not."""
    return quality.membership(_tidy(spark, sf, False), "department", S.region_names(spark, sf))


def q_month_counts(spark, sf):
    return jobs.month_counts(_tidy(spark, sf, False))


def q_spine(spark, sf):
    """Distinct departments of the official list × the 21 class-month names."""
    return jobs.regional_spine(S.official_places(spark, sf))


def q_keep_first_ties(spark, sf):
    """The earliest rows of each department and class, all of the first day."""
    rows = _tidy(spark, sf, False).select("department", "category", "event_date", "submission_id")
    return _day(keep_first(rows, ["department", "category"], "event_date"))


def q_group_size(spark, sf):
    """Every classified row with the number of rows of its department and class."""
    rows = _tidy(spark, sf, False).select("submission_id", "department", "category")
    return group_size(rows, ["department", "category"])


def q_literal_table(spark, sf):
    """Months of a literal table against the attendance rows that name them."""
    months = literal_table(spark, sorted(STANDIN.month_numbers.items()), "month_name string, month string")
    found = S.attendance(spark, sf).groupBy("month_name").agg(F.count(F.lit(1)).alias("n"))
    return months.join(found, "month_name", "left")


def q_regional_matrix(spark, sf):
    return jobs.regional_matrix(_tidy(spark, sf, False), S.official_places(spark, sf))


def _tidy_written(spark, sf, keep=()):
    """Classified rows handed over as a written table, as between the jobs."""
    return hand_over(_tidy(spark, sf, keep=keep), scratch_path(spark, "tidy"))


def _decisions(spark, sf, written: bool = True):
    """Classified rows and the reviewer decisions on them; ``written`` hands
    the rows over as a table when the query reads them more than once."""
    tidy = _tidy_written(spark, sf, S.REVIEWED) if written else _tidy(spark, sf, keep=S.REVIEWED)
    return tidy.drop(*S.REVIEWED), S.decisions(spark, sf, tidy)


def q_distinct_text(spark, sf):
    tidy, dec = _decisions(spark, sf)
    return jobs.enriched_local(tidy, dec)


def q_keep_first(spark, sf):
    tidy, dec = _decisions(spark, sf)
    return jobs.at_local(tidy, dec)


def q_decisions_accept(spark, sf):
    return review.accepted_codes(_decisions(spark, sf, written=False)[1])


def q_decisions_reject(spark, sf):
    tidy, dec = _decisions(spark, sf)
    return _day(review.rejected_rows(tidy, dec))


def q_decisions_undecided(spark, sf):
    return review.undecided(_decisions(spark, sf, written=False)[1])


def q_lookup_to_long(spark, sf):
    return jobs.attendance_long(S.attendance(spark, sf))


def _fanned(spark, sf):
    tidy, dec = _decisions(spark, sf)
    places = S.official_places(spark, sf)
    return jobs.fanned_facts(jobs.at_local(tidy, dec),
                             jobs.attendance_long(S.attendance(spark, sf)),
                             jobs.legacy_long(places, S.legacy_wide(spark, sf)))


def q_fanout(spark, sf):
    return _fanned(spark, sf)


def q_drop_placeholders(spark, sf):
    return jobs.merged_facts(_fanned(spark, sf))


def q_indicator_matrix(spark, sf):
    m = jobs.local_matrix(S.official_places(spark, sf), jobs.merged_facts(_fanned(spark, sf)))
    return m.orderBy("ubigeo")  # sink order (O3)


def q_presence_max(spark, sf):
    return legacy.any_present(S.legacy_wide(spark, sf), "ubigeo",
                              ["at_june", "ial_june", "at_july", "ial_july"])


def q_distinct_non_null(spark, sf):
    c = driver_table(spark, sf, "customer")
    src = c.select(S.code2("c_nationkey").alias("ubigeo"),
                   F.when(F.col("c_acctbal") > 9500, F.col("c_mktsegment")).alias("segment"))
    return legacy.distinct_non_null(src, "ubigeo", "segment")


def q_legacy_long(spark, sf):
    return jobs.legacy_long(S.official_places(spark, sf), S.legacy_wide(spark, sf))


def q_legacy_multi_mode(spark, sf):
    return jobs.legacy_long(S.official_places(spark, sf), S.legacy_wide_multi(spark, sf))


def q_unpivot(spark, sf):
    pres = q_presence_max(spark, sf)
    return pres.unpivot(["ubigeo"], ["at_june", "ial_june", "at_july", "ial_july"],
                        "indicator", "flag")


def q_jaro(spark, sf):
    p = driver_table(spark, sf, "part")
    r = S.part_records(spark, sf)
    pairs = (p.join(r, p.p_partkey == r.n_row)
              .select(F.lower("p_name").alias("official"), F.lower("district").alias("typed"))
              .distinct())
    return pairs.withColumn("dist", F.round(jaro_distance("official", "typed"), 6))


def _round_dists(df):
    for c in ["dist_department", "dist_province", "dist_district", "dist"]:
        df = df.withColumn(c, F.round(c, 6))
    return df


def matcher_gazetteer(spark, sf):
    return fuzzy.relabel_by_prefix(S.part_gazetteer(spark, sf), "ubigeo", STANDIN.special_prefix,
                                   "department", STANDIN.special_label)


def q_fuzzy_cascade(spark, sf):
    out = fuzzy.fuzzy_cascade(S.part_records(spark, sf), matcher_gazetteer(spark, sf),
                              caps=STANDIN.match_caps)
    return _round_dists(out)


def q_candidates(spark, sf):
    """The regional job's matcher call: local submissions against the official list."""
    cands = jobs.match_candidates(_tidy_written(spark, sf), S.official_places(spark, sf))
    return _round_dists(cands).orderBy("n_row")  # review order at the sink (O2)


def q_fuzzy_no_candidate(spark, sf):
    return fuzzy.records_without_candidates(S.part_records(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
