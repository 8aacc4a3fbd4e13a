"""Stand-in inputs built from the driver tables.

The workflow's inputs (form submissions, official place list, reviewer
decisions, attendance list, legacy matrix) do not exist as files here, so
each is derived from the TPC-H-like tables by content rules:

* submissions  = orders ⋈ customer ⋈ nation ⋈ region
  (stamp = order date, tie-break = order key, department = region,
  province = nation, district = market segment, responsible = priority,
  position / mode = order status, recipient = segment); a negative balance
  leaves the department missing, a balance under 100 types district "NA";
* official places (matrices) = nation ⋈ region, code = 2-digit nation key;
* exclusions   = submissions whose order total is above 490,000;
* decisions    = one per local submission (two for urgent ones), the
  verdict taken from the customer's balance band;
* attendance   = suppliers, month name from the balance band;
* legacy matrix = customers, presence and mode columns from segment,
  balance and the nation's region (a second one with two June modes per
  nation exercises the recycling rule);
* matcher gazetteer = distinct (type, brand, name) of parts, code = first
  part key; matcher records = every part with its texts mistyped by rules
  on its size.

Every builder reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.logic import in_list
from tallyfold.operators.rows import number_rows
from tallyfold.plans import jobs
from tallyfold.plans.rules import STANDIN
from tallyfold.sources.io import driver_table


def _t(spark, sf, name):
    return driver_table(spark, sf, name)


def code2(col) -> F.Column:
    """A key as text of at least two digits; longer keys stay whole."""
    return F.format_string("%02d", F.col(col))


EXCLUDED_ABOVE = 490000
REVIEWED = ("c_acctbal", "c_nationkey", "n_regionkey")


def raw_submissions(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n, r = (_t(spark, sf, x) for x in ("orders", "customer", "nation", "region"))
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, c.c_nationkey == n.n_nationkey)
          .join(r, n.n_regionkey == r.r_regionkey))
    return j.select(
        F.col("o_orderkey").alias("submission_id"),
        F.col("o_orderdate").alias("submitted_at"),
        F.when(F.col("c_acctbal") >= 0, F.col("r_name")).alias("department"),
        F.col("n_name").alias("province"),
        F.when((F.col("c_acctbal") >= 0) & (F.col("c_acctbal") < 100), F.lit("NA"))
         .otherwise(F.col("c_mktsegment")).alias("district"),
        F.col("o_orderdate").alias("event_date"),
        F.col("o_orderpriority").alias("responsible"),
        F.col("o_orderstatus").alias("mode"),
        F.col("o_orderstatus").alias("position"),
        F.col("o_orderpriority").alias("intervention"),
        F.col("c_mktsegment").alias("recipient"),
        # what the stand-ins of the exclusion list and of the reviewer go by
        (F.col("o_totalprice") > EXCLUDED_ABOVE).alias("excluded"),
        *REVIEWED)


def official_places(spark: SparkSession, sf: str) -> DataFrame:
    """Official place list for the matrices: one row per nation."""
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    old, new = STANDIN.department_rewrite
    dep = F.when(F.col("r_name") == old, F.lit(new)).otherwise(F.col("r_name"))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        code2("n_nationkey").alias("ubigeo"), dep.alias("department"),
        F.col("n_name").alias("province"), F.col("n_name").alias("district"))


def region_names(spark: SparkSession, sf: str) -> DataFrame:
    """A list of departments as the regions are called, before any rewrite."""
    return _t(spark, sf, "region").select(F.col("r_name").alias("department"))


def row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """n_row of every submission: only the sort key and the id are numbered."""
    stamps = raw_submissions(spark, sf).select("submission_id", "submitted_at")
    return number_rows(stamps, "submitted_at", "submission_id").select("submission_id", "n_row")


def numbered_submissions(spark: SparkSession, sf: str) -> DataFrame:
    return number_rows(raw_submissions(spark, sf), "submitted_at", "submission_id")


def excluded_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The submissions on the exclusion list."""
    return _t(spark, sf, "orders").where(F.col("o_totalprice") > EXCLUDED_ABOVE).select(
        F.col("o_orderkey").alias("submission_id"))


def exclusions(spark: SparkSession, sf: str, numbers: DataFrame | None = None) -> DataFrame:
    """Row numbers to drop (column ``n_row``)."""
    numbers = numbers if numbers is not None else row_numbers(spark, sf)
    return numbers.join(excluded_ids(spark, sf), "submission_id").select("n_row")


def clean_submissions(spark: SparkSession, sf: str, numbered: bool = True,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """X1 on the stand-in submissions, exclusions removed.

    The rows know whether they are on the exclusion list, so the numbered table is
    read once.  With ``numbered=False`` the rows have no number: rows that are only
    counted need none.  ``keep`` names further columns to carry.
    """
    rows = numbered_submissions(spark, sf) if numbered else raw_submissions(spark, sf)
    return jobs.clean_submissions(rows.where(~F.coalesce("excluded", F.lit(False))), STANDIN, keep)


def classified_submissions(spark: SparkSession, sf: str, numbered: bool = True,
                           keep: tuple[str, ...] = ()) -> DataFrame:
    return jobs.classified_submissions(clean_submissions(spark, sf, numbered, keep), STANDIN)


def decisions(spark: SparkSession, sf: str, tidy: DataFrame) -> DataFrame:
    """Reviewer decisions (n_row, ubigeo, decision) for the local rows.

    Taken from the columns ``REVIEWED`` where the rows carry them, else from the
    tables by submission id.
    """
    src = jobs.local_submissions(tidy, STANDIN)
    if not set(REVIEWED) <= set(tidy.columns):
        src = src.select("n_row", "submission_id", "intervention").join(
            raw_submissions(spark, sf).select("submission_id", *REVIEWED), "submission_id")
    bal = F.col("c_acctbal")
    verdict = (F.when(bal < 1000, F.lit("NO"))
                .when(bal < 2000, F.lit(None).cast("string"))
                .when(bal < 3000, code2("n_regionkey"))
                .otherwise(F.lit("OK")))
    cands = F.when(F.col("intervention") == "1-URGENT",
                   F.array(code2("c_nationkey"), code2("n_regionkey"))
                   ).otherwise(F.array(code2("c_nationkey")))
    return src.select("n_row", F.explode(cands).alias("ubigeo"), verdict.alias("decision"))


def attendance(spark: SparkSession, sf: str) -> DataFrame:
    s = _t(spark, sf, "supplier")
    bal = F.col("s_acctbal")
    month = (F.when(bal < 0, "MAYO").when(bal < 3000, "JUNIO").when(bal < 6000, "JULIO")
              .when(bal < 9000, "AGOSTO").otherwise("SETIEMBRE"))
    return s.select(code2("s_nationkey").alias("ubigeo"), month.alias("month_name"))


def legacy_wide(spark: SparkSession, sf: str) -> DataFrame:
    c, n = _t(spark, sf, "customer"), _t(spark, sf, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    bal, seg, reg = F.col("c_acctbal"), F.col("c_mktsegment"), F.col("n_regionkey")
    return j.select(
        code2("c_nationkey").alias("ubigeo"),
        F.when(in_list(seg, ["BUILDING", "MACHINERY"]), F.lit("x")).alias("at_june"),
        F.when(bal < 0, F.lit(None)).when(in_list(reg, [0, 1]), F.lit("1"))
         .when(reg == 2, F.lit("2")).cast("string").alias("mode_june"),
        F.when(bal > 5000, F.lit("y")).alias("ial_june"),
        F.when(in_list(seg, ["AUTOMOBILE", "HOUSEHOLD"]), F.lit("x")).alias("at_july"),
        F.when(bal < 0, F.lit(None)).when(in_list(reg, [1, 3]), F.lit("2"))
         .when(reg == 4, F.lit("1")).cast("string").alias("mode_july"),
        F.when(bal > 2500, F.lit("y")).alias("ial_july"))


def legacy_wide_multi(spark: SparkSession, sf: str) -> DataFrame:
    """A legacy matrix with several June modes per nation and at most one July
    mode, so July's single mode is repeated to the nation's row count (Q7)."""
    c, n = _t(spark, sf, "customer"), _t(spark, sf, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    bal, seg, reg = F.col("c_acctbal"), F.col("c_mktsegment"), F.col("n_regionkey")
    return j.select(
        code2("c_nationkey").alias("ubigeo"),
        F.when(bal < 0, F.lit(None).cast("string"))
         .when(in_list(seg, ["BUILDING", "MACHINERY"]), F.lit("1")).otherwise(F.lit("2"))
         .alias("mode_june"),
        F.when(bal < 0, F.lit(None)).when(in_list(reg, [1, 3]), F.lit("2"))
         .when(reg == 4, F.lit("1")).cast("string").alias("mode_july"))


def part_gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    p = _t(spark, sf, "part")
    g = p.groupBy("p_type", "p_brand", "p_name").agg(F.min("p_partkey").alias("k"))
    return g.select(F.format_string("%04d", "k").alias("ubigeo"),
                    F.col("p_type").alias("department"), F.col("p_brand").alias("province"),
                    F.col("p_name").alias("district"))


def part_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every part, its three texts mistyped by rules on its size."""
    p = _t(spark, sf, "part")
    size, t, b, nm = F.col("p_size"), F.col("p_type"), F.col("p_brand"), F.col("p_name")
    dep = (F.when(size <= 12, F.concat(F.substring(t, 1, 1), F.expr("substring(p_type, 3)")))
            .when(size <= 25, F.lower(t)).otherwise(t))
    prov = (F.when(size > 47, F.lit(None).cast("string"))
             .when((size >= 20) & (size <= 30), F.regexp_replace(b, "#", " "))
             .otherwise(b))
    dist = (F.when(size <= 10, F.expr("substring(p_name, 1, length(p_name) - 1)"))
             .when(size <= 20, F.regexp_replace(nm, " ", ""))
             .when(size <= 35, F.expr("substring(p_name, 2)"))
             .otherwise(nm))
    return p.select(F.col("p_partkey").alias("n_row"), dep.alias("department"),
                    prov.alias("province"), dist.alias("district"))
