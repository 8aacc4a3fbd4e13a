"""Declared schemas (no inference at read time).

Codes are text everywhere: Spark would otherwise compare '010101' = 10101
through an implicit cast.
"""

from pyspark.sql import types as T

S, L, D, DT, TS, I = (T.StringType(), T.LongType(), T.DoubleType(), T.DateType(),
                      T.TimestampNTZType(), T.IntegerType())


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Domain inputs -------------------------------------------------------------
SUBMISSIONS = struct(
    ("submission_id", S), ("submitted_at", TS), ("department", S), ("province", S),
    ("district", S), ("event_date", TS), ("responsible", S), ("mode", S),
    ("position", S), ("intervention", S), ("recipient", S))

GAZETTEER = struct(("ubigeo", S), ("department", S), ("province", S), ("district", S))

ATTENDANCE = struct(("ubigeo", S), ("month_name", S))

LEGACY_WIDE = struct(
    ("ubigeo", S), ("at_june", S), ("mode_june", S), ("ial_june", S),
    ("at_july", S), ("mode_july", S), ("ial_july", S))

DECISIONS = struct(("n_row", L), ("ubigeo", S), ("decision", S))

EXCLUSIONS = struct(("n_row", L),)

# Driver tables (TPC-H-like) ------------------------------------------------
TABLES = {
    "region": struct(("r_regionkey", I), ("r_name", S)),
    "nation": struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": struct(("c_custkey", L), ("c_name", S), ("c_nationkey", I),
                       ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": struct(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": struct(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
                   ("p_size", I), ("p_retailprice", D)),
    "orders": struct(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                     ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": struct(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L),
                       ("l_linenumber", I), ("l_quantity", D), ("l_extendedprice", D),
                       ("l_discount", D), ("l_tax", D), ("l_returnflag", S),
                       ("l_linestatus", S), ("l_shipdate", TS)),
    "documents": struct(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
}
