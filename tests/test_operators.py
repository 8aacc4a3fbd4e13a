import pytest
from pyspark.sql import functions as F

from tallyfold.functions.logic import in_list
from tallyfold.operators.legacy import any_present, distinct_non_null, legacy_wide_to_long
from tallyfold.operators.matrix import dense_count_matrix, spine
from tallyfold.operators.merge import drop_placeholders, indicator_fanout, lookup_to_long
from tallyfold.operators.quality import (assert_members, classify, exclude_rows, split_valid,
                                         unknown_members)
from tallyfold.operators.review import accepted_codes, rejected_rows, undecided

from conftest import rows


def test_classify_sequential_q12(spark):
    df = spark.createDataFrame([("COORD", "UNIT", "R"), ("STAFF", "UNIT", "R"), (None, "X", None)],
                               "position string, resp string, rec string")
    out = classify(df, [((F.col("rec") == "R") & (F.col("resp") == "DAT"), "A"),
                        (in_list("resp", ["UNIT"]), "B")], "cat",
                   rewrites=[("resp", F.when(F.col("position") == "COORD", "DAT")
                              .otherwise(F.col("resp")))])
    assert rows(out, "position", "cat") == [(None, None), ("COORD", "A"), ("STAFF", "B")]
    ok, bad = split_valid(out, "cat")
    assert ok.count() + bad.count() == out.count() and bad.count() == 1


def test_members_and_exclusions(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, "Z")], "n long, d string")
    ref = spark.createDataFrame([("A",), ("B",)], "d string")
    assert rows(unknown_members(df, "d", ref)) == [("Z",)]
    from tallyfold.operators.quality import membership
    assert rows(membership(df, "d", ref)) == [("A", True), ("B", True), ("Z", False)]
    with pytest.raises(ValueError, match="Z"):
        assert_members(df, "d", ref)
    assert_members(df.where("d != 'Z'"), "d", ref)
    excl = spark.createDataFrame([(2,)], "n long")
    assert rows(exclude_rows(df, excl, "n"), "n") == [(1,), (3,)]


def test_spine_and_dense_counts_q15_q16(spark):
    ents = spark.createDataFrame([("E1",), ("E2",), ("E1",)], "e string")
    sp = spine(ents, [("m", ["122022", "012023"]), ("k", ["a", "b"])])
    assert sp.count() == 8
    facts = spark.createDataFrame([("E1", "a_122022"), ("E1", "a_122022"), ("E2", "b_012023"),
                                   ("E1", "a_022023"), ("E9", "a_122022")], "e string, name string")
    names = ["a_122022", "b_122022", "a_012023", "b_012023"]
    m = dense_count_matrix(facts, ents, "e", "name", names)
    assert m.columns == ["e"] + names
    assert rows(m) == [("E1", 2, 0, 0, 0), ("E2", 0, 0, 0, 1)]


def test_decisions_q4(spark):
    dec = spark.createDataFrame([(1, "010101", "OK"), (2, "010102", "NO"), (3, "010103", "150101"),
                                 (4, "010104", None), (1, "010101", "OK")],
                                "n_row long, ubigeo string, decision string")
    assert rows(accepted_codes(dec)) == [("010101", 1), ("150101", 3)]
    data = spark.createDataFrame([(1,), (2,), (3,), (4,)], "n_row long")
    assert rows(rejected_rows(data, dec)) == [(2,)]
    assert rows(undecided(dec), "n_row") == [(4,)]


def test_lookup_q9_and_fanout(spark):
    att = spark.createDataFrame([("01", "MAYO"), ("02", "ENERO")], "u string, mes string")
    cuna = lookup_to_long(att, "u", "mes", {"MAYO": "05"}, "2022", "AT_PPSS", "-", "CUNA MAS")
    assert rows(cuna, "ubigeo", "fecha") == [("01", "052022"), ("02", None)]
    loc = spark.createDataFrame([("01", "AT_GL", "082022", "V", "DAT"), ("01", "AT_PPSS", "082022", "P", "JUNTOS")],
                                "ubigeo string, name string, fecha string, modal string, value string")
    fan = indicator_fanout(loc, role_if=F.col("value") != "DAT")
    assert rows(fan, "name", "value") == [("AT_GL", "1"), ("AT_PPSS", "1"), ("CARGO_PPSS", "JUNTOS"),
                                          ("MODALIDAD", "P"), ("MODALIDAD", "V")]


def test_drop_placeholders_q2(spark):
    df = spark.createDataFrame(
        [("u1", "1", "-"), ("u1", "1", "-"), ("u2", "1", "-"), ("u3", "1", "-"), ("u3", "1", "Virtual"),
         ("u4", "-", "Presencial"), ("u4", "CUNA", "-")],
        "ubigeo string, value string, modal string").withColumn("name", F.lit("N")).withColumn("fecha", F.lit("m"))
    got = rows(drop_placeholders(df, ["ubigeo", "name", "fecha"]), "ubigeo", "value")
    assert got == [("u2", "1"), ("u3", "1"), ("u4", "CUNA")]
    repaired = rows(drop_placeholders(df, ["ubigeo", "name", "fecha"], keep_one_if_all_placeholder=True),
                    "ubigeo", "value")
    assert repaired == [("u1", "1"), ("u2", "1"), ("u3", "1"), ("u4", "CUNA")]


def test_legacy_q7(spark):
    master = spark.createDataFrame([("d1",), ("d2",), ("d4",)], "ubigeo string")
    wide = spark.createDataFrame(
        [("d1", "1", "1"), ("d1", "2", None), ("d1", None, "1"),
         ("d2", None, None), ("d5", "1", "1")],
        "ubigeo string, mode_june string, mode_july string")
    out = legacy_wide_to_long(master, wide, "ubigeo", [("062022", "mode_june"), ("072022", "mode_july")],
                              "AT_PPSS", "-", "Presencial", "Virtual")
    assert rows(out, "ubigeo", "fecha", "modal") == [
        ("d1", "062022", "Presencial"), ("d1", "062022", "Virtual"),
        ("d1", "072022", "Presencial"), ("d1", "072022", "Presencial")]
    bad = spark.createDataFrame([("d1", "1", "1"), ("d1", "2", "2"), ("d1", None, "3")],
                                "ubigeo string, mode_june string, mode_july string")
    with pytest.raises(Exception, match="incompatible"):
        legacy_wide_to_long(master, bad, "ubigeo", [("062022", "mode_june"), ("072022", "mode_july")],
                            "AT_PPSS", "-", "Presencial", "Virtual").collect()


def test_distinct_non_null_and_presence(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("b", None)], "k string, v string")
    assert rows(distinct_non_null(df, "k", "v")) == [("a", "x"), ("a", "y"), ("b", None)]
    assert rows(any_present(df, "k", ["v"])) == [("a", 1.0), ("b", 0.0)]


def test_indicator_matrix_ignores_conflicts_outside_spine(spark):
    from tallyfold.operators.merge import dense_indicator_matrix
    ents = spark.createDataFrame([("01", "D")], "ubigeo string, department string")
    facts = spark.createDataFrame(
        [("01", "AT_GL", "052022", "1"),
         ("01", "MODALIDAD", "122022", "A"), ("01", "MODALIDAD", "122022", "B"),   # month not listed
         ("99", "MODALIDAD", "052022", "A"), ("99", "MODALIDAD", "052022", "B")],  # place not listed
        "ubigeo string, name string, fecha string, value string")
    m = dense_indicator_matrix(ents, facts, "ubigeo", ["052022"], ["AT_GL", "MODALIDAD"],
                               ["AT_GL"], ["AT_GL"])
    assert rows(m) == [("01", "D", 1.0, None)]
    bad = facts.union(spark.createDataFrame([("01", "AT_GL", "052022", "2")], facts.schema))
    with pytest.raises(Exception, match="several values"):
        dense_indicator_matrix(ents, bad, "ubigeo", ["052022"], ["AT_GL", "MODALIDAD"],
                               ["AT_GL"], ["AT_GL"]).collect()
