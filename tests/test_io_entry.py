import csv
import io
import os
import random
import tempfile

import pytest
from pyspark.sql import types as T

import __spark_entry__ as E
from tallyfold.sources.io import hand_over, read_input, rename_at, rename_tail, split_readable
from tallyfold.sources.schemas import DECISIONS

from conftest import rows


SHEET = T.StructType([T.StructField(n, T.StringType()) for n in ["ubigeo", "department", "province"]])


def _put(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_banner_and_header_are_dropped_once_and_nothing_else(spark):
    d = tempfile.mkdtemp(prefix="tf-io-")
    p = _put(d, "sheet.csv", 'REPORTE DISTRITAL 2022\nubigeo,department,province\n010101,AMAZONAS,CHACHAPOYAS\n'
                             '150101,LIMA,"LIMA, CALLAO"\n020101,"AN\nCASH",\n030101,short\n040101,"a ""b""",c\n')
    good, rejected = split_readable(spark, p, SHEET)
    assert rows(good) == [("010101", "AMAZONAS", "CHACHAPOYAS"), ("020101", "AN\nCASH", None),
                          ("040101", 'a "b"', "c"), ("150101", "LIMA", "LIMA, CALLAO")]
    assert rows(rejected) == [("030101,short", "wrong number of fields")]
    assert rename_at(good, 3, "prov").columns == ["ubigeo", "department", "prov"]
    assert rename_tail(good, ["a", "b"]).columns == ["ubigeo", "a", "b"]
    assert rows(hand_over(good, os.path.join(d, "handover"))) == rows(good)


def test_a_second_part_file_without_banner_keeps_its_first_row(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="tf-io-"), "sheet.csv")
    os.makedirs(d)
    _put(d, "part-0.csv", "BANNER\nubigeo,department,province\n01,A,B\n")
    _put(d, "part-1.csv", "02,C,D\n03,E,F\n")
    good, rejected = split_readable(spark, d, SHEET)
    assert [r[0] for r in rows(good)] == ["01", "02", "03"] and rejected.count() == 0


def test_formats_agree_and_unreadable_cells_are_rejected(spark):
    d = tempfile.mkdtemp(prefix="tf-io-")
    csv = _put(d, "dec.csv", "RESULTADO,N_ROW,UBIGEO\nOK,7,010101\nNO,x8,150101\n,9,1\n")
    lines = ['{"RESULTADO": "OK", "N_ROW": 7, "UBIGEO": "010101"}', '{"RESULTADO": "NO", "N_ROW": "x8", "UBIGEO": "150101"}',
             '{"N_ROW": 9, "UBIGEO": "1"}']
    json_file = _put(d, "dec.json", "\n".join(lines) + "\n")
    pq = os.path.join(d, "dec.parquet")
    spark.createDataFrame([("OK", "7", "010101"), ("NO", "x8", "150101"), (None, "9", "1")],
                          "RESULTADO string, N_ROW string, UBIGEO string").write.parquet(pq)
    names = {"n_row": "N_ROW", "ubigeo": "UBIGEO", "decision": "RESULTADO"}
    for path in (csv, json_file, pq):
        good, rejected = split_readable(spark, path, DECISIONS, names)
        assert rows(good) == [(7, "010101", "OK"), (9, "1", None)], path
        assert [r["reason"] for r in rejected.collect()] == ["unreadable n_row"], path
        with pytest.raises(ValueError, match="unreadable n_row"):
            read_input(spark, path, DECISIONS, names)
        assert read_input(spark, path, DECISIONS, names, rejects=path + ".rejects").count() == 2
        with pytest.raises(ValueError, match="decision"):
            split_readable(spark, path, DECISIONS, names | {"decision": "VERDICT"})


def test_entry_contract(spark):
    out = E.entry(spark)
    assert out.count() > 0 and out.columns[0] == "department"
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 28


def test_read_input_matches_columns_by_name(spark):
    from tallyfold.sources.io import read_input
    from tallyfold.sources.schemas import DECISIONS
    d = tempfile.mkdtemp(prefix="tf-in-")
    p = os.path.join(d, "dec.csv")
    with open(p, "w") as f:
        f.write("decision,extra,ubigeo,n_row\nOK,z,010101,7\nNO,z,150101,8\n")
    df = read_input(spark, p, DECISIONS)
    assert df.columns == ["n_row", "ubigeo", "decision"]
    assert rows(df) == [(7, "010101", "OK"), (8, "150101", "NO")]
    with open(os.path.join(d, "bad.csv"), "w") as f:
        f.write("n_row,decision\n1,OK\n")
    import pytest
    with pytest.raises(ValueError, match="ubigeo"):
        read_input(spark, os.path.join(d, "bad.csv"), DECISIONS)


def test_json_is_read_without_inference_and_absent_columns_are_noticed(spark):
    d = tempfile.mkdtemp(prefix="tf-json-")
    lines = ['{"N_ROW": %d, "UBIGEO": "0%d"}' % (i, i) for i in range(150)]
    late = _put(d, "late.json", "\n".join([*lines, '{"N_ROW": 150, "UBIGEO": "1", "RESULTADO": "OK"}', "no record"]) + "\n")
    names = {"n_row": "N_ROW", "ubigeo": "UBIGEO", "decision": "RESULTADO"}
    good, rejected = split_readable(spark, late, DECISIONS, names)
    assert good.count() == 151 and good.where("decision = 'OK'").count() == 1
    assert rows(rejected) == [("no record", "not a record")]
    never = _put(d, "never.json", "\n".join(lines) + "\n")
    with pytest.raises(ValueError, match="decision"):
        split_readable(spark, never, DECISIONS, names)
    null = _put(d, "null.json", '{"N_ROW": 1, "UBIGEO": "01", "RESULTADO": null}\n')
    assert rows(split_readable(spark, null, DECISIONS, names)[0]) == [(1, "01", None)]


CELLS = ["a", "", "b c", '5" pipe', "x, y", "two\nlines", 'say ""hi""', "\n", "three\n\nlines", '"', "ñ😀", "H1", "tail\n,"]


def _export(rng, n):
    """Records of an export as text, some cells quoted without need."""
    out, rows_ = ["H1,H2,H3"], []
    for i in range(n):
        row = [f"k{i}", rng.choice(CELLS), rng.choice(CELLS)]
        cells = [c if c == '5" pipe' else '"' + c.replace('"', '""') + '"' if set(c) & set(',"\n') or rng.random() < 0.2 else c
                 for c in row]
        out.append(",".join(cells))
        rows_.append(tuple(row))
    return "\n".join(out) + "\n", rows_


@pytest.mark.parametrize("split", [1 << 27, 150])
def test_a_file_with_quoted_line_ends_is_cut_by_many_tasks(spark, split):
    from tallyfold.sources.csv_records import csv_records
    d = tempfile.mkdtemp(prefix="tf-split-")
    text, want = _export(random.Random(split), 120)
    path = _put(d, "sheet.csv", 'BANNER, "of\ntwo lines"\n' + text)
    keys = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = csv_records(spark, path, ["H1", "H2", "H3"]).orderBy("line").collect()
        if split < 1000:
            assert spark.read.text(path).rdd.getNumPartitions() > 10
        good, rejected = split_readable(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in ("H1", "H2", "H3")]))
        read = rows(good)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [next(csv.reader(io.StringIO(r.record))) for r in got] == [list(w) for w in want]
    lines = text.split("\n")
    assert all(r.record.split("\n")[0] == lines[r.line - 2] for r in got)  # the place of its first line
    assert sorted(tuple(c or "" for c in r) for r in read) == sorted(want)
    assert rejected.count() == 0


def test_the_state_of_a_line():
    from tallyfold.sources.csv_records import ends_inside
    outside = {'a,b': False, 'a,"b': True, 'a,"b""': True, 'a,"b"': False, 'a,5" x': False, '"a""b"",c': True, '"a"x,"': True,
               '"": ,"x': True, '': False, '"': True, '""': False, '"a","b","c': True, 'x"y,"z': True}
    inside = {'': True, 'a': True, 'a"': False, 'a"",b': True, 'a",b': False, 'a","b': True, '"",': True, '"x,"y': True, '",""': False}
    assert {k: ends_inside(k, False) for k in outside} == outside
    assert {k: ends_inside(k, True) for k in inside} == inside


def test_row_ids_follow_the_records_however_the_files_are_split(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="tf-ids-"), "form.csv")
    os.makedirs(d)
    _put(d, "a.csv", "BANNER\nn_row,ubigeo,decision\n" + "".join(f'{i},"0\n{i}",OK\n' for i in range(60)))
    _put(d, "b.csv", "n_row,ubigeo,decision\n" + "".join(f"{i},1,OK\n" for i in range(60, 90)))
    schema = T.StructType([*DECISIONS.fields, T.StructField("sid", T.StringType())])
    ids = []
    for split in ("134217728", "100"):
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        try:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            ids.append([tuple(r) for r in split_readable(spark, d, schema, row_id="sid")[0].orderBy("sid").collect()])
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ids[0] == ids[1] and [r[0] for r in ids[0]] == list(range(90))
