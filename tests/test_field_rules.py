"""The original workflow's own labels (rules.FIELD) end to end through the CLI."""

import dataclasses
import json
import os
import re
import tempfile

import pytest

from tallyfold.__main__ import main
from tallyfold.plans.rules import FIELD
from tallyfold.sources.io import split_readable
from tallyfold.sources.schemas import SUBMISSIONS as SCHEMA

from conftest import rows

# the exports' own headers; the last columns' order differs from the form's
SUBMISSIONS = """Marca temporal,Departamento,Provincia,Distrito,Fecha de la Asistencia Técnica,Unidad Orgánica o Programa Social del responsable que brinda la asistencia técnica,Modalidad que brindó la asistencia técnica,Cargo del responsable,Intervención en la que se brindó asistencia técnica,Institución que recibió la asistencia técnica
2022-05-03T10:00:00,Lima Metropolitana,Lima,Ancón,2022-05-02T00:00:00,Otra unidad,Presencial,Coordinador de Enlace,Sello Municipal,Equipo Territorial MIDIS (Regional)
2022-06-10T09:00:00,Amazonas,Chachapoyas,Asunción,2022-06-09T00:00:00,Juntos,Virtual,Especialista,Sello Municipal,Gobierno Local
2022-08-15T08:00:00,Áncash,Huaraz,Huaráz,2022-08-14T00:00:00,Cuna Más,Virtual,Especialista,Sello Municipal,IAL
2022-08-16T08:00:00,Amazonas,Chachapoyas,Asunción,2022-08-16T00:00:00,Juntos,Virtual,Especialista,Sello Municipal,IAL
2022-09-01T08:00:00,Amazonas,Chachapoyas,Chachapoyas,2022-08-30T00:00:00,Dirección de Articulación Territorial,Presencial,Coordinador de Enlace,Sello Municipal,Gobierno Local
2022-09-02T08:00:00,Amazonas,Chachapoyas,Chachapoyas,2022-09-01T00:00:00,Juntos,Virtual,Especialista,Otro programa,IAL
2022-09-03T08:00:00,,Chachapoyas,Chachapoyas,2022-09-02T00:00:00,Juntos,Virtual,Especialista,Sello Municipal,IAL
2022-09-04T08:00:00,Amazonas,Chachapoyas,Chachapoyas,2022-09-03T00:00:00,Juntos,Virtual,Especialista,Sello Municipal,Otra institución
"""
PLACES = """REPORTE DISTRITAL 2022,,,,,,,,
DEPARTAMENTO,UBIGEO,PROVINCIA,DISTRITO,a,b,c,d,Avance
LIMA M,150101,LIMA,LIMA,,,,,1
LIMA M,150102,LIMA,ANCON,,,,,2
AMAZONAS,010101,CHACHAPOYAS,CHACHAPOYAS,,,,,
AMAZONAS,010102,CHACHAPOYAS,ASUNCION,,"x, y",,,
ANCASH,020101,HUARAZ,HUARAZ,,,,,
cut short
"""
ATTENDANCE = "UBIGEO,MES\n010101,AGOSTO\n020101,MAYO\n020101,MAYO\n"
LEGACY = "UBIGEO,Junio,,Junio IAL,Julio,,Julio IAL\n010102,x,1,,x,2,\n"
EXCLUSIONS = "N_ROW\n4\n"


def day_first(text):
    """The same submissions as the form's own export writes them: 3/5/2022 10:00:00 and 2/5/2022."""
    text = re.sub(r"(?m)^(\d{4})-(\d\d)-(\d\d)T0?(\d+:\d\d:\d\d)",
                  lambda m: f"{int(m[3])}/{int(m[2])}/{m[1]} {m[4]}", text)
    return re.sub(r"(\d{4})-(\d\d)-(\d\d)T00:00:00", r"\3/\2/\1", text)


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


@pytest.mark.parametrize("written", [str, day_first])
def test_field_workflow(spark, capsys, written):
    d = tempfile.mkdtemp(prefix="tf-field-")
    places = _write(d, "places.csv", PLACES)
    main(["legacy", "--places", places, "--legacy-wide", _write(d, "legacy.csv", LEGACY),
          "--out", d + "/legacy"])
    main(["regional", "--submissions", _write(d, "subs.csv", written(SUBMISSIONS)), "--places", places,
          "--exclusions", _write(d, "excl.csv", EXCLUSIONS), "--out", d + "/regional"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    # the form has no id: the sheet's order, which is that of the stamps here, numbers the rows
    classified = {f"s{r.n_row:02d}": r for r in spark.read.parquet(out["classified"]).collect()}
    assert [r.record for r in spark.read.parquet(d + "/regional/rejects_places").collect()] == ["cut short"]
    assert "s04" not in classified                      # excluded row number 4
    assert "s06" not in classified and "s07" not in classified
    assert classified["s01"].department == "LIMA M" and classified["s01"].category == "AT_ETR"
    assert classified["s03"].category == "AT_PPSS" and classified["s03"].responsible == "CUNA MAS"
    assert classified["s05"].category == "AT_GL"
    assert classified["s08"].category is None          # quarantined
    assert spark.read.parquet(out["quarantine"]).count() == 1
    reg = {r.department: r for r in spark.read.parquet(out["regional_matrix"]).collect()}
    assert set(reg) == {"LIMA M", "AMAZONAS", "ANCASH"} and reg["LIMA M"]["AT_ETR_052022"] == 1
    cands = {r.n_row: r.ubigeo for r in spark.read.parquet(out["candidates"]).collect()}
    n03, n05 = classified["s03"].n_row, classified["s05"].n_row
    assert cands == {n03: "020101", n05: "010101"}
    decisions = _write(d, "decisions.csv", f"N_ROW,UBIGEO,dist,RESULTADO\n{n03},020101,0.1,OK\n{n05},010101,0,OK\n")
    main(["local", "--classified", out["classified"], "--decisions", decisions,
          "--attendance", _write(d, "att.csv", ATTENDANCE), "--legacy", d + "/legacy/legacy_long",
          "--places", places, "--out", d + "/local"])
    local = {r.ubigeo: r for r in spark.read.parquet(d + "/local/local_matrix").collect()}
    assert local["020101"]["AT_PPSS_082022"] == 1.0
    assert local["020101"]["CARGO_PPSS_082022"] == "CUNA MAS"
    assert local["020101"]["MODALIDAD_082022"] == "Virtual"
    assert local["020101"]["AT_PPSS_052022"] == 0.0        # doubled attendance rows vanish (Q2)
    assert local["010101"]["AT_GL_082022"] == 1.0
    assert local["010101"]["CARGO_PPSS_082022"] == "CUNA MAS"
    assert local["010101"]["MODALIDAD_082022"] == "Presencial"
    assert local["010102"]["MODALIDAD_062022"] == "Presencial"
    assert local["010102"]["MODALIDAD_072022"] == "Virtual"
    assert local["010102"]["CARGO_PPSS_062022"] == "-"


def test_stamps_that_the_patterns_read_in_two_ways_are_rejected(spark):
    d = tempfile.mkdtemp(prefix="tf-field-")
    head, *lines = day_first(SUBMISSIONS).splitlines()
    assert lines[0].startswith("3/5/2022 10:00:00") and ",02/05/2022," in lines[0]
    lines[2] = lines[2].replace("15/8/2022 8:00:00", "31/2/2022 8:00:00")
    path = _write(d, "subs.csv", "\n".join([head, *lines]) + "\n")
    headers = FIELD.headers["submissions"]
    good, rejected = split_readable(spark, path, SCHEMA, headers, row_id="submission_id",
                                    patterns=FIELD.patterns["submissions"])
    assert [r["reason"] for r in rejected.collect()] == ["unreadable submitted_at"]
    assert str(good.orderBy("submitted_at").first()["event_date"]) == "2022-05-02 00:00:00"
    both = dataclasses.replace(FIELD, patterns={"submissions": {
        "submitted_at": ("d/M/yyyy H:mm:ss",), "event_date": ("d/M/yyyy", "M/d/yyyy")}})
    good, rejected = split_readable(spark, path, SCHEMA, headers, row_id="submission_id",
                                    patterns=both.patterns["submissions"])
    # 02/05, 09/06, 01/09, 02/09 and 03/09 can be read both ways, 16/08 and 30/08 only as day first
    assert sorted(r["reason"] for r in rejected.collect()) == ["ambiguous event_date"] * 5 + ["unreadable submitted_at"]
    assert [str(r["event_date"])[:10] for r in good.orderBy("event_date").collect()] == ["2022-08-16", "2022-08-30"]
    assert rows(good, "department") == [("Amazonas",)] * 2
