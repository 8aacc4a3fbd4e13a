"""Rule sets: every label, list and date the jobs depend on.

``FIELD`` holds the original workflow's values (Spanish labels are data);
``STANDIN`` the values that make the driver's TPC-H-like tables play the
same roles (see plans/standins.py).  Jobs take a rule set as a parameter.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class ClassRule:
    """Label rows whose recipient is in ``recipients`` and whose unit is the
    coordination unit (``units=None``) or one of ``units``."""
    label: str
    recipients: tuple[str, ...]
    units: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Rules:
    months: tuple[str, ...]
    year: str
    local_start: dt.date
    regional_classes: tuple[str, ...]
    local_classes: tuple[str, ...]
    local_names: tuple[str, ...]
    zero_filled: tuple[str, ...]
    numeric_prefixes: tuple[str, ...]
    coordination: str
    coordinator_positions: tuple[str, ...]
    department_rewrite: tuple[str, str]
    intervention_pattern: str
    class_rules: tuple[ClassRule, ...]
    month_numbers: dict[str, str]
    attendance_label: str
    legacy_months: tuple[tuple[str, str], ...]
    mode_yes: str
    mode_no: str
    special_prefix: str
    special_label: str
    placeholder: str = "-"
    sentinel_missing: str = "NA"
    match_caps: tuple[int, int] = (3, 2)
    type_labels: tuple[str, str] = ("CE", "PPSS")
    mode_separator: str = " y "
    presence_value: str = "1"
    role_name: str = "CARGO_PPSS"
    mode_name: str = "MODALIDAD"
    presence_class: str = "AT_PPSS"
    # original header of each declared column, by input; places of unnamed ones
    headers: dict[str, dict[str, str]] = field(default_factory=dict)
    positions: dict[str, dict[int, str]] = field(default_factory=dict)
    legacy_tail: tuple[str, ...] | None = None
    # patterns of dates and stamps that aren't ISO text, by input and declared column, in order
    patterns: dict[str, dict[str, tuple[str, ...]]] = field(default_factory=dict)


# Fixed values of the original workflow.
_FIELD_COORD = "DIRECCION DE ARTICULACION TERRITORIAL"
FIELD = Rules(
    months=("052022", "062022", "072022", "082022", "092022", "102022", "112022"),
    year="2022",
    local_start=dt.date(2022, 8, 1),
    regional_classes=("AT_ETR", "AT_ETL", "AT_GORE"),
    local_classes=("AT_GL", "AT_PPSS"),
    local_names=("AT_GL", "AT_PPSS", "CARGO_PPSS", "MODALIDAD"),
    zero_filled=("AT_GL", "AT_PPSS"),
    numeric_prefixes=("AT_GL", "AT_PPSS"),
    coordination=_FIELD_COORD,
    coordinator_positions=("COORDINADOR DE ENLACE", "CORDINADOR ENLACE MIDIS"),
    department_rewrite=("LIMA METROPOLITANA", "LIMA M"),
    intervention_pattern="EGTPI|Sello Municipal",
    class_rules=(
        ClassRule("AT_ETR", ("Equipo Territorial MIDIS (Regional)",)),
        ClassRule("AT_ETL", ("Equipo Territorial MIDIS (Local)",)),
        ClassRule("AT_GORE", ("Gobierno Regional", "IAR")),
        ClassRule("AT_GL", ("Gobierno Local", "IAL")),
        ClassRule("AT_PPSS", ("Gobierno Local", "IAL"),
                  ("CUNA MAS", "JUNTOS", "PAIS", "PENSION 65", "QALI WARMA")),
    ),
    month_numbers={"MAYO": "05", "JUNIO": "06", "JULIO": "07", "AGOSTO": "08"},
    attendance_label="CUNA MAS",
    legacy_months=(("062022", "mode_june"), ("072022", "mode_july")),
    mode_yes="Presencial",
    mode_no="Virtual",
    special_prefix="15",
    special_label="LIMA",
    headers={
        "submissions": {
            "submitted_at": "Marca temporal",
            "department": "Departamento",
            "province": "Provincia",
            "district": "Distrito",
            "event_date": "Fecha de la Asistencia Técnica",
            "responsible": "Unidad Orgánica o Programa Social del responsable"
                           " que brinda la asistencia técnica",
            "mode": "Modalidad que brindó la asistencia técnica",
            "position": "Cargo del responsable",
            "intervention": "Intervención en la que se brindó asistencia técnica",
            "recipient": "Institución que recibió la asistencia técnica",
        },
        "places": {"ubigeo": "UBIGEO", "department": "DEPARTAMENTO", "province": "PROVINCIA",
                   "district": "DISTRITO"},
        "attendance": {"ubigeo": "UBIGEO", "month_name": "MES"},
        "decisions": {"n_row": "N_ROW", "ubigeo": "UBIGEO", "decision": "RESULTADO"},
        "exclusions": {"n_row": "N_ROW"},
        "legacy_wide": {"ubigeo": "UBIGEO"},
    },
    positions={"places": {9: "EGTPI"}},
    legacy_tail=("at_june", "mode_june", "ial_june", "at_july", "mode_july", "ial_july"),
    patterns={"submissions": {
        "submitted_at": ("d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy"),
        "event_date": ("d/M/yyyy", "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm")}},
)

# Stand-in values for the driver tables.
STANDIN = Rules(
    months=("051996", "061996", "071996", "081996", "091996", "101996", "111996"),
    year="1996",
    local_start=dt.date(1996, 8, 1),
    regional_classes=FIELD.regional_classes,
    local_classes=FIELD.local_classes,
    local_names=FIELD.local_names,
    zero_filled=FIELD.zero_filled,
    numeric_prefixes=FIELD.numeric_prefixes,
    coordination="DIRECCION",
    coordinator_positions=("P",),
    department_rewrite=("MIDDLE EAST", "MIDEAST"),
    intervention_pattern="URGENT|HIGH|MEDIUM|LOW",
    class_rules=(
        ClassRule("AT_ETR", ("AUTOMOBILE",)),
        ClassRule("AT_ETL", ("BUILDING",)),
        ClassRule("AT_GORE", ("FURNITURE", "HOUSEHOLD")),
        ClassRule("AT_GL", ("MACHINERY", "HOUSEHOLD")),
        ClassRule("AT_PPSS", ("MACHINERY", "HOUSEHOLD"), ("1-URGENT", "2-HIGH", "3-MEDIUM")),
    ),
    month_numbers=FIELD.month_numbers,
    attendance_label=FIELD.attendance_label,
    legacy_months=(("061996", "mode_june"), ("071996", "mode_july")),
    mode_yes=FIELD.mode_yes,
    mode_no=FIELD.mode_no,
    special_prefix="15",
    special_label="STANDARD",
)
