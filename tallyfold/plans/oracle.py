"""DuckDB oracle statements for the registered queries.

Written straight from the reference semantics (global row_number, naive
all-pairs matcher with windows, conditional-aggregate pivots) — on purpose
not from the Spark plans, so the two sides are independent.
"""

from __future__ import annotations

from tallyfold.plans.rules import STANDIN


def _fold(x: str) -> str:
    return f"upper(strip_accents(replace({x}, 'ß', 'ss')))"


def _lst(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _values(col: str, values) -> str:
    return "(VALUES " + ", ".join(f"('{v}')" for v in values) + f") AS t_{col}({col})"


_LO = "DATE '1996-05-01'"
_HI = "DATE '1996-12-01'"
_LOCAL = f"DATE '{STANDIN.local_start.isoformat()}'"
_OLD, _NEW = STANDIN.department_rewrite

CTE = {}
CTE["sub_raw"] = """
  SELECT o.o_orderkey AS submission_id, o.o_orderdate AS submitted_at,
         CASE WHEN c.c_acctbal >= 0 THEN r.r_name END AS department,
         n.n_name AS province,
         CASE WHEN c.c_acctbal >= 0 AND c.c_acctbal < 100 THEN 'NA' ELSE c.c_mktsegment END AS district,
         o.o_orderdate AS event_date, o.o_orderpriority AS responsible, o.o_orderstatus AS mode,
         o.o_orderstatus AS position, o.o_orderpriority AS intervention, c.c_mktsegment AS recipient
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey"""
CTE["numbered"] = """
  SELECT *, row_number() OVER (ORDER BY submitted_at ASC NULLS LAST, submission_id) AS n_row
  FROM sub_raw"""
CTE["excluded"] = """
  SELECT nb.n_row FROM numbered nb JOIN orders o ON nb.submission_id = o.o_orderkey
  WHERE o.o_totalprice > 490000"""
CTE["clean"] = f"""
  SELECT n_row, submission_id, {_fold('department')} AS department,
         {_fold('province')} AS province, {_fold('district')} AS district,
         CAST(event_date AS DATE) AS event_date, {_fold('responsible')} AS responsible,
         mode, {_fold('position')} AS position, intervention, recipient
  FROM numbered
  WHERE n_row NOT IN (SELECT n_row FROM excluded)
    AND {_fold('department')} IS NOT NULL
    AND coalesce(regexp_matches(intervention, '{STANDIN.intervention_pattern}'), false)"""
CTE["rw1"] = f"""
  SELECT * REPLACE (CASE WHEN department = '{_OLD}' THEN '{_NEW}' ELSE department END AS department)
  FROM clean"""
CTE["rw2"] = f"""
  SELECT * REPLACE (CASE WHEN coalesce(position IN ({_lst(STANDIN.coordinator_positions)}), false)
                         THEN '{STANDIN.coordination}' ELSE responsible END AS responsible)
  FROM rw1"""
CTE["classified"] = f"""
  SELECT * EXCLUDE (position), CASE
    WHEN recipient = 'AUTOMOBILE' AND responsible = '{STANDIN.coordination}' THEN 'AT_ETR'
    WHEN recipient = 'BUILDING' AND responsible = '{STANDIN.coordination}' THEN 'AT_ETL'
    WHEN recipient IN ('FURNITURE', 'HOUSEHOLD') AND responsible = '{STANDIN.coordination}' THEN 'AT_GORE'
    WHEN recipient IN ('MACHINERY', 'HOUSEHOLD') AND responsible = '{STANDIN.coordination}' THEN 'AT_GL'
    WHEN recipient IN ('MACHINERY', 'HOUSEHOLD') AND responsible IN ({_lst(STANDIN.class_rules[-1].units)}) THEN 'AT_PPSS'
  END AS category
  FROM rw2"""
CTE["tidy"] = "SELECT * FROM classified WHERE category IS NOT NULL"
CTE["places"] = f"""
  SELECT printf('%02d', n.n_nationkey) AS ubigeo,
         CASE WHEN r.r_name = '{_OLD}' THEN '{_NEW}' ELSE r.r_name END AS department,
         n.n_name AS province, n.n_name AS district
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""
CTE["reg_facts"] = f"""
  SELECT department, category || '_' || strftime(event_date, '%m%Y') AS name
  FROM tidy
  WHERE event_date >= {_LO} AND event_date < {_HI}
    AND category IN ({_lst(STANDIN.regional_classes)})"""
CTE["month_counts"] = "SELECT department, name, count(*) AS n FROM reg_facts GROUP BY department, name"
CTE["local_rows"] = f"""
  SELECT * FROM tidy
  WHERE event_date >= {_LOCAL} AND district IS NOT NULL AND district <> 'NA'
    AND category IN ({_lst(STANDIN.local_classes)})"""
CTE["dec_src"] = """
  SELECT l.n_row, o.o_orderpriority AS pri, c.c_acctbal AS bal,
         printf('%02d', c.c_nationkey) AS own_code,
         printf('%02d', n.n_regionkey) AS region_code
  FROM local_rows l JOIN orders o ON l.submission_id = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey"""
_VERDICT = """CASE WHEN bal < 1000 THEN 'NO' WHEN bal < 2000 THEN NULL
                  WHEN bal < 3000 THEN region_code ELSE 'OK' END"""
CTE["decisions"] = f"""
  SELECT n_row, own_code AS ubigeo, {_VERDICT} AS decision FROM dec_src
  UNION ALL
  SELECT n_row, region_code AS ubigeo, {_VERDICT} AS decision FROM dec_src WHERE pri = '1-URGENT'"""
CTE["accepted"] = """
  SELECT DISTINCT CASE WHEN decision = 'OK' THEN ubigeo ELSE decision END AS ubigeo, n_row
  FROM decisions WHERE decision <> 'NO'"""
CTE["right_side"] = f"""
  SELECT n_row, category AS name, strftime(event_date, '%m%Y') AS fecha,
         CASE WHEN responsible = '{STANDIN.coordination}' THEN 'CE'
              WHEN NOT (responsible = '{STANDIN.coordination}') THEN 'PPSS' END AS type,
         mode AS modal, responsible AS value
  FROM tidy WHERE event_date >= {_LOCAL}"""
CTE["joined"] = """
  SELECT a.ubigeo, a.n_row, r.name, r.fecha, r.type, r.modal, r.value
  FROM accepted a LEFT JOIN right_side r ON a.n_row = r.n_row"""
CTE["modes"] = """
  SELECT ubigeo, fecha, coalesce(string_agg(DISTINCT modal, ' y ' ORDER BY modal), '') AS modal_text
  FROM joined GROUP BY ubigeo, fecha"""
CTE["enriched"] = """
  SELECT j.ubigeo, j.n_row, j.name, j.fecha, j.type, m.modal_text AS modal, j.value
  FROM joined j JOIN modes m
    ON j.ubigeo IS NOT DISTINCT FROM m.ubigeo AND j.fecha IS NOT DISTINCT FROM m.fecha"""
CTE["at_local"] = """
  SELECT ubigeo, name, fecha, modal, value FROM (
    SELECT *, min(n_row) OVER (PARTITION BY ubigeo, name, type, fecha) AS first_row FROM enriched)
  WHERE n_row = first_row"""
_MONTH_CASE = "CASE month_name " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in STANDIN.month_numbers.items()) + " END"
CTE["attendance"] = """
  SELECT printf('%02d', s_nationkey) AS ubigeo,
         CASE WHEN s_acctbal < 0 THEN 'MAYO' WHEN s_acctbal < 3000 THEN 'JUNIO'
              WHEN s_acctbal < 6000 THEN 'JULIO' WHEN s_acctbal < 9000 THEN 'AGOSTO'
              ELSE 'SETIEMBRE' END AS month_name
  FROM supplier"""
CTE["cuna"] = f"""
  SELECT ubigeo, 'AT_PPSS' AS name, {_MONTH_CASE} || '{STANDIN.year}' AS fecha,
         '-' AS modal, 'CUNA MAS' AS value
  FROM attendance"""
CTE["legacy_wide"] = """
  SELECT printf('%02d', c.c_nationkey) AS ubigeo,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'x' END AS at_june,
         CASE WHEN c_acctbal < 0 THEN NULL WHEN n_regionkey IN (0, 1) THEN '1'
              WHEN n_regionkey = 2 THEN '2' END AS mode_june,
         CASE WHEN c_acctbal > 5000 THEN 'y' END AS ial_june,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN 'x' END AS at_july,
         CASE WHEN c_acctbal < 0 THEN NULL WHEN n_regionkey IN (1, 3) THEN '2'
              WHEN n_regionkey = 4 THEN '1' END AS mode_july,
         CASE WHEN c_acctbal > 2500 THEN 'y' END AS ial_july
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""
def _legacy_ctes(wide: str, keys: str, out: str) -> None:
    """legacy long rows from a wide table: distinct modes per key and month,
    a single mode repeated to the key's row count."""
    CTE[keys] = f"""
  SELECT p.ubigeo, coalesce(s.nj, 0) AS nj, coalesce(s.nl, 0) AS nl,
         greatest(greatest(coalesce(s.nj, 0), 1), greatest(coalesce(s.nl, 0), 1)) AS n
  FROM places p LEFT JOIN (
    SELECT ubigeo, count(DISTINCT mode_june) AS nj, count(DISTINCT mode_july) AS nl
    FROM {wide} GROUP BY ubigeo) s ON p.ubigeo = s.ubigeo"""
    parts = []
    for month, col, cnt in (("061996", "mode_june", "nj"), ("071996", "mode_july", "nl")):
        parts.append(f"""
  SELECT ubigeo, 'AT_PPSS' AS name, '{month}' AS fecha, {_DECODE} AS modal, '-' AS value
  FROM (SELECT k.ubigeo, j.m, unnest(range(CASE WHEN k.{cnt} = 1 THEN k.n ELSE 1 END)) AS rep
        FROM {keys} k JOIN (SELECT DISTINCT ubigeo, {col} AS m FROM {wide}
                             WHERE {col} IS NOT NULL) j ON k.ubigeo = j.ubigeo)""")
    CTE[out] = "\n  UNION ALL".join(parts)


_DECODE = "CASE WHEN m = '1' OR TRY_CAST(m AS DOUBLE) = 1 THEN 'Presencial' ELSE 'Virtual' END"
_legacy_ctes("legacy_wide", "lw_keys", "legacy_long")


def _fan(src: str, cond: str = "TRUE") -> str:
    return f"""
  SELECT ubigeo, name, fecha, modal, '1' AS value FROM {src}
  UNION ALL SELECT ubigeo, 'CARGO_PPSS', fecha, modal, value FROM {src} WHERE {cond}
  UNION ALL SELECT ubigeo, 'MODALIDAD', fecha, modal, modal FROM {src}"""


CTE["fanned"] = (_fan("at_local", f"value <> '{STANDIN.coordination}'") + "\n  UNION ALL"
                 + _fan("cuna") + "\n  UNION ALL" + _fan("legacy_long"))
CTE["p1"] = "SELECT *, count(*) OVER (PARTITION BY ubigeo, name, fecha) AS reps FROM fanned"
CTE["p2"] = "SELECT * EXCLUDE (reps) FROM p1 WHERE reps = 1 OR coalesce(value <> '-', false)"
CTE["p3"] = "SELECT *, count(*) OVER (PARTITION BY ubigeo, name, fecha) AS reps FROM p2"
CTE["facts"] = """
  SELECT DISTINCT ubigeo, name, fecha, value FROM p3
  WHERE reps = 1 OR coalesce(modal <> '-', false)"""
CTE["grid"] = f"""
  SELECT p.*, t_fecha.fecha, t_name.name
  FROM places p, {_values('fecha', STANDIN.months)}, {_values('name', STANDIN.local_names)}"""
CTE["filled"] = f"""
  SELECT g.ubigeo, g.department, g.province, g.district, g.fecha, g.name,
         CASE WHEN g.name IN ({_lst(STANDIN.zero_filled)}) AND f.value IS NULL THEN '0'
              ELSE f.value END AS value
  FROM grid g LEFT JOIN facts f ON g.ubigeo = f.ubigeo AND g.fecha = f.fecha AND g.name = f.name"""
CTE["pg"] = """
  SELECT printf('%04d', min(p_partkey)) AS ubigeo, p_type, p_brand, p_name
  FROM part GROUP BY p_type, p_brand, p_name"""
CTE["gaz"] = f"""
  SELECT ubigeo,
         CASE WHEN substr(ubigeo, 1, {len(STANDIN.special_prefix)}) = '{STANDIN.special_prefix}'
              THEN '{STANDIN.special_label}' ELSE p_type END AS department,
         p_brand AS province, p_name AS district
  FROM pg"""
CTE["recs"] = """
  SELECT p_partkey AS n_row,
         CASE WHEN p_size <= 12 THEN substr(p_type, 1, 1) || substr(p_type, 3)
              WHEN p_size <= 25 THEN lower(p_type) ELSE p_type END AS department,
         CASE WHEN p_size > 47 THEN NULL
              WHEN p_size >= 20 AND p_size <= 30 THEN replace(p_brand, '#', ' ')
              ELSE p_brand END AS province,
         CASE WHEN p_size <= 10 THEN substr(p_name, 1, length(p_name) - 1)
              WHEN p_size <= 20 THEN replace(p_name, ' ', '')
              WHEN p_size <= 35 THEN substr(p_name, 2)
              ELSE p_name END AS district
  FROM part"""
CTE["pairs"] = """
  SELECT g.ubigeo, g.department AS gd, g.province AS gp, g.district AS gdi,
         r.department AS sd, r.province AS sp, r.district AS sdi, r.n_row,
         1 - jaro_similarity(lower(g.department), lower(r.department)) AS d1,
         1 - jaro_similarity(lower(g.province), lower(r.province)) AS d2,
         1 - jaro_similarity(lower(g.district), lower(r.district)) AS d3
  FROM gaz g CROSS JOIN recs r
  WHERE r.department IS NOT NULL AND r.province IS NOT NULL AND r.district IS NOT NULL"""
_T = "PARTITION BY sd, sp, sdi"
CTE["a1"] = f"SELECT *, min(d1) OVER ({_T}) AS m1 FROM pairs"
CTE["c1"] = f"SELECT *, rank() OVER ({_T} ORDER BY d1) AS rk1 FROM a1 WHERE m1 > 0 OR d1 = m1"
CTE["a2"] = f"SELECT *, min(d2) OVER ({_T}) AS m2 FROM c1 WHERE rk1 <= {STANDIN.match_caps[0]}"
CTE["c2"] = f"SELECT *, rank() OVER ({_T} ORDER BY d2) AS rk2 FROM a2 WHERE m2 > 0 OR d2 = m2"
CTE["c3"] = (f"SELECT *, rank() OVER ({_T} ORDER BY (d2 + 1) * (d3 + 1) + d3) AS rk3 "
             f"FROM c2 WHERE rk2 <= {STANDIN.match_caps[1]}")

CTE["lplaces"] = f"""
  SELECT ubigeo,
         CASE WHEN substr(ubigeo, 1, {len(STANDIN.special_prefix)}) = '{STANDIN.special_prefix}'
              THEN '{STANDIN.special_label}' ELSE department END AS department,
         province, district
  FROM places"""
CTE["lpairs"] = """
  SELECT g.ubigeo, g.department AS gd, g.province AS gp, g.district AS gdi,
         r.department AS sd, r.province AS sp, r.district AS sdi, r.n_row,
         1 - jaro_similarity(lower(g.department), lower(r.department)) AS d1,
         1 - jaro_similarity(lower(g.province), lower(r.province)) AS d2,
         1 - jaro_similarity(lower(g.district), lower(r.district)) AS d3
  FROM lplaces g CROSS JOIN local_rows r
  WHERE r.department IS NOT NULL AND r.province IS NOT NULL AND r.district IS NOT NULL"""
CTE["la1"] = f"SELECT *, min(d1) OVER ({_T}) AS m1 FROM lpairs"
CTE["lc1"] = f"SELECT *, rank() OVER ({_T} ORDER BY d1) AS rk1 FROM la1 WHERE m1 > 0 OR d1 = m1"
CTE["la2"] = f"SELECT *, min(d2) OVER ({_T}) AS m2 FROM lc1 WHERE rk1 <= {STANDIN.match_caps[0]}"
CTE["lc2"] = f"SELECT *, rank() OVER ({_T} ORDER BY d2) AS rk2 FROM la2 WHERE m2 > 0 OR d2 = m2"
CTE["lc3"] = (f"SELECT *, rank() OVER ({_T} ORDER BY (d2 + 1) * (d3 + 1) + d3) AS rk3 "
              f"FROM lc2 WHERE rk2 <= {STANDIN.match_caps[1]}")

CTE["legacy_wide_multi"] = """
  SELECT printf('%02d', c.c_nationkey) AS ubigeo,
         CASE WHEN c_acctbal < 0 THEN NULL
              WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '1' ELSE '2' END AS mode_june,
         CASE WHEN c_acctbal < 0 THEN NULL WHEN n_regionkey IN (1, 3) THEN '2'
              WHEN n_regionkey = 4 THEN '1' END AS mode_july
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"""
_legacy_ctes("legacy_wide_multi", "lwm_keys", "legacy_long_multi")

_ORDER = list(CTE)


def with_ctes(*names: str) -> str:
    """WITH clause holding ``names`` and every CTE defined before them."""
    last = max(_ORDER.index(n) for n in names)
    parts = [f"{n} AS ({CTE[n]}\n)" for n in _ORDER[:last + 1]]
    return "WITH " + ",\n".join(parts) + "\n"


_TIDY_COLS = ("n_row, submission_id, department, province, district, "
              "strftime(event_date, '%Y-%m-%d') AS event_date, responsible, mode, "
              "intervention, recipient, category")
_REG_NAMES = [f"{c}_{m}" for m in STANDIN.months for c in STANDIN.regional_classes]
_LOCAL_COLS = [f"{n}_{m}" for m in STANDIN.months for n in STANDIN.local_names]


def _local_col(c: str) -> str:
    name, month = c.rsplit("_", 1)
    cell = f"max(CASE WHEN name = '{name}' AND fecha = '{month}' THEN value END)"
    if any(c.lower().startswith(p.lower()) for p in STANDIN.numeric_prefixes):
        cell = f"TRY_CAST({cell} AS DOUBLE)"
    return f'{cell} AS "{c}"'


SQL: dict[str, str] = {
    "q_scan_declared": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS order_day, o_orderpriority
        FROM orders""",
    "q_banner_csv": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               strftime(o_orderdate, '%Y-%m-%d') AS order_day,
               CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL
                    WHEN '1-URGENT' THEN '1-URGENT, "now"'
                    WHEN '5-LOW' THEN '5-LOW' || chr(10) || 'any time'
                    ELSE o_orderpriority END AS o_orderpriority, NULL::VARCHAR AS reason
        FROM orders WHERE o_orderstatus <> 'P' OR o_orderstatus IS NULL
        UNION ALL
        SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, 'wrong number of fields'
        FROM orders WHERE o_orderstatus = 'P'""",
    "q_dated_export": """
        WITH d AS (
            SELECT o_orderkey, o_orderdate AS dt, o_orderstatus AS status, o_orderpriority AS pri,
                   coalesce(day(o_orderdate) <= 12 AND day(o_orderdate) <> month(o_orderdate)
                            AND o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM'), false) AS both_ways
            FROM orders)
        SELECT o_orderkey, NULL AS stamp, NULL AS day, 'unreadable stamp' AS reason FROM d WHERE status = 'P'
        UNION ALL
        SELECT o_orderkey, NULL, NULL, 'ambiguous day' FROM d WHERE status <> 'P' AND both_ways
        UNION ALL
        SELECT o_orderkey, strftime(dt, '%Y-%m-%d %H:%M:%S'),
               CASE WHEN pri <> '3-MEDIUM' THEN strftime(dt, '%Y-%m-%d') END, NULL
        FROM d WHERE status <> 'P' AND NOT both_ways""",
    "q_positional_rename": """
        SELECT p_partkey AS part_id, p_name AS name, p_brand AS brand, p_type AS kind,
               p_size AS size, p_retailprice AS price
        FROM part""",
    "q_fold_text": f"SELECT doc_id, {_fold('text')} AS folded FROM documents",
    "q_row_number": with_ctes("numbered") + "SELECT submission_id, n_row FROM numbered",
    "q_exclude_rows": with_ctes("excluded") + """
        SELECT n_row, submission_id FROM numbered
        WHERE n_row NOT IN (SELECT n_row FROM excluded)""",
    "q_clean": with_ctes("clean") + """
        SELECT n_row, submission_id, department, province, district,
               strftime(event_date, '%Y-%m-%d') AS event_date, responsible, mode, position,
               intervention, recipient
        FROM clean""",
    "q_classify": with_ctes("classified") + f"SELECT {_TIDY_COLS} FROM classified",
    "q_quarantine": with_ctes("classified") + f"SELECT {_TIDY_COLS} FROM classified WHERE category IS NULL",
    "q_unknown_members": with_ctes("tidy", "places") + """
        SELECT DISTINCT department FROM tidy
        WHERE department NOT IN (SELECT r_name FROM region WHERE r_name IS NOT NULL)""",
    "q_member_check": with_ctes("tidy", "places") + """
        SELECT d.department,
               d.department IN (SELECT r_name FROM region WHERE r_name IS NOT NULL) AS known
        FROM (SELECT DISTINCT department FROM tidy WHERE department IS NOT NULL) d""",
    "q_month_counts": with_ctes("month_counts") + "SELECT department, name, n FROM month_counts",
    "q_spine": with_ctes("places") + f"""
        SELECT DISTINCT p.department, t_name.name FROM places p, {_values('name', _REG_NAMES)}""",
    "q_keep_first_ties": with_ctes("tidy") + """
        SELECT department, category, strftime(event_date, '%Y-%m-%d') AS event_date, submission_id
        FROM (SELECT *, min(event_date) OVER (PARTITION BY department, category) AS first_day FROM tidy)
        WHERE event_date = first_day""",
    "q_group_size": with_ctes("tidy") + """
        SELECT submission_id, department, category,
               count(*) OVER (PARTITION BY department, category) AS reps FROM tidy""",
    "q_literal_table": with_ctes("attendance") + "SELECT m.month_name, m.month, a.n FROM (VALUES "
        + ", ".join(f"('{k}', '{v}')" for k, v in STANDIN.month_numbers.items())
        + """) AS m(month_name, month) LEFT JOIN (
            SELECT month_name, count(*) AS n FROM attendance GROUP BY month_name) a
          ON a.month_name = m.month_name""",
    "q_regional_matrix": with_ctes("month_counts") + "SELECT d.department, " + ", ".join(
        f"CAST(coalesce(max(CASE WHEN m.name = '{c}' THEN m.n END), 0) AS BIGINT) AS \"{c}\""
        for c in _REG_NAMES) + """
        FROM (SELECT DISTINCT department FROM places) d
        LEFT JOIN month_counts m ON d.department = m.department
        GROUP BY d.department""",
    "q_distinct_text": with_ctes("enriched") + """
        SELECT n_row, ubigeo, name, fecha, type, value, modal FROM enriched""",
    "q_keep_first": with_ctes("at_local") + "SELECT * FROM at_local",
    "q_decisions_accept": with_ctes("accepted") + "SELECT ubigeo, n_row FROM accepted",
    "q_decisions_reject": with_ctes("decisions") + f"""
        SELECT {_TIDY_COLS.replace('n_row,', 't.n_row,', 1)}
        FROM tidy t JOIN decisions d ON t.n_row = d.n_row WHERE d.decision = 'NO'""",
    "q_decisions_undecided": with_ctes("decisions") + """
        SELECT n_row, ubigeo, decision FROM decisions WHERE decision IS NULL""",
    "q_lookup_to_long": with_ctes("cuna") + "SELECT * FROM cuna",
    "q_fanout": with_ctes("fanned") + "SELECT ubigeo, name, fecha, modal, value FROM fanned",
    "q_drop_placeholders": with_ctes("facts") + "SELECT ubigeo, name, fecha, value FROM facts",
    "q_indicator_matrix": with_ctes("filled") + "SELECT ubigeo, department, province, district, "
        + ", ".join(_local_col(c) for c in _LOCAL_COLS)
        + " FROM filled GROUP BY ubigeo, department, province, district",
    "q_presence_max": with_ctes("legacy_wide") + """
        SELECT ubigeo,
          max(CASE WHEN at_june IS NOT NULL THEN 1 ELSE 0 END)::DOUBLE AS at_june,
          max(CASE WHEN ial_june IS NOT NULL THEN 1 ELSE 0 END)::DOUBLE AS ial_june,
          max(CASE WHEN at_july IS NOT NULL THEN 1 ELSE 0 END)::DOUBLE AS at_july,
          max(CASE WHEN ial_july IS NOT NULL THEN 1 ELSE 0 END)::DOUBLE AS ial_july
        FROM legacy_wide GROUP BY ubigeo""",
    "q_distinct_non_null": """
        WITH k AS (SELECT DISTINCT printf('%02d', c_nationkey) AS ubigeo FROM customer),
             v AS (SELECT DISTINCT printf('%02d', c_nationkey) AS ubigeo,
                          c_mktsegment AS segment
                   FROM customer WHERE c_acctbal > 9500)
        SELECT k.ubigeo, v.segment FROM k LEFT JOIN v ON k.ubigeo = v.ubigeo""",
    "q_legacy_long": with_ctes("legacy_long") + "SELECT * FROM legacy_long",
    "q_legacy_multi_mode": with_ctes("legacy_long_multi") + "SELECT * FROM legacy_long_multi",
    "q_jaro": with_ctes("recs") + """
        SELECT official, typed, round(1 - jaro_similarity(official, typed), 6) AS dist
        FROM (SELECT DISTINCT lower(p.p_name) AS official, lower(r.district) AS typed
              FROM part p JOIN recs r ON p.p_partkey = r.n_row)""",
    "q_fuzzy_cascade": with_ctes("c3") + """
        SELECT ubigeo, gd AS gaz_department, gp AS gaz_province, gdi AS gaz_district,
               sd AS sub_department, sp AS sub_province, sdi AS sub_district, n_row,
               round(d1, 6) AS dist_department, round(d2, 6) AS dist_province,
               round(d3, 6) AS dist_district, round(d1 + d2 + d3, 6) AS dist
        FROM c3 WHERE rk3 = 1""",
    "q_candidates": with_ctes("lc3") + """
        SELECT ubigeo, gd AS gaz_department, gp AS gaz_province, gdi AS gaz_district,
               sd AS sub_department, sp AS sub_province, sdi AS sub_district, n_row,
               round(d1, 6) AS dist_department, round(d2, 6) AS dist_province,
               round(d3, 6) AS dist_district, round(d1 + d2 + d3, 6) AS dist
        FROM lc3 WHERE rk3 = 1""",
    "q_fuzzy_no_candidate": with_ctes("recs") + """
        SELECT n_row, department, province, district FROM recs
        WHERE department IS NULL OR province IS NULL OR district IS NULL""",
}

SQL["q_unpivot"] = ("WITH pres AS (" + SQL["q_presence_max"] + ")\n" + " UNION ALL ".join(
    f"SELECT ubigeo, '{c}' AS indicator, {c} AS flag FROM pres"
    for c in ["at_june", "ial_june", "at_july", "ial_july"]))
