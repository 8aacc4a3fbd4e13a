"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

import re

from tallyfold.llm import secret_scan

_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

EXACT_DEDUP = f"""
    WITH norm AS (
        SELECT doc_id, translate(coalesce(text, ''), {_A_TO_Z}) AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
           count(*) OVER (PARTITION BY t) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
           sha256(t) AS text_sha256
    FROM norm"""


LEXICAL_SEARCH = rf"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, translate(text, {_A_TO_Z}) AS t FROM documents),
    items AS (SELECT row_number() OVER () AS iid, item_id, translate(text, {_A_TO_Z}) AS t FROM benchmark),
    words AS (
        SELECT rid, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM docs),
    lengths AS (SELECT rid, count(*) AS n FROM words GROUP BY rid),
    totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM lengths),
    asked AS (
        SELECT DISTINCT iid, item_id,
               unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM items),
    postings AS (
        SELECT rid, doc_id, term, count(*) AS tf FROM words
        WHERE term IN (SELECT term FROM asked) GROUP BY rid, doc_id, term),
    weights AS (
        SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
        FROM postings, totals GROUP BY term),
    norms AS (SELECT rid, 100 - 90 + (90 * n * docs) // length AS m FROM lengths, totals),
    scores AS (
        SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
        FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN norms USING (rid)
        GROUP BY iid, item_id, rid, doc_id)
    SELECT item_id, (row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0
    QUALIFY rank <= 10"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _either_case(pattern: str) -> str:
    """Both cases of ASCII letters only, where ``(?i)`` would take other letters too."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


def secrets() -> str:
    """The whole result of the secret scan; windows are counted one by one."""
    s = secret_scan
    assign = s.ASSIGN.replace("(?i)", "").replace("|".join(s.KEYWORDS), _either_case("|".join(s.KEYWORDS)))
    patterns = [assign, s.ACCESS, s.HEX, *(f"[{c.chars}]{{{c.window},}}" for c in s.CLASSES)]
    found = " UNION ALL ".join(
        f"SELECT rid, {kind} AS kind, regexp_extract_all(text, {_quoted(p)}) AS m, "
        f"string_split_regex(text, {_quoted(p)}) AS g FROM docs WHERE regexp_matches(text, {_quoted(p)})"
        for kind, p in enumerate(patterns))
    allowed = " OR ".join(f"regexp_matches(match, {_quoted(p)})" for p in s.ALLOWED)
    first = len(s.BASE_KINDS)
    classes = ", ".join(f"({first + i}, {c.window}, {s.entropy_limit(c)}, {s.entropy_costs(c.window)})"
                        for i, c in enumerate(s.CLASSES))
    count = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(s.BASE_KINDS))
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({found}),
    each AS (SELECT rid, kind, unnest(m) AS match, unnest(g[:len(m)]) AS gap, unnest(range(len(m))) AS i FROM found),
    placed AS (
        SELECT *, (sum(length(gap) + length(match)) OVER (PARTITION BY rid, kind ORDER BY i))::BIGINT AS e
        FROM each),
    base AS (
        SELECT rid, kind, e - length(match) AS s, e FROM placed
        WHERE kind < {first} AND (kind > 0 OR length(regexp_extract(match, {_quoted(assign)}, 2)) >= {s.ASSIGN_CHARS})),
    classes(kind, size, most, costs) AS (VALUES {classes}),
    windows AS (
        SELECT rid, kind, i, e - length(match) AS s, match, size, most, costs,
               unnest(range(length(match) - size + 1)) AS o
        FROM placed JOIN classes USING (kind)
        WHERE NOT ({allowed} OR regexp_matches(right(gap, {s.LABEL_CHARS}), {_quoted(s.CHECKSUM_LABEL)}))),
    high AS (
        SELECT rid, kind, i, size, s + o AS s FROM windows
        WHERE list_sum(list_transform(
            map_values(list_aggregate(string_split(substr(match, o + 1, size), ''), 'histogram')),
            lambda n: costs[n::BIGINT + 1])) <= most),
    marked AS (
        SELECT *, (coalesce(s - lag(s) OVER w > size, true))::INT AS fresh FROM high
        WINDOW w AS (PARTITION BY rid, kind, i ORDER BY s)),
    numbered AS (
        SELECT *, sum(fresh) OVER (PARTITION BY rid, kind, i ORDER BY s) AS island FROM marked),
    more AS (
        SELECT rid, kind, min(s) AS s, max(s) + any_value(size) AS e FROM numbered GROUP BY rid, kind, i, island),
    spans AS (
        SELECT * FROM base
        UNION ALL
        SELECT * FROM more WHERE NOT EXISTS (
            SELECT 1 FROM base WHERE base.rid = more.rid AND base.s <= more.s AND more.e <= base.e)),
    texts AS (
        SELECT rid, kind, s, e, [{', '.join(map(_quoted, s.KINDS))}][kind + 1] || ':' || s || ':' || e AS span FROM spans),
    listed AS (
        SELECT rid, {count}, coalesce(string_agg(span, ',' ORDER BY s, kind, e) FILTER (kind < {first}), '') AS base,
               string_agg(span, ',' ORDER BY s, kind, e) AS spans
        FROM texts GROUP BY rid)
    SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in s.BASE_KINDS)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM docs LEFT JOIN listed USING (rid)"""
