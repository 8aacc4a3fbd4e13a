"""Secrets in texts: fixed patterns, and windows of high entropy in long strings.

Three kinds come from patterns: an assignment to a secret-like name, an access
key id and a long hexadecimal run.  Further spans come from entropy: a run of
one character class (hexadecimal, base64) is a candidate string, a window
slides over it, and a span is a union of windows whose Shannon entropy reaches
the class's limit.  The window's counts are kept, not made anew: a character
that leaves and one that enters change one count each, and the sum of
``n log2 n`` over the counts changes by the difference of two table entries.
The table holds whole numbers (units of 2^-20 bit), so the sum is exact and
independent of the way to a window.  A candidate that the allow list knows
(numbers, words, slugs, UUIDs, alphabets, examples, labelled checksums) adds no
span, nor does a span inside one of the fixed patterns' matches.

All of it is column expressions over the row itself: no shuffle, no Python.
A text is cut after characters that no match nor its context can hold, and
candidates into pieces that overlap by a window, so that arrays stay short.

Defined results: a null text counts as empty and an empty text has no span;
repeated rows are searched each; other columns are ignored whatever their
names.  Places count code points, ends are exclusive.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = ("(?i)(" + "|".join(KEYWORDS) + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_CHARS = 6  # least length of an assigned value
# equal to the runs of any length, less those under 20 and 24 characters: a run is taken whole
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")


class CharClass(NamedTuple):
    """A candidate alphabet, its window in characters and the least entropy of a window in bits."""

    kind: str
    chars: str
    window: int
    bits: float


CLASSES = (CharClass("entropy_hex", "0-9A-Fa-f", 24, 3.0), CharClass("entropy_base64", "A-Za-z0-9+/_=-", 24, 4.0))

#: Candidates that match are no secrets.  Fixed list.
ALLOWED = (
    "^[0-9]+$",                                               # decimal numbers
    "^[A-Z]?[a-z]+$", "^[A-Z]+$",                             # words
    "^[A-Za-z]*[a-z]+([A-Z][a-z]+)+$",                        # joined words
    "^([A-Za-z]+|[0-9]{1,4})([-_/=+]+([A-Za-z]+|[0-9]{1,4}))*[-_/=+]*$",  # slugs, paths, constant names
    "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",   # UUIDs
    "(?i)abcdefgh|01234567|89abcdef|example|placeholder|xxxxxx",
)
#: What may stand directly before a candidate that is a public checksum.  Fixed list.
CHECKSUM_LABEL = r"(?i)(sha-?[0-9]{1,3}|md5|crc-?[0-9]*|checksum|digest|etag|commit|integrity)[\"']?\x20*[:=-]?\x20*[\"']?\z"
LABEL_CHARS = 32

# a character outside all patterns, candidates and labels
_OUTSIDE = r"[^A-Za-z0-9+/_.=:\"'\x20-]"
CHUNK = 16_384
# without such a run a text has no access key id, hexadecimal run or candidate
_LONG_RUN = "[A-Za-z0-9+/_=-]{20}"
_PIECE = 256       # windows of a candidate handled with one state
_UNIT = 1 << 20
_FIRST = ord("+")  # slot 1 of the counts; 'z' is the last
_SLOTS = ord("z") - _FIRST + 1


def entropy_costs(window: int) -> list[int]:
    """n log2 n in units of 2^-20 bit for n = 0 .. window."""
    return [round(n * math.log2(n) * _UNIT) if n else 0 for n in range(window + 1)]


def entropy_limit(c: CharClass) -> int:
    """A window has ``bits`` of entropy or more if its costs add up to at most this."""
    return math.floor((math.log2(c.window) - c.bits) * c.window * _UNIT)


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _empty(of: str) -> Column:
    return F.array().cast(f"array<{of}>")


_MATCH = "struct<start:bigint,end:bigint,match:string,before:string>"


def _placed(text: Column, found: Column, pattern: str) -> Column:
    """start, end, match and what stands before it, for the matches found in a text.

    The text between the matches gives their places.
    """
    between = F.split(text, pattern, -1)

    def step(state: Column, i: Column) -> Column:
        match, gap = found[i], F.element_at(state["between"], i + 1)
        start = state["at"] + F.char_length(gap)
        end = start + F.char_length(match)
        one = F.struct(start.alias("start"), end.alias("end"), match.alias("match"),
                       F.right(gap, F.lit(LABEL_CHARS)).alias("before"))
        return F.struct(end.alias("at"), state["between"].alias("between"),
                        F.concat(state["out"], F.array(one)).alias("out"))

    first = F.struct(_long(0).alias("at"), between.alias("between"), _empty(_MATCH).alias("out"))
    placed = F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), first, step, lambda s: s["out"])
    return F.when(F.size(found) > 0, placed).otherwise(_empty(_MATCH))


def _window_starts(piece: Column, offset: Column, c: CharClass) -> Column:
    """Starts of the windows of high entropy in a piece, whose first character is at ``offset``."""
    costs = F.array(*map(_long, entropy_costs(c.window)))
    codes = F.transform(F.split(piece, "", -1), lambda ch: F.ascii(ch) - (_FIRST - 1))
    codes = F.filter(codes, lambda x: x > 0)  # no empty text after the last character

    def moves(code: Column, i: Column) -> Column:
        enter = F.struct(code.alias("slot"), F.lit(1).alias("by"),
                         F.when(i >= c.window - 1, offset + i - (c.window - 1)).alias("start"))
        leave = F.struct(F.get(codes, i - c.window).alias("slot"), F.lit(-1).alias("by"),
                         F.lit(None).cast("long").alias("start"))
        return F.when(i >= c.window, F.array(leave, enter)).otherwise(F.array(enter))

    def step(state: Column, move: Column) -> Column:
        n = F.ascii(F.substring(state["counts"], move["slot"], F.lit(1))) - ord("0")
        cost = state["cost"] + F.get(costs, n + move["by"]) - F.get(costs, n)
        return F.struct(
            F.overlay(state["counts"], F.char(n + move["by"] + ord("0")), move["slot"], F.lit(1)).alias("counts"),
            cost.alias("cost"),
            F.when(move["start"].isNotNull() & (cost <= entropy_limit(c)),
                   F.concat(state["out"], F.array(move["start"]))).otherwise(state["out"]).alias("out"))

    first = F.struct(F.lit("0" * _SLOTS).alias("counts"), _long(0).alias("cost"), _empty("bigint").alias("out"))
    return F.aggregate(F.flatten(F.transform(codes, moves)), first, step, lambda s: s["out"])


def _entropy_spans(candidate: Column, c: CharClass) -> Column:
    """start and end of the joined windows of high entropy in one candidate match."""
    cut = _found(candidate["match"], f".{{1,{_PIECE}}}")
    starts = F.flatten(F.transform(F.sequence(F.lit(0), F.size(cut) - 1), lambda i: _window_starts(
        F.concat(F.when(i > 0, F.right(F.get(cut, i - 1), F.lit(c.window - 1))).otherwise(F.lit("")), F.get(cut, i)),
        candidate["start"] + i * _PIECE - F.when(i > 0, c.window - 1).otherwise(0), c)))

    def joined(starts: Column) -> Column:
        first = F.filter(starts, lambda s, i: (i == 0) | (s > F.get(starts, i - 1) + c.window))
        last = F.filter(starts, lambda s, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) > s + c.window))
        return F.transform(first, lambda s, i: F.struct(
            s.alias("start"), (F.get(last, i) + c.window).alias("end")))

    return _let(starts, joined)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _allowed(candidate: Column) -> Column:
    known = candidate["before"].rlike(CHECKSUM_LABEL)
    for pattern in ALLOWED:
        known = known | candidate["match"].rlike(pattern)
    return known


def _span(kind: int, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))


_SPAN = "struct<start:bigint,kind:int,end:bigint>"


def _chunk_spans(chunk: Column) -> Column:
    """Base spans and entropy spans of one chunk, places counted from the text's start."""
    text, at = chunk["text"], chunk["at"]

    def of(kind: int, matches: Column) -> Column:
        return F.transform(matches, lambda m: _span(kind, at + m["start"], at + m["end"]))

    assigned = F.filter(_placed(text, chunk["assign"], ASSIGN), lambda m: F.char_length(
        F.regexp_extract(m["match"], ASSIGN, 2)) >= ASSIGN_CHARS)
    base = F.concat(of(0, assigned), of(1, _placed(text, chunk["access"], ACCESS)),
                    of(2, _placed(text, chunk["hex"], HEX)))
    more = []
    for kind, c in enumerate(CLASSES, len(BASE_KINDS)):
        found = F.filter(_placed(text, chunk[c.kind], _candidates(c)), lambda m: ~_allowed(m))
        more.append(of(kind, F.flatten(F.transform(found, lambda m: _entropy_spans(m, c)))))
    return _let(base, lambda base: F.concat(base, F.filter(F.concat(*more), lambda s: ~F.exists(
        base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))))


def _candidates(c: CharClass) -> str:
    return f"[{c.chars}]{{{c.window},}}"


def _chunks(text: Column) -> Column:
    """Parts of a text that hold a match, with their places; no match crosses two parts."""
    cut = _found(text, rf"(?s).{{{CHUNK}}}.*?{_OUTSIDE}|.+")

    def step(state: Column, part: Column) -> Column:
        one = F.struct(state["at"].alias("at"), part.alias("text"))
        return F.struct((state["at"] + F.char_length(part)).alias("at"),
                        F.concat(state["out"], F.array(one)).alias("out"))

    first = F.struct(_long(0).alias("at"), _empty("struct<at:bigint,text:string>").alias("out"))
    placed = F.when(F.char_length(text) <= CHUNK, F.array(F.struct(_long(0).alias("at"), text.alias("text")))
                    ).otherwise(F.aggregate(cut, first, step, lambda s: s["out"]))
    searched = F.transform(placed, lambda p: F.struct(
        p["at"].alias("at"), p["text"].alias("text"), _found(p["text"], ASSIGN).alias("assign"),
        p["text"].rlike(_LONG_RUN).alias("long")))
    searched = F.filter(searched, lambda p: p["long"] | (F.size(p["assign"]) > 0))

    def of_long(p: Column, pattern: str, name: str) -> Column:
        return F.when(p["long"], _found(p["text"], pattern)).otherwise(_empty("string")).alias(name)

    return F.transform(searched, lambda p: F.struct(
        p["at"].alias("at"), p["text"].alias("text"), p["assign"].alias("assign"),
        of_long(p, ACCESS, "access"), of_long(p, HEX, "hex"),
        *(of_long(p, _candidates(c), c.kind) for c in CLASSES)))


KINDS = ("assign", "access", "hex")


class CharClass(NamedTuple):
    """A candidate alphabet, its window in characters and the least entropy of a window in bits."""

    kind: str
    chars: str
    window: int
    bits: float


CLASSES = (CharClass("entropy_hex", "0-9A-Fa-f", 24, 3.0), CharClass("entropy_base64", "A-Za-z0-9+/_=-", 24, 4.0))

#: Candidates that match are no secrets.  Fixed list.
ALLOWED = (
    "^[0-9]+$",                                               # decimal numbers
    "^[A-Z]?[a-z]+$", "^[A-Z]+$",                             # words
    "^[A-Za-z]*[a-z]+([A-Z][a-z]+)+$",                        # joined words
    "^([A-Za-z]+|[0-9]{1,4})([-_/=+]+([A-Za-z]+|[0-9]{1,4}))*[-_/=+]*$",  # slugs, paths, constant names
    "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",   # UUIDs
    "(?i)abcdefgh|01234567|89abcdef|example|placeholder|xxxxxx",
)
#: What may stand directly before a candidate that is a public checksum.  Fixed list.
CHECKSUM_LABEL = r"(?i)(sha-?[0-9]{1,3}|md5|crc-?[0-9]*|checksum|digest|etag|commit|integrity)[\"']?\x20*[:=-]?\x20*[\"']?\z"
LABEL_CHARS = 32

# a character outside all patterns, candidates and labels
_OUTSIDE = r"[^A-Za-z0-9+/_.=:\"'\x20-]"
CHUNK = 16_384
# without such a run a text has no access key id, hexadecimal run or candidate
_LONG_RUN = "[A-Za-z0-9+/_=-]{20}"
_PIECE = 256       # windows of a candidate handled with one state
_UNIT = 1 << 20
_FIRST = ord("+")  # slot 1 of the counts; 'z' is the last
_SLOTS = ord("z") - _FIRST + 1


def entropy_costs(window: int) -> list[int]:
    """n log2 n in units of 2^-20 bit for n = 0 .. window."""
    return [round(n * math.log2(n) * _UNIT) if n else 0 for n in range(window + 1)]


def entropy_limit(c: CharClass) -> int:
    """A window has ``bits`` of entropy or more if its costs add up to at most this."""
    return math.floor((math.log2(c.window) - c.bits) * c.window * _UNIT)


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _empty(of: str) -> Column:
    return F.array().cast(f"array<{of}>")


_MATCH = "struct<start:bigint,end:bigint,match:string,before:string>"


def _placed(text: Column, found: Column, pattern: str) -> Column:
    """start, end, match and what stands before it, for the matches found in a text.

    The text between the matches gives their places.
    """
    between = F.split(text, pattern, -1)

    def step(state: Column, i: Column) -> Column:
        match, gap = found[i], F.element_at(state["between"], i + 1)
        start = state["at"] + F.char_length(gap)
        end = start + F.char_length(match)
        one = F.struct(start.alias("start"), end.alias("end"), match.alias("match"),
                       F.right(gap, F.lit(LABEL_CHARS)).alias("before"))
        return F.struct(end.alias("at"), state["between"].alias("between"),
                        F.concat(state["out"], F.array(one)).alias("out"))

    first = F.struct(_long(0).alias("at"), between.alias("between"), _empty(_MATCH).alias("out"))
    placed = F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), first, step, lambda s: s["out"])
    return F.when(F.size(found) > 0, placed).otherwise(_empty(_MATCH))


def _window_starts(piece: Column, offset: Column, c: CharClass) -> Column:
    """Starts of the windows of high entropy in a piece, whose first character is at ``offset``."""
    costs = F.array(*map(_long, entropy_costs(c.window)))
    codes = F.transform(F.split(piece, "", -1), lambda ch: F.ascii(ch) - (_FIRST - 1))
    codes = F.filter(codes, lambda x: x > 0)  # no empty text after the last character

    def moves(code: Column, i: Column) -> Column:
        enter = F.struct(code.alias("slot"), F.lit(1).alias("by"),
                         F.when(i >= c.window - 1, offset + i - (c.window - 1)).alias("start"))
        leave = F.struct(F.get(codes, i - c.window).alias("slot"), F.lit(-1).alias("by"),
                         F.lit(None).cast("long").alias("start"))
        return F.when(i >= c.window, F.array(leave, enter)).otherwise(F.array(enter))

    def step(state: Column, move: Column) -> Column:
        n = F.ascii(F.substring(state["counts"], move["slot"], F.lit(1))) - ord("0")
        cost = state["cost"] + F.get(costs, n + move["by"]) - F.get(costs, n)
        return F.struct(
            F.overlay(state["counts"], F.char(n + move["by"] + ord("0")), move["slot"], F.lit(1)).alias("counts"),
            cost.alias("cost"),
            F.when(move["start"].isNotNull() & (cost <= entropy_limit(c)),
                   F.concat(state["out"], F.array(move["start"]))).otherwise(state["out"]).alias("out"))

    first = F.struct(F.lit("0" * _SLOTS).alias("counts"), _long(0).alias("cost"), _empty("bigint").alias("out"))
    return F.aggregate(F.flatten(F.transform(codes, moves)), first, step, lambda s: s["out"])


def _entropy_spans(candidate: Column, c: CharClass) -> Column:
    """start and end of the joined windows of high entropy in one candidate match."""
    cut = _found(candidate["match"], f".{{1,{_PIECE}}}")
    starts = F.flatten(F.transform(F.sequence(F.lit(0), F.size(cut) - 1), lambda i: _window_starts(
        F.concat(F.when(i > 0, F.right(F.get(cut, i - 1), F.lit(c.window - 1))).otherwise(F.lit("")), F.get(cut, i)),
        candidate["start"] + i * _PIECE - F.when(i > 0, c.window - 1).otherwise(0), c)))

    def joined(starts: Column) -> Column:
        first = F.filter(starts, lambda s, i: (i == 0) | (s > F.get(starts, i - 1) + c.window))
        last = F.filter(starts, lambda s, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) > s + c.window))
        return F.transform(first, lambda s, i: F.struct(
            s.alias("start"), (F.get(last, i) + c.window).alias("end")))

    return _let(starts, joined)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _allowed(candidate: Column) -> Column:
    known = candidate["before"].rlike(CHECKSUM_LABEL)
    for pattern in ALLOWED:
        known = known | candidate["match"].rlike(pattern)
    return known


def _span(kind: int, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))


_SPAN = "struct<start:bigint,kind:int,end:bigint>"


def _chunk_spans(chunk: Column) -> Column:
    """Base spans and entropy spans of one chunk, places counted from the text's start."""
    text, at = chunk["text"], chunk["at"]

    def of(kind: int, matches: Column) -> Column:
        return F.transform(matches, lambda m: _span(kind, at + m["start"], at + m["end"]))

    assigned = F.filter(_placed(text, chunk["assign"], ASSIGN), lambda m: F.char_length(
        F.regexp_extract(m["match"], ASSIGN, 2)) >= ASSIGN_CHARS)
    base = F.concat(of(0, assigned), of(1, _placed(text, chunk["access"], ACCESS)),
                    of(2, _placed(text, chunk["hex"], HEX)))
    more = []
    for kind, c in enumerate(CLASSES, len(BASE_KINDS)):
        found = F.filter(_placed(text, chunk[c.kind], _candidates(c)), lambda m: ~_allowed(m))
        more.append(of(kind, F.flatten(F.transform(found, lambda m: _entropy_spans(m, c)))))
    return _let(base, lambda base: F.concat(base, F.filter(F.concat(*more), lambda s: ~F.exists(
        base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))))


def _candidates(c: CharClass) -> str:
    return f"[{c.chars}]{{{c.window},}}"


def _chunks(text: Column) -> Column:
    """Parts of a text that hold a match, with their places; no match crosses two parts."""
    cut = _found(text, rf"(?s).{{{CHUNK}}}.*?{_OUTSIDE}|.+")

    def step(state: Column, part: Column) -> Column:
        one = F.struct(state["at"].alias("at"), part.alias("text"))
        return F.struct((state["at"] + F.char_length(part)).alias("at"),
                        F.concat(state["out"], F.array(one)).alias("out"))

    first = F.struct(_long(0).alias("at"), _empty("struct<at:bigint,text:string>").alias("out"))
    placed = F.when(F.char_length(text) <= CHUNK, F.array(F.struct(_long(0).alias("at"), text.alias("text")))
                    ).otherwise(F.aggregate(cut, first, step, lambda s: s["out"]))
    found = F.transform(placed, lambda p: F.struct(
        p["at"].alias("at"), p["text"].alias("text"), _found(p["text"], ASSIGN).alias("assign"),
        _found(p["text"], ACCESS).alias("access"), _found(p["text"], HEX).alias("hex"),
        *(_found(p["text"], _candidates(c)).alias(c.kind) for c in CLASSES)))
    kinds = ("assign", "access", "hex", *(c.kind for c in CLASSES))
    return F.filter(found, lambda p: sum((F.size(p[k]) for k in kinds), F.lit(0)) > 0)


KINDS = (*BASE_KINDS, *(c.kind for c in CLASSES))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and spans: array of (start, kind, end, match), by start, then kind as in ``KINDS``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = F.array_sort(F.flatten(F.transform(_chunks(F.col("text")), _chunk_spans)))
    names = F.array(*map(F.lit, KINDS))
    return rows.select("doc_id", "text", spans.cast(f"array<{_SPAN}>").alias("spans")).select(
        "doc_id", "text", F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), F.get(names, s["kind"]).alias("kind"), s["end"].alias("end"),
            F.substring("text", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).alias("match"),
        )).alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """Counts, a digest of the fixed patterns' spans and all spans as text, for each row."""
    def text_of(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *(F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
                    for k in BASE_KINDS),
        F.sha2(text_of(F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))), 256).alias("base_sha256"),
        text_of(F.col("spans")).alias("spans"))
