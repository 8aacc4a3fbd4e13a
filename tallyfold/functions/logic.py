"""Predicates and conditionals with the reference's missing-value rules.

* list / regex tests treat a missing input as "no match" (C8 / F3 / F4);
* the two-branch conditional returns missing when its test is missing (C9);
* text to number never raises (C11).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def in_list(col, values: Iterable) -> Column:
    """Membership that is False, not NULL, for a missing input."""
    return F.coalesce(_c(col).isin(list(values)), F.lit(False))


def matches(col, pattern: str) -> Column:
    """Case-sensitive regex search; missing input gives False."""
    return F.coalesce(_c(col).rlike(pattern), F.lit(False))


def if_else(cond: Column, yes, no) -> Column:
    """Two-branch conditional: missing condition gives a missing result."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond, yes).when(~cond, no)


def first_match(rules: list[tuple[Column, object]], default=None) -> Column:
    """Ordered rules, first true condition wins; NULL condition counts as false."""
    out = None
    for cond, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        cond = F.coalesce(cond, F.lit(False))
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def presence_flag(col) -> Column:
    """1.0 when present, 0.0 when missing."""
    return _c(col).isNotNull().cast("double")


def to_number(col) -> Column:
    """Text to double; unparsable text gives NULL instead of an error."""
    return _c(col).try_cast("double")
