"""Month keys ``MMYYYY``, date helpers and reading by declared patterns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


# a text that starts with a year, which is read alike everywhere
_ISO = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def to_day(col) -> Column:
    """Date of a timestamp (``as_date``)."""
    return F.to_date(_c(col))


def month_key(col) -> Column:
    """Zero-padded month followed by the year: ``MMyyyy``."""
    return F.date_format(_c(col), "MMyyyy")


def month_key_start(key: str) -> dt.date:
    """First day of a ``MMYYYY`` key (``dmy('01' + key)``)."""
    return dt.date(int(key[2:]), int(key[:2]), 1)


def month_bounds(keys: list[str]) -> tuple[dt.date, dt.date]:
    """[first day of earliest key, first day after the latest key).

    Keys are ordered by time here, not by text (``MMYYYY`` does not sort).
    """
    starts = sorted(month_key_start(k) for k in keys)
    last = starts[-1]
    nxt = dt.date(last.year + (last.month == 12), last.month % 12 + 1, 1)
    return starts[0], nxt


def month_key_to_date(col) -> Column:
    """Parse a ``MMYYYY`` text key to the first day of that month."""
    return F.to_date(F.concat(F.lit("01"), _c(col)), "ddMMyyyy")


def read_by_patterns(col, data_type: str, patterns) -> tuple[Column, Column]:
    """A date or timestamp from text, and whether the declared patterns disagree on it.

    ISO text (year first) counts always; then each of ``patterns`` is tried in
    order and the first reading is the value.  Every pattern has to fit the whole
    trimmed text.  A text that two patterns read as different values, such as
    ``3/4/2022`` where day-first and month-first are both declared, is ambiguous;
    one that no pattern reads is NULL.  NULL stays NULL and is not ambiguous.
    """
    text = F.trim(_c(col).cast("string"))
    readings = [F.when(text.rlike(_ISO), text.try_cast(data_type)),
                *[F.try_to_timestamp(text, F.lit(p)).cast(data_type) for p in patterns]]
    found = F.array_distinct(F.array_compact(F.array(*readings)))
    return F.get(found, F.lit(0)), F.size(found) > 1
