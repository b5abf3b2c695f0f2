"""Date parsing and weekday labels (FN-6, FN-7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import trim_controls

# Weekday labels, Monday first. The default set spells Thursday
# "THR"; the alternative set uses the upper-cased US short names.
WEEKDAY_LABELS = ("MON", "TUE", "WED", "THR", "FRI", "SAT", "SUN")
WEEKDAY_LABELS_US = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")

# Fixed value: month/day/year with one or two digit month and day.
MDY = "M/d/yyyy"


def parse_date(s: str | Column, fmt: str = MDY, strict: bool = True) -> Column:
    """String -> date. ``strict`` raises on a bad date, otherwise gives null."""
    c = trim_controls(F.col(s) if isinstance(s, str) else s)
    if strict:
        return F.to_date(c, fmt)
    return F.try_to_date(c, fmt)


def weekday_label(d: str | Column, labels: tuple[str, ...] = WEEKDAY_LABELS) -> Column:
    """Label of the weekday of a date or timestamp, Monday = ``labels[0]``."""
    if len(labels) != 7:
        raise ValueError("need seven weekday labels, Monday first")
    c = F.col(d) if isinstance(d, str) else d
    return F.element_at(F.array(*[F.lit(x) for x in labels]), F.weekday(c) + 1)
