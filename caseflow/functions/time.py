"""Timestamp parsing, durations and date keys; none depends on the session time zone."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.schemas import BUCKETS, HOURS

# Fixed patterns: ISO-8601 date, optionally a time, a fraction and an offset.
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def ntz(moment: datetime) -> Column:
    """A ``timestamp_ntz`` literal; a plain literal would pass through the session zone."""
    return F.lit(moment.isoformat()).cast("timestamp_ntz")


def parse_timestamp(col: Column, formats: Sequence[str] = ()) -> Column:
    """ISO text to ``timestamp_ntz``, else the first of ``formats`` that reads it; anything else is NULL, never an error.

    The pattern keeps out what a plain cast would also take, such as a bare year.
    """
    iso = F.when(col.rlike(ISO_TIMESTAMP), col.try_cast("timestamp_ntz"))
    return F.coalesce(iso, *[parse_timestamp_as(col, f) for f in formats]) if formats else iso


# Parts of a declared format, and the text that each stands for.
_PARTS = {"yyyy": r"\d{4}", "MMM": r"[A-Za-z]{3}", "MM": r"\d{1,2}", "dd": r"\d{1,2}", "HH": r"\d{1,2}", "mm": r"\d{2}", "ss": r"\d{2}"}
_PART = re.compile("|".join(_PARTS))
_MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"


def parse_timestamp_as(col: Column, form: str) -> Column:
    """Text in a format of yyyy, MM or MMM, dd, HH, mm and ss (time parts may be absent) to ``timestamp_ntz``.

    The parts are put together as ISO text, so no session time zone has a say; what does not fit is NULL.
    """
    parts = _PART.findall(form)
    if len(set(parts)) < len(parts) or not {"yyyy", "dd"} < set(parts) or len({"MM", "MMM"} & set(parts)) != 1:
        raise ValueError(f"{form!r} is no format of a moment")
    between = _PART.split(form)
    pattern = "^" + "".join(
        re.escape(text) + (f"({_PARTS[part]})" if part else "") for text, part in zip(between, [*parts, ""], strict=True)
    ) + "$"

    def part(name: str) -> Column:
        if name not in parts:
            return F.lit("00")
        return F.lpad(F.regexp_extract(col, pattern, parts.index(name) + 1), len(name), "0")

    month = part("MM")
    if "MMM" in parts:
        at = F.position(F.upper(part("MMM")), F.lit(_MONTHS))
        month = F.when(at % 3 == 1, F.lpad(((at + 2) / 3).cast("int").cast("string"), 2, "0"))
    day = F.concat_ws("-", part("yyyy"), month, part("dd"))
    time = F.concat_ws(":", part("HH"), part("mm"), part("ss"))
    return F.when(col.rlike(pattern), F.concat(day, F.lit(" "), time).try_cast("timestamp_ntz"))


def vote_formats(rows: DataFrame, columns: Sequence[str], formats: Sequence[str]) -> list[str]:
    """``formats`` with the one first that reads most values of ``columns``; of equals, the one declared first.

    One pass, one row to the driver. A feed that writes days before months is told from one that does not by
    its days after the 12th.
    """
    if len(formats) < 2:
        return list(formats)
    reads = [sum((F.count(parse_timestamp_as(F.col(c), f)) for c in columns), F.lit(0)) for f in formats]
    votes = rows.agg(*[n.alias(f"f{i}") for i, n in enumerate(reads)]).first()
    best = max(range(len(formats)), key=lambda i: (votes[i], -i))
    return [formats[best], *(f for i, f in enumerate(formats) if i != best)]


def parse_date(col: Column) -> Column:
    """``yyyy-MM-dd`` text to date; anything else (also Feb 30) is NULL."""
    return F.when(col.rlike(ISO_DATE), col.try_cast("date"))


def _second_number(ts: Column) -> Column:
    days = F.unix_date(ts.cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end`` (fractions are cut first)."""
    return _second_number(end) - _second_number(start)


def hours_between(start: Column, end: Column) -> Column:
    """Unrounded hours as an exact decimal."""
    return seconds_between(start, end).cast("decimal(18,0)") / F.lit(3600).cast("decimal(4,0)")


def rounded_hours(hours: Column) -> Column:
    """Stored hours: two decimals, half away from zero."""
    return F.round(hours, 2).cast(HOURS)


def duration_bucket(hours: Column) -> Column:
    """Label of the half-open bucket that holds the unrounded ``hours``; NULL stays NULL."""
    label = F.when(hours.isNull(), F.lit(None).cast("string"))
    for name, upper in BUCKETS:
        label = label.otherwise(F.lit(name)) if upper is None else label.when(hours < upper, name)
    return label


def date_key(col: Column) -> Column:
    """Integer ``yyyymmdd`` of a date or timestamp; NULL passes through."""
    d = col.cast("date")
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def key_date(key: Column) -> Column:
    """The date of an integer ``yyyymmdd`` key."""
    return F.make_date(
        F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100
    )


def iso_text(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` text of a ``timestamp_ntz``."""
    return F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
