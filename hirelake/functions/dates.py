"""Date expressions: tolerant parsing, month buckets, recency cutoffs."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F

from hirelake.functions.text import col_of, trim_ws

# ISO-8601 date or date-time, optional fraction and offset; nothing after it.
ISO_DATETIME = (r"^\d{4}-\d{2}-\d{2}"
                r"(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?(?:Z|[+-]\d{2}:?\d{2})?)?$")

GENERAL_DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "M/d/yyyy", "dd-MMM-yyyy",
                        "MMM d, yyyy", "MMMM d, yyyy", "yyyyMMdd", "yyyy-M-d", "yyyy/M/d", "d MMM yyyy",
                        "d MMMM yyyy", "MMM d yyyy", "MMMM d yyyy")
# A time of day (and zone) after the date is read and dropped.
TIME_TAIL = r"(?i)[ T,]+\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s*([AP]\.?M\.?)?\s*(Z|UTC|GMT|[+-]\d{2}:?\d{2})?$"


def as_date_literal(d) -> Column:
    if isinstance(d, Column):
        return d.cast("date")
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return F.lit(str(d)).cast("date")


def today_utc() -> _dt.date:
    return _dt.datetime.now(_dt.timezone.utc).date()


def parse_iso_date(c) -> Column:
    """ISO text -> the calendar date as written (no shift for a UTC offset).
    Anything else -> NULL."""
    t = trim_ws(c.cast("string") if isinstance(c, Column) else col_of(c))
    return F.when(t.rlike(ISO_DATETIME), F.substring(t, 1, 10).try_cast("date"))


def parse_date_general(c, epoch_unit: str | None = None) -> Column:
    """Lenient text -> date: ISO first, then a list of common layouts.

    Numbers are epoch values only when ``epoch_unit`` ('s', 'ms', 'us' or 'ns')
    is given; by default they give NULL.
    """
    c = col_of(c)
    t = trim_ws(c.cast("string"))
    day = F.regexp_replace(t, TIME_TAIL, "")
    parsed = [parse_iso_date(t)] + [F.try_to_date(day, f) for f in GENERAL_DATE_FORMATS]
    if epoch_unit:
        div = {"s": 1, "ms": 1000, "us": 1_000_000, "ns": 1_000_000_000}[epoch_unit]
        num = F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))
        seconds = F.floor(num / F.lit(div))
        # years 1 to 9999; a number beyond them is no date
        parsed.append(F.to_date(F.timestamp_seconds(F.when(seconds.between(-62135596800, 253402300799), seconds))))
    return F.coalesce(*parsed)


def month_start(c) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(col_of(c), "MM")


def months_back_start(as_of, months: int) -> Column:
    """First day of the month ``months`` before the month of ``as_of``."""
    return F.add_months(F.trunc(as_date_literal(as_of), "MM"), -int(months))


def cutoff(as_of, days: int) -> Column:
    return F.date_sub(as_date_literal(as_of), int(days))
