"""Epoch decoding, date keys and interval buckets. All timestamps are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def from_seconds(col: Column | str) -> Column:
    return F.timestamp_seconds(_c(col))


def from_millis(col: Column | str) -> Column:
    return F.timestamp_millis(_c(col))


def from_digits(col: Column | str) -> Column:
    """``yyyyMMddHHmmss`` text to timestamp; NULL stays NULL.

    Text that does not parse also gives NULL here; `quality.string_dates` reports it.
    """
    return F.try_to_timestamp(_c(col), F.lit("yyyyMMddHHmmss"))


def seconds(col: Column | str) -> Column:
    """Whole epoch seconds, rounded down."""
    return F.unix_seconds(_c(col))


def day(col: Column | str) -> Column:
    return F.to_date(_c(col))


def date_key(col: Column | str) -> Column:
    """``yyyymmdd`` integer of a date or timestamp, by arithmetic rather than text."""
    d = F.to_date(_c(col))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long")


def key_to_date(col: Column | str) -> Column:
    k = _c(col)
    return F.make_date(
        F.floor(k / 10000).cast("int"), F.floor(k / 100).cast("int") % 100, (k % 100).cast("int")
    )


def month_start(col: Column | str) -> Column:
    return F.trunc(_c(col), "MM")


def month_of_text(col: Column | str) -> Column:
    """First of month for a ``yyyy-MM`` text."""
    return F.to_date(_c(col), "yyyy-MM")


def bucket(col: Column | str, width: int) -> Column:
    """Start of the ``width``-second interval holding the timestamp."""
    s = seconds(col)
    return F.timestamp_seconds(s - F.pmod(s, F.lit(width)))


def on_day(col: Column | str, run_date) -> Column:
    """``date(ts) = run_date`` written as a range on the bare column, so it is pushed down."""
    start = F.lit(run_date).cast("date").cast("timestamp")
    return (_c(col) >= start) & (_c(col) < start + F.expr("INTERVAL 1 DAY"))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
