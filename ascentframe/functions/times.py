"""Timestamps and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_timestamp(text: Column) -> Column:
    """Timestamp of a text in the usual ISO shapes, else NULL."""
    text = F.trim(text)
    compact = F.try_to_timestamp(F.when(text.rlike(r"^\d{8}T\d{6}$"), text), F.lit("yyyyMMdd'T'HHmmss"))
    day = F.try_to_timestamp(F.when(text.rlike(r"^\d{8}$"), text), F.lit("yyyyMMdd"))
    return F.coalesce(compact, day, F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp")))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_text(epoch: Column) -> Column:
    return F.from_unixtime(epoch, "yyyy-MM-dd HH:mm:ss")


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "month")


def month_end(ts: Column) -> Column:
    """First day of the following month."""
    return F.add_months(F.trunc(ts, "month"), 1)


def in_month_range(ts: Column, start_year: int | None, end_year: int | None) -> Column:
    """Half-open test against whole years; either end may be open."""
    keep = F.lit(True)
    if start_year is not None:
        keep = keep & (ts >= F.to_timestamp(F.lit(f"{start_year:04d}-01-01")))
    if end_year is not None:
        keep = keep & (ts < F.to_timestamp(F.lit(f"{end_year + 1:04d}-01-01")))
    return keep
