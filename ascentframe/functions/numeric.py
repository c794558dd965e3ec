"""Numeric clean-up, two-dialect coalescing and storage encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ascentframe import contracts as C


def missing_to_null(value: Column, fill=None) -> Column:
    """NaN, and the fill value if given, become NULL."""
    value = F.when(~F.isnan(value), value)
    return value if fill is None else F.nullif(value, F.lit(fill))


def flush_tiny(value: Column) -> Column:
    """Magnitudes below the smallest normal 4-byte float become 0."""
    tiny = (F.abs(value) < C.FLOAT4_MIN_NORMAL) & (value != 0)
    return F.when(tiny, F.lit(0.0)).otherwise(value)


def either_number(available: Sequence[str], old: str | None, new: str | None, scale=None) -> Column:
    """Value of the old-dialect column, else of the new one, else NULL.

    ``scale`` maps a column name to (factor, offset), applied before the choice.
    """
    parts = []
    for name in dict.fromkeys((old, new)):
        if name and name in available:
            factor, offset = (scale or {}).get(name, (1.0, 0.0))
            text = f"nanvl(try_cast(`{name}` AS double), NULL)"
            if (factor, offset) != (1.0, 0.0):
                text = f"({text} * {factor!r}D + {offset!r}D)"
            parts.append(text)
    return F.expr(f"coalesce({', '.join(parts)})" if parts else "CAST(NULL AS double)")


def either_text(available: Sequence[str], old: str, new: str) -> Column:
    parts = [F.col(f"`{name}`").cast("string") for name in (old, new) if name in available]
    return F.coalesce(*parts, F.lit(""))


def encoded(value: Column, kind: str) -> Column:
    """Storage form of one long-table column: NULL becomes the kind's sentinel."""
    if kind == "int64":
        return F.coalesce(value.cast("long"), F.lit(C.INT64_MISSING).cast("long"))
    if kind == "float32":
        return F.coalesce(value.cast("float"), F.lit(float("nan")).cast("float"))
    if kind == "uint8":
        return F.coalesce(value.cast("short"), F.lit(C.UINT8_MISSING).cast("short"))
    if kind == "uint16":
        return F.coalesce(value.cast("int"), F.lit(C.UINT16_MISSING))
    if kind == "int16":
        return value.cast("short")
    if kind == "int32":
        return F.coalesce(value.cast("int"), F.lit(C.INT32_MISSING))
    if kind == "text":
        return F.coalesce(value.cast("string"), F.lit(""))
    raise ValueError(f"unknown storage kind {kind}")
