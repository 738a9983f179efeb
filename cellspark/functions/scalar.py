"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds as a double, exact to the microsecond."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(float(MICROS))


def half_even(x: Column, digits: int = 0) -> Column:
    """Round half to even at ``digits`` decimals (Spark's ``round`` is half-up)."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def clip(x: Column, low, high) -> Column:
    """``x`` limited to ``[low, high]``; null stays null."""
    low, high = (v if isinstance(v, Column) else F.lit(float(v)) for v in (low, high))
    return F.when(x.isNotNull(), F.greatest(F.least(x, high), low))


def has(name: Column, part: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(name).contains(part.lower())


def blank_to_null(col: Column, kind: str) -> Column:
    """Null out the values an upsert treats as "no value": NaN, empty arrays and blank strings."""
    if kind.startswith("array"):
        return F.when(F.size(col) > 0, col)
    if kind == "string":
        return F.when(F.trim(F.regexp_replace(col, r"\s+", " ")) != "", col)
    if kind in ("double", "float"):
        return F.nanvl(col, F.lit(None).cast(kind))
    return col
