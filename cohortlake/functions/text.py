"""Text normalisation (X5), birth-date coarsening (X15), size text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_lower(col) -> Column:
    """Strip whitespace of any kind at both ends, lower-case.
    (``F.trim`` removes only spaces.)"""
    return F.lower(F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", ""))


def birth_year_only(col) -> Column:
    """X15 on ``YYYYMMDD`` text: non-empty -> year + ``0101``; empty or NULL unchanged."""
    c = _c(col)
    return F.when(F.length(c) > 0, F.concat(F.substring(c, 1, 4), F.lit("0101"))).otherwise(c)


def birth_year_only_date(col) -> Column:
    """X15 on a DateType column."""
    return F.trunc(_c(col), "year")


# Binary unit multipliers of the size text.
SIZE_UNITS = {"K": 1024, "M": 1024 ** 2, "G": 1024 ** 3, "T": 1024 ** 4}


def size_to_bytes(col) -> Column:
    """``1.5G`` -> 1 GiB (the fraction is dropped), ``4.0K`` -> 4096,
    ``512`` -> 512.  Unparseable text -> NULL."""
    c = _c(col)
    whole = F.regexp_extract(c, r"^([0-9]+)(\.[0-9]*)?[KMGT]?$", 1)
    unit = F.regexp_extract(c, r"([KMGT])$", 1)
    mult = F.lit(1).cast("long")
    for u, m in SIZE_UNITS.items():
        mult = F.when(unit == u, F.lit(m).cast("long")).otherwise(mult)
    num = F.nullif(whole, F.lit("")).try_cast("long")
    return num * mult
