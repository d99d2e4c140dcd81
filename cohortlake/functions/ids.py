"""Subject and session identifiers (X1-X4, X8) as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source tool's for equal results.
ENTITY_PATTERN = r"(sub-[A-Z0-9]+)_(ses-[A-Za-z][0-9]+)"
PTID_FROM_SUBJECT = r"^sub-ADNI([0-9]{3})([A-Za-z])([0-9]{4})\z"
PTID_TO_SUBJECT = r"([0-9]+)_(S)_([0-9]+)"
VALID_DX = ["cn", "mci", "dementia"]
VALID_SUFFIXES = ["T1w", "pet", "dwi"]
DEFAULT_PHASES = ["ADNI3"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def extract_entities(col, strict: bool = False) -> tuple[Column, Column]:
    """(subject, session) from a BIDS file name.

    Lenient (default): first match anywhere, NULL when absent.
    Strict: the name must start with the pattern, else the query fails."""
    c = _c(col)
    pat = ("^" + ENTITY_PATTERN) if strict else ENTITY_PATTERN
    sub = F.regexp_extract(c, pat, 1)
    ses = F.regexp_extract(c, pat, 2)
    if strict:
        ok = c.rlike(pat)
        err = F.raise_error(F.concat(F.lit("no subject/session entity in file name: "),
                                     F.coalesce(c, F.lit("NULL"))))
        return (F.when(ok, sub).otherwise(err), F.when(ok, ses).otherwise(err))
    return (F.nullif(sub, F.lit("")), F.nullif(ses, F.lit("")))


def to_ptid(col) -> Column:
    """``sub-ADNI002S0413`` -> ``002_S_0413``; other values unchanged."""
    return F.regexp_replace(_c(col), PTID_FROM_SUBJECT, "$1_$2_$3")


def to_subject(col) -> Column:
    """Every ``<digits>_S_<digits>`` -> ``sub-ADNI<digits>S<digits>``."""
    return F.regexp_replace(_c(col), PTID_TO_SUBJECT, "sub-ADNI$1$2$3")


def visit_to_session(col) -> Column:
    """``bl`` -> ``ses-M000``; else ``ses-M`` + code without one leading
    ``m``, left-padded to 3 (never truncated).  NULL stays NULL."""
    c = _c(col)
    x = F.regexp_replace(c, "^m", "")
    padded = F.when(F.length(x) >= 3, x).otherwise(F.lpad(x, 3, "0"))
    return F.when(c == "bl", F.lit("ses-M000")).otherwise(F.concat(F.lit("ses-M"), padded))


def valid_dx(col, valid: Iterable[str] = VALID_DX) -> Column:
    """Membership in the valid diagnoses (NULL for NULL input)."""
    return _c(col).isin(list(valid))
