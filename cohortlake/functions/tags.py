"""Header-element selection predicates."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_TAG_TEXT = re.compile(r"^\(\s*([0-9A-Fa-f]{4})\s*,\s*([0-9A-Fa-f]{4})\s*\)$")


def normalise_tag_text(text: str) -> str:
    """``(0010, 0020)`` / ``(0010,0020)`` / lower-case hex -> ``(0010,0020)``."""
    m = _TAG_TEXT.match(text.strip())
    if not m:
        return text
    return f"({m.group(1).upper()},{m.group(2).upper()})"


def tag_column_normalised(col) -> Column:
    """The same normalisation on a column of tag text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.upper(F.regexp_replace(c, r"\s+", ""))


def split_tag_list(tag_list: Iterable[str] | None) -> tuple[list[str], list[str]]:
    """Keywords and normalised tag texts of a tag file's list."""
    keywords, tags = [], []
    for t in tag_list or []:
        t = str(t)
        if _TAG_TEXT.match(t.strip()):
            tags.append(normalise_tag_text(t))
        else:
            keywords.append(t)
    return keywords, tags


def tag_matches(tag_list: Iterable[str] | None, all_tags: bool = False,
                keyword_col: str = "keyword", tag_col: str = "tag") -> Column:
    """Every element when ``all_tags``; else keyword or tag text in the
    list.  An empty list matches nothing.  A child element is tested on its own."""
    if all_tags:
        return F.lit(True)
    keywords, tags = split_tag_list(tag_list)
    cond = F.lit(False)
    if keywords:
        cond = cond | F.col(keyword_col).isin(keywords)
    if tags:
        cond = cond | tag_column_normalised(tag_col).isin(tags)
    return F.coalesce(cond, F.lit(False))


def tag_matches_top_level(tag_list: Iterable[str] | None, all_tags: bool = False) -> Column:
    """X12, and not a sequence, and at the top level."""
    return tag_matches(tag_list, all_tags) & (F.col("vr") != "SQ") & (F.col("depth") == 0)
