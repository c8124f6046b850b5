"""Filename glob -> case-insensitive LIKE pattern (FLT-7, STR-5, STR-6).

Only ``*`` is a wildcard. ``%``, ``_`` and the escape character ``#`` are literal. Without any
``*`` the pattern is a contains-search; with one it is anchored at both ends.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import col_of

ESCAPE = "#"


def escape_like(text: str) -> str:
    """Escape LIKE metacharacters with ``#`` (driver-side literal form of STR-6)."""
    out = []
    for ch in text:
        if ch in ("%", "_", ESCAPE):
            out.append(ESCAPE)
        out.append(ch)
    return "".join(out)


def glob_to_ilike(glob: str) -> str:
    """Pattern for ``ILIKE ... ESCAPE '#'``."""
    if glob == "":
        return "%"
    if "*" not in glob:
        return "%" + escape_like(glob) + "%"
    return "".join("%" if ch == "*" else escape_like(ch) for ch in glob)


def escape_like_col(c: str | Column) -> Column:
    """Column form of STR-6, for patterns that arrive as data."""
    return F.regexp_replace(col_of(c), r"([%_#])", r"#$1")


def glob_to_ilike_col(c: str | Column) -> Column:
    """Column form of ``glob_to_ilike`` (patterns held in a DataFrame)."""
    g = col_of(c)
    anchored = F.replace(escape_like_col(g), F.lit("*"), F.lit("%"))
    return (
        F.when(g == "", F.lit("%"))
        .when(~g.contains("*"), F.concat(F.lit("%"), escape_like_col(g), F.lit("%")))
        .otherwise(anchored)
    )


def matches_glob(c: str | Column, glob: str) -> Column:
    """``c ILIKE glob_to_ilike(glob) ESCAPE '#'``."""
    return F.ilike(col_of(c), F.lit(glob_to_ilike(glob)), F.lit(ESCAPE))
