"""File names and paths as column expressions (PRJ-1/2, FLT-22, STR-3/4/8/9, SNK-3, SNK-8, HASH-1).

Names look like ``CCSSYYMM[P].dbc``: catalog, state, two-digit year, month and an optional
one-letter part. Parsing is a chain of ``regexp_extract``/``substring`` and an ordered ``when``
for the first error, so it stays inside whole-stage codegen (no UDF). Letters are ASCII only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import col_of

DATA_EXT = ".dbc"

# Parse error kinds, in the order the checks run.
PARSE_ERRORS = ["extension", "length", "segment", "catalog", "state", "year", "month", "month_range"]


def extension(name: str | Column) -> Column:
    """STR-9: suffix from the last dot of the last path element ('' when there is none)."""
    return F.regexp_extract(col_of(name), r"(\.[^./]*)$", 1)


def base_name(name: str | Column) -> Column:
    """STR-9: name without its extension."""
    n = col_of(name)
    return F.left(n, F.length(n) - F.length(extension(n)))


def has_data_extension(name: str | Column) -> Column:
    """FLT-22: extension ``.dbc`` in any case."""
    return F.lower(extension(name)) == DATA_EXT


def expand_year(yy: Column, as_of_year: int) -> Column:
    """PRJ-2: two-digit year <= as_of_year % 100 -> 20yy, else 19yy."""
    return F.when(yy <= F.lit(as_of_year % 100), F.lit(2000) + yy).otherwise(F.lit(1900) + yy)


def parse_filename(name: str | Column, as_of_year: int) -> Column:
    """PRJ-1: struct(catalog, state, year, month, segment, error).

    ``error`` is the first failing check (see ``PARSE_ERRORS``) or NULL; the other fields are
    NULL when there is an error. Length is measured in bytes.
    """
    n = col_of(name)
    ext = extension(n)
    base = F.upper(base_name(n))
    blen = F.octet_length(base)
    last = F.substring(base, 9, 1)
    core = F.left(base, F.lit(8))
    cat = F.substring(core, 1, 2)
    st = F.substring(core, 3, 2)
    yy = F.substring(core, 5, 2)
    mm = F.substring(core, 7, 2)
    mm_int = mm.try_cast("int")
    error = (
        F.when(F.lower(ext) != DATA_EXT, F.lit("extension"))
        .when(~blen.isin(8, 9), F.lit("length"))
        .when((blen == 9) & ~last.rlike("^[A-Za-z]$"), F.lit("segment"))
        .when(~cat.rlike("^[A-Z]{2}$"), F.lit("catalog"))
        .when(~st.rlike("^[A-Z]{2}$"), F.lit("state"))
        .when(~yy.rlike("^[0-9]{2}$"), F.lit("year"))
        .when(~mm.rlike("^[0-9]{2}$"), F.lit("month"))
        .when(~mm_int.between(1, 12), F.lit("month_range"))
    )
    ok = error.isNull()
    yy_int = yy.try_cast("int")
    return F.struct(
        F.when(ok, cat).alias("catalog"),
        F.when(ok, st).alias("state"),
        F.when(ok, expand_year(yy_int, as_of_year)).cast("int").alias("year"),
        F.when(ok, mm_int).cast("int").alias("month"),
        F.when(ok & (blen == 9), last).alias("segment"),
        error.alias("error"),
    )


def with_parsed_name(df, name: str, as_of_year: int, out: str = "p"):
    """PRJ-1 as staged projections: the upper-cased base name and the first error are computed
    once as their own columns (regex work is not repeated per field), then packed into the same
    struct as ``parse_filename``."""
    n = F.col(name)
    staged = df.withColumn("_pn_ext", extension(n)).withColumn(
        "_pn_base", F.upper(F.left(n, F.length(n) - F.length(F.col("_pn_ext")))))
    base = F.col("_pn_base")
    blen = F.octet_length(base)
    last = F.substring(base, 9, 1)
    cat, st, yy, mm = (F.substring(base, 1, 2), F.substring(base, 3, 2), F.substring(base, 5, 2), F.substring(base, 7, 2))
    staged = staged.withColumn("_pn_mm", mm.try_cast("int")).withColumn("_pn_err", (
        F.when(F.lower(F.col("_pn_ext")) != DATA_EXT, F.lit("extension"))
        .when(~blen.isin(8, 9), F.lit("length"))
        .when((blen == 9) & ~last.rlike("^[A-Za-z]$"), F.lit("segment"))
        .when(~cat.rlike("^[A-Z]{2}$"), F.lit("catalog"))
        .when(~st.rlike("^[A-Z]{2}$"), F.lit("state"))
        .when(~yy.rlike("^[0-9]{2}$"), F.lit("year"))
        .when(~mm.rlike("^[0-9]{2}$"), F.lit("month"))
        .when(~F.col("_pn_mm").between(1, 12), F.lit("month_range"))
    ))
    ok = F.col("_pn_err").isNull()
    packed = F.struct(
        F.when(ok, cat).alias("catalog"),
        F.when(ok, st).alias("state"),
        F.when(ok, expand_year(yy.try_cast("int"), as_of_year)).cast("int").alias("year"),
        F.when(ok, F.col("_pn_mm")).cast("int").alias("month"),
        F.when(ok & (blen == 9), last).alias("segment"),
        F.col("_pn_err").alias("error"),
    )
    return staged.withColumn(out, packed).drop("_pn_ext", "_pn_base", "_pn_mm", "_pn_err")


def segment_backfill(filename: str | Column, segment: str | Column) -> Column:
    """SNK-8: an empty segment is taken from the 9th character of the name when it is a letter."""
    fn = F.upper(col_of(filename))
    ch = F.substring(fn, 9, 1)
    seg = col_of(segment)
    return F.when(seg.isNull() & (F.length(fn) >= 9) & ch.rlike("^[A-Z]$"), ch).otherwise(seg)


def canonical_path(root: str | Column, catalog: str | Column, state: str | Column, year: str | Column,
                   month: str | Column, filename: str | Column, ext: str) -> Column:
    """SNK-3: ``{root}/{catalog}/{state}/{yyyy}/{mm}/{base}{ext}`` (STR-8 zero padding)."""
    r = root if isinstance(root, Column) else F.lit(root)
    r = F.regexp_replace(r, "/+$", "")
    return F.concat_ws(
        "/", r, col_of(catalog), col_of(state),
        F.format_string("%04d", col_of(year)), F.format_string("%02d", col_of(month)),
        F.concat(base_name(filename), F.lit(ext)),
    )


def content_digest(content: str | Column) -> Column:
    """SNK-6 / HASH-1: sha256 hex of the bytes."""
    return F.sha2(col_of(content), 256)


def short_digest(content: str | Column) -> Column:
    """HASH-1: 8-character prefix of the sha256 hex (temp file suffix)."""
    return F.substring(content_digest(content), 1, 8)


def file_id_for(filename: str | Column) -> Column:
    """Deterministic catalog id for a new file name, so re-runs are idempotent."""
    return F.substring(F.sha2(F.upper(col_of(filename)), 256), 1, 32)
