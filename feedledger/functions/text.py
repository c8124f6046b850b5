"""Text renderings as column expressions: numbers, byte sizes, counts, dates, periods and code
labels (STR-10/11/12, DATE-3/4/5, JOIN-16 helpers, WIN-3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..schemas import col_of

# Display texts.
INVALID_DATE = "Data desconhecida"
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB"]
LEVEL_LABELS = ["Baixo", "Baixo", "Médio", "Médio", "Alto", "Alto"]
FILES_WORD = "arquivos"


def number_to_text(x: str | Column) -> Column:
    """STR-12: a double as the shortest plain decimal text (no exponent); NULL -> ''.

    The engine's text of a double has its shortest digits, with an exponent when it is very large or
    small; the digits are then moved by the exponent. Integral values below 9e18 go through ``long``.
    """
    v = col_of(x).cast("double")
    integral = (v == F.floor(v)) & (F.abs(v) < F.lit(9e18))
    text = F.abs(v).cast("string")
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    plain = F.regexp_replace(text, r"\.0$", "")
    digits = F.regexp_replace(F.regexp_extract(text, r"^([0-9.]+)E", 1), r"\.0$", "")
    exponent = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    whole, after = F.replace(digits, F.lit("."), F.lit("")), F.length(digits) - F.when(F.contains(digits, F.lit(".")), 2).otherwise(1)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), whole)
    # one digit stands before the point, so a large exponent moves it past all the others
    large = F.when(exponent >= after, F.concat(whole, F.repeat(F.lit("0"), exponent - after))).otherwise(
        F.concat(F.substring(whole, F.lit(1), exponent + 1), F.lit("."), F.substring(whole, exponent + 2, F.length(whole))))
    moved = F.when(exponent < 0, small).otherwise(large)
    return (
        F.when(v.isNull(), F.lit(""))
        .when(integral, v.cast("long").cast("string"))
        .when(F.contains(text, F.lit("E")), F.concat(sign, moved))
        .otherwise(F.when(text.rlike("^[0-9.]+$"), F.concat(sign, plain)).otherwise(v.cast("string")))
    )


def value_to_text(c: str | Column, kind: str) -> Column:
    """STR-12 for any field kind: text as is, numbers via ``number_to_text``, booleans as
    true/false, dates as yyyy-MM-dd, NULL as ''."""
    col = col_of(c)
    if kind == "number":
        return number_to_text(col)
    if kind == "bool":
        return F.when(col.isNull(), F.lit("")).when(col, F.lit("true")).otherwise(F.lit("false"))
    if kind == "date":
        return F.coalesce(F.date_format(col, "yyyy-MM-dd"), F.lit(""))
    return F.coalesce(col.cast("string"), F.lit(""))


def format_bytes(x: str | Column) -> Column:
    """STR-10: base-1024 size with unit B..TB; one decimal below 10 (none for bytes); <= 0 -> '0 B'."""
    v = col_of(x).cast("double")
    idx = F.lit(0)
    for i in range(1, len(SIZE_UNITS)):
        idx = F.when(v >= F.lit(float(1024 ** i)), F.lit(i)).otherwise(idx)
    size = v / F.pow(F.lit(1024.0), idx.cast("double"))
    units = F.array(*[F.lit(u) for u in SIZE_UNITS])
    unit = F.element_at(units, idx + 1)
    text = F.when((size >= 10) | (idx == 0), F.format_string("%.0f", size)).otherwise(F.format_string("%.1f", size))
    return F.when(v.isNull() | (v <= 0) | F.isnan(v), F.lit("0 B")).otherwise(F.concat_ws(" ", text, unit))


def group_thousands_br(n: str | Column) -> Column:
    """Integer with '.' as the thousands separator (pt-BR)."""
    return F.translate(F.format_number(col_of(n).cast("long"), 0), ",", ".")


def size_and_count_label(total: str | Column, count: str | Column, zero_unit: str = "B") -> Column:
    """STR-11: '<size> (<count> arquivos)' with pt-BR grouping; non-positive counts -> 0."""
    t = col_of(total)
    c = col_of(count)
    size = F.when(t > 0, format_bytes(t)).otherwise(F.lit("0 GB" if zero_unit == "GB" else "0 B"))
    cnt = group_thousands_br(F.when(c > 0, c).otherwise(F.lit(0)))
    return F.concat(size, F.lit(" ("), cnt, F.lit(f" {FILES_WORD})"))


def size_rounded(x: str | Column) -> Column:
    """STR-11: base-1024 size rounded to a whole number, halves up; <= 0, NULL or not finite -> '0 B'."""
    v = col_of(x).cast("double")
    idx = F.lit(0)
    for i in range(1, len(SIZE_UNITS)):
        idx = F.when(F.floor(v + 0.5) >= F.lit(float(1024 ** i)), F.lit(i)).otherwise(idx)
    size = F.floor(F.when(idx == 0, v).otherwise(F.floor(v + 0.5) / F.pow(F.lit(1024.0), idx.cast("double"))) + 0.5)
    text = F.concat_ws(" ", size.cast("long").cast("string"), F.element_at(F.array(*[F.lit(u) for u in SIZE_UNITS]), idx + 1))
    return F.when(v.isNull() | F.isnan(v) | (v <= 0) | (v == float("inf")), F.lit("0 B")).otherwise(text)


def size_range_label(low: str | Column, high: str | Column) -> Column:
    """STR-11: '<size> a <size>', or one size when both ends are equal."""
    a, b = col_of(low), col_of(high)
    return F.when(a == b, size_rounded(a)).otherwise(F.concat(size_rounded(a), F.lit(" a "), size_rounded(b)))


def date_br(ts: str | Column, kind: str = "date") -> Column:
    """DATE-3: dd/MM/yyyy, dd/MM/yyyy HH:mm, dd/MM/yyyy HH:mm:ss or HH:mm:ss; unreadable input
    gives 'Data desconhecida' ('' for the time-only form). Strings are parsed with try_to_timestamp."""
    c = col_of(ts)
    t = F.try_to_timestamp(c.cast("string")) if kind != "raw" else c
    fmt = {"date": "dd/MM/yyyy", "datetime": "dd/MM/yyyy HH:mm", "seconds": "dd/MM/yyyy HH:mm:ss",
           "time": "HH:mm:ss"}[kind]
    fallback = "" if kind == "time" else INVALID_DATE
    return F.coalesce(F.date_format(t, fmt), F.lit(fallback))


def period_key(year: str | Column, month: str | Column) -> Column:
    """DATE-4: 'yyyy-mm'."""
    return F.format_string("%d-%02d", col_of(year), col_of(month))


def period_label(year: str | Column, month: str | Column) -> Column:
    """DATE-4: 'mm/yyyy'."""
    return F.format_string("%02d/%d", col_of(month), col_of(year))


def rfc3339(ts: str | Column) -> Column:
    """DATE-5: RFC 3339 text of a UTC timestamp as JSON encoders write it: seconds, then a
    fraction only when it is non-zero (trailing zeros dropped), then 'Z'."""
    t = S.as_ts(col_of(ts))
    frac = F.regexp_replace(F.date_format(t, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")), F.lit("Z"))


def level_label(level: str | Column) -> Column:
    """WIN-3: label of a sextile level 0..5."""
    return F.element_at(F.array(*[F.lit(x) for x in LEVEL_LABELS]), col_of(level).cast("int") + 1)


# ----------------------------------------------------------------------------- labels (JOIN-16)


def label_table(spark: SparkSession, mapping: dict[str, str], key: str = "code") -> DataFrame:
    """A bounded code -> label dimension (at most a few dozen rows), broadcast by callers."""
    return spark.createDataFrame(sorted(mapping.items()), f"{key} string, label string")


def with_catalog_label(df: DataFrame, col: str = "key", out: str = "catalog_label") -> DataFrame:
    """JOIN-16: 'CC - name', or 'CC - Catálogo não mapeado'."""
    labels = label_table(df.sparkSession, S.CATALOG_NAMES, "_lc")
    code = S.norm_code(col)
    j = df.join(F.broadcast(labels), code == F.col("_lc"), "left")
    return j.withColumn(out, F.concat(code, F.lit(" - "), F.coalesce("label", F.lit(S.CATALOG_UNMAPPED)))).drop("_lc", "label")


def with_state_label(df: DataFrame, col: str = "key", out: str = "state_label") -> DataFrame:
    """JOIN-16: state name, 'UF desconhecida' for blanks, 'UF desconhecida (XX)' for unknown codes."""
    labels = label_table(df.sparkSession, S.STATE_NAMES, "_ls")
    code = F.upper(F.trim(F.coalesce(F.col(col), F.lit(""))))
    j = df.join(F.broadcast(labels), code == F.col("_ls"), "left")
    lab = (F.when(code == "", F.lit(S.STATE_UNKNOWN))
           .otherwise(F.coalesce("label", F.concat(F.lit(S.STATE_UNKNOWN + " ("), code, F.lit(")")))))
    return j.withColumn(out, lab).drop("_ls", "label")


def with_status_label(df: DataFrame, col: str = "overall_status", out: str = "status_label", stage: bool = False) -> DataFrame:
    """JOIN-16: overall (or stage) status label; unknown overall codes show with '_' as spaces."""
    mapping = S.STAGE_STATUS_LABELS if stage else S.OVERALL_LABELS
    labels = label_table(df.sparkSession, mapping, "_lst")
    raw = F.col(col)
    key = raw if stage else F.when(raw.isNull() | (raw == ""), F.lit("unknown")).otherwise(raw)
    j = df.join(F.broadcast(labels), key == F.col("_lst"), "left")
    fallback = raw if stage else F.regexp_replace(key, "_", " ")
    return j.withColumn(out, F.coalesce("label", fallback)).drop("_lst", "label")
