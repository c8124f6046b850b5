"""Selection intents and their expansion into (catalog, year, month) download jobs (SET-3..9).

A selection is three sets of keys: whole catalogs, ``CAT:yyyy`` years and ``CAT:yyyy:mm`` months.
Expansion uses generators (``sequence`` + ``explode``) per selected key; jobs are de-duplicated on
their key, so a month inside a selected year or catalog appears once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

# Catalogs a selection may name.
SELECTION_CATALOGS = ["SIH", "SIA", "CNES", "SIM", "SINASC", "SINAN", "PNI", "ESUS_APS", "CIHA"]

INT_RE = r"^[+-]?[0-9]+$"


def year_key(catalog: str | Column, year: str | Column) -> Column:
    """SET-7: ``CAT:yyyy``."""
    return F.format_string("%s:%04d", _c(catalog), _c(year))


def month_key(catalog: str | Column, year: str | Column, month: str | Column) -> Column:
    """SET-7: ``CAT:yyyy:mm``."""
    return F.format_string("%s:%04d:%02d", _c(catalog), _c(year), _c(month))


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def normalize(arr: str | Column) -> Column:
    """SET-3: de-duplicate and sort a key array."""
    return F.array_sort(F.array_distinct(_c(arr)))


def add_key(arr: str | Column, key: str | Column) -> Column:
    """SET-4: additive selection (add one key, keep the array normalised)."""
    k = key if isinstance(key, Column) else F.lit(key)
    return normalize(F.array_union(_c(arr), F.array(k)))


def year_range(as_of_year: int) -> Column:
    """SET-7: selectable years 0..as_of_year."""
    return F.sequence(F.lit(0), F.lit(as_of_year))


def months() -> Column:
    return F.sequence(F.lit(1), F.lit(12))


def _int(part: Column) -> Column:
    return F.when(part.rlike(INT_RE), part.try_cast("int"))


def classify_keys(keys: DataFrame, as_of_year: int, level: str = "level", value: str = "value") -> DataFrame:
    """SET-5/SET-6: parse (level, value) selection rows. Adds catalog, year, month and ``reason``
    (NULL when valid). Duplicated rows are removed first (SET-3)."""
    k = keys.select(F.col(level).alias("level"), F.col(value).alias("value")).distinct()
    parts = F.split("value", ":")
    n = F.size(parts)
    p0, p1, p2 = F.element_at(parts, 1), F.element_at(parts, 2), F.element_at(parts, 3)
    known = F.array(*[F.lit(c) for c in SELECTION_CATALOGS])
    is_cat = F.col("level") == "catalog"
    is_year = F.col("level") == "year"
    cat = F.when(is_cat, F.col("value")).otherwise(p0)
    yr = F.when(~is_cat, _int(p1))
    mo = F.when(F.col("level") == "month", _int(p2))
    reason = (
        F.when(is_cat & ~F.array_contains(known, F.col("value")), F.lit(S.BAD_CATALOG))
        .when(is_cat, F.lit(None))
        .when(is_year & (n != 2), F.lit(S.BAD_KEY_FORMAT))
        .when(~is_year & (n != 3), F.lit(S.BAD_KEY_FORMAT))
        .when(yr.isNull(), F.lit(S.BAD_YEAR))
        .when(~is_year & mo.isNull(), F.lit(S.BAD_MONTH))
        .when(~F.array_contains(known, cat), F.lit(S.BAD_CATALOG))
        .when(~yr.between(0, as_of_year), F.lit(S.YEAR_OUT_OF_RANGE))
        .when(~is_year & ~mo.between(1, 12), F.lit(S.MONTH_OUT_OF_RANGE))
    )
    return k.select("level", "value", cat.alias("catalog"), yr.alias("year"), mo.alias("month"), reason.alias("reason"))


def invalid_selections(keys: DataFrame, as_of_year: int) -> DataFrame:
    """SET-6: rejected keys with level, value and reason."""
    return classify_keys(keys, as_of_year).where(F.col("reason").isNotNull()).select("level", "value", "reason")


def build_download_jobs(keys: DataFrame, as_of_year: int) -> DataFrame:
    """SET-5: expand valid keys into (catalog, year, month, key) jobs, unique on key."""
    c = classify_keys(keys, as_of_year).where(F.col("reason").isNull())
    # one generator per key row (no union of three passes): the (year, month) pairs it selects
    ym = lambda y, m: F.struct(y.cast("int").alias("year"), m.cast("int").alias("month"))
    periods = (
        F.when(F.col("level") == "catalog",
               F.flatten(F.transform(year_range(as_of_year), lambda y: F.transform(months(), lambda m: ym(y, m)))))
        .when(F.col("level") == "year", F.transform(months(), lambda m: ym(F.col("year"), m)))
        .otherwise(F.array(ym(F.col("year"), F.col("month"))))
    )
    jobs = c.select("catalog", F.explode(periods).alias("p")).select("catalog", "p.year", "p.month")
    return jobs.withColumn("key", month_key("catalog", "year", "month")).dropDuplicates(["key"])


# ----------------------------------------------------------------------- period sets (SET-8/9)


def compact_periods(years: DataFrame, months_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SET-8 (re-aimed): a year with all 12 months selected becomes a year row; months of
    selected years are dropped. Returns (years, months)."""
    full = months_df.groupBy("year").agg(F.count_distinct("month").alias("_n")).where(F.col("_n") == 12).select("year")
    new_years = years.select("year").unionByName(full).distinct()
    kept = months_df.select("year", "month").distinct().join(new_years, "year", "left_anti")
    return new_years, kept


def remove_month(years: DataFrame, months_df: DataFrame, year: int, month: int) -> tuple[DataFrame, DataFrame]:
    """SET-9: unselecting one month of a selected year keeps the other eleven as month rows."""
    was_year = years.where(F.col("year") == year)
    other = was_year.select("year", F.explode(F.array_except(months(), F.array(F.lit(month)))).alias("month"))
    new_years = years.where(F.col("year") != year)
    new_months = months_df.where(~((F.col("year") == year) & (F.col("month") == month))).unionByName(other).distinct()
    return new_years, new_months
