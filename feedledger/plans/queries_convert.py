"""Registered queries: the conversion job end to end on record files derived from ``orders``.

The builder first writes the ``orders`` rows as compressed record files (one file per order
month and key range of at most 200,000 orders), into a fresh folder under the cluster's
checkpoint folder, then runs the conversion job on them and reads the Parquet output back.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import policy as P
from ..operators import scan as SC
from ..session import ensure_checkpoint_dir
from ..sources.record_files import write_record_files
from . import convert as CV
from .queries import AS_OF
from .registry import register

KEYS_PER_FILE = 200_000

ORDER_FIELDS = [
    ("O_ORDERKEY", "o_orderkey", "N", 19, 0),
    ("O_CUSTKEY", "o_custkey", "N", 19, 0),
    ("O_STATUS", "o_orderstatus", "C", 1, 0),
    ("O_TOTAL", "o_totalprice", "N", 12, 2),
    ("O_DATE", "o_orderdate", "D", 8, 0),
    ("O_PRIORITY", "o_orderpriority", "C", 15, 0),
]


def orders_as_record_files(t, out_dir: str):
    o = t.orders
    chunk = (F.col("o_orderkey") / KEYS_PER_FILE).cast("long")
    state = F.concat(F.char(F.lit(65) + (chunk / 26).cast("long") % 26), F.char(F.lit(65) + chunk % 26))
    name = F.concat(F.lit("OR"), state, F.date_format("o_orderdate", "yyMM"), F.lit(".dbc"))
    fields = [(fn, F.col(c), ft, ln, d) for fn, c, ft, ln, d in ORDER_FIELDS]
    return write_record_files(o, out_dir, name, F.col("o_orderkey"), fields)


def _scratch(spark, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/feedledger-{label}-{uuid.uuid4().hex[:12]}"


@register("convert_orders_roundtrip", "SRC-4,SNK-2,PRJ-6,STR-12,JOB-2", """
SELECT CAST(o_orderkey AS VARCHAR) AS O_ORDERKEY, CAST(o_custkey AS VARCHAR) AS O_CUSTKEY, o_orderstatus AS O_STATUS,
       CASE WHEN round(o_totalprice, 2) = floor(round(o_totalprice, 2)) THEN CAST(CAST(round(o_totalprice, 2) AS BIGINT) AS VARCHAR)
            ELSE CAST(round(o_totalprice, 2) AS VARCHAR) END AS O_TOTAL,
       strftime(o_orderdate, '%Y-%m-%d') AS O_DATE, trim(o_orderpriority) AS O_PRIORITY
FROM orders""", ("orders",))
def _roundtrip(t):
    spark = t.spark
    base = _scratch(spark, "orders")
    written = orders_as_record_files(t, f"{base}/landing")
    paths = written.select("path").checkpoint(eager=True)
    CV.convert(paths, parquet_root=f"{base}/parquet")
    out = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/parquet")
    return out.select(*[fn for fn, *_ in ORDER_FIELDS])


@register("convert_orders_tsv", "SNK-1,JOB-1,STR-12", """
SELECT CAST(o_orderkey AS VARCHAR) AS O_ORDERKEY, CAST(o_custkey AS VARCHAR) AS O_CUSTKEY, o_orderstatus AS O_STATUS,
       CASE WHEN round(o_totalprice, 2) = floor(round(o_totalprice, 2)) THEN CAST(CAST(round(o_totalprice, 2) AS BIGINT) AS VARCHAR)
            ELSE CAST(round(o_totalprice, 2) AS VARCHAR) END AS O_TOTAL,
       strftime(o_orderdate, '%Y-%m-%d') AS O_DATE, trim(o_orderpriority) AS O_PRIORITY
FROM orders""", ("orders",))
def _roundtrip_tsv(t):
    spark = t.spark
    base = _scratch(spark, "orders-tsv")
    paths = orders_as_record_files(t, f"{base}/landing").select("path").checkpoint(eager=True)
    CV.convert(paths, tsv_root=f"{base}/tsv")
    out = (spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
           .schema("O_ORDERKEY string, O_CUSTKEY string, O_STATUS string, O_TOTAL string, O_DATE string, O_PRIORITY string")
           .option("recursiveFileLookup", "true").csv(f"{base}/tsv"))
    return out.select(*[fn for fn, *_ in ORDER_FIELDS])


NAMES_SQL = f"""
names AS (SELECT 'OR' || chr(65 + CAST(floor(floor(o_orderkey / {KEYS_PER_FILE}) / 26) AS INTEGER) % 26) || chr(65 + CAST(floor(o_orderkey / {KEYS_PER_FILE}) AS INTEGER) % 26) AS stem,
                 CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS records
          FROM orders GROUP BY 1, 2, 3),
named AS (SELECT stem || lpad(CAST(year % 100 AS VARCHAR), 2, '0') || lpad(CAST(month AS VARCHAR), 2, '0') AS base, substr(stem, 3, 2) AS state, year, month, records FROM names)"""
BROKEN_MONTH, EMPTY_MONTH, DELETED_MONTH, BLOCKED_YEAR = 2, 5, 7, 1997


@register("convert_outcomes", "JOB-1,JOB-2,MATH-3", f"""
WITH {NAMES_SQL}
SELECT base AS file, records, true AS ok, true AS rate_fits FROM named""", ("orders",))
def _outcomes(t):
    base = _scratch(t.spark, "orders-out")
    paths = orders_as_record_files(t, f"{base}/landing").select("path").checkpoint(eager=True)
    o = CV.convert(paths).outcomes
    fits = F.abs(F.col("rows_per_sec") * F.col("decode_ms") / 1000 - F.col("records")) <= F.col("records") * 0.01 + 1
    return o.select("file", F.col("records").cast("long").alias("records"), "ok", fits.alias("rate_fits"))


def _landed(t, base):
    """Record files of the orders, and the catalog rows that name them. Of the files of some months of
    the year the end is cut off, all records are flagged deleted, or no record is left."""
    from ..functions import names as N
    from ..sources import dbc, fsio

    spark = t.spark
    paths = orders_as_record_files(t, f"{base}/landing").select("path").checkpoint(eager=True)

    def cut(batches):
        for pdf in batches:
            for path in pdf["path"]:
                data = fsio.read_bytes(path)
                fsio.write_bytes(path, data[: len(data) - len(data) // 4])
            yield pdf

    layout = [(name, kind, length) for name, _, kind, length, _ in ORDER_FIELDS]

    def emptied(batches):
        for pdf in batches:
            for path in pdf["path"]:
                gone = path[-6:-4] == f"{DELETED_MONTH:02d}"
                fsio.write_bytes(path, dbc.build_dbc(layout, [["1"] * len(layout)] * 3, deleted={0, 1, 2}) if gone else dbc.build_dbc(layout, []))
            yield pdf

    paths.where(F.substring("path", -6, 2).isin(f"{EMPTY_MONTH:02d}", f"{DELETED_MONTH:02d}")).mapInPandas(emptied, "path string").write.format("noop").mode("overwrite").save()
    paths.where(F.substring("path", -6, 2) == f"{BROKEN_MONTH:02d}").mapInPandas(cut, "path string").write.format("noop").mode("overwrite").save()
    named = N.with_parsed_name(paths.withColumn("name", F.regexp_extract("path", r"([^/]*)$", 1)), "name", 2026, "p")
    given = {"id": F.upper("name"), "filename": F.upper("name"), "catalog": F.col("p.catalog"), "state": F.col("p.state"), "year": F.col("p.year"), "month": F.col("p.month"),
             "dbc_path": F.col("path"), "root_path": F.lit(base), "overall_status": F.lit("downloaded")}
    files = named.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.FILES.fields))
    return files.checkpoint(eager=True)


@register("convert_records_state", "JOB-1,JOB-4,SNK-3", f"""
WITH {NAMES_SQL}
SELECT base || '.DBC' AS filename,
       CASE WHEN year = {BLOCKED_YEAR} THEN 'ignored' WHEN month = {BROKEN_MONTH} THEN 'failed' ELSE 'csv_ready' END AS overall_status,
       CASE WHEN year <> {BLOCKED_YEAR} AND month <> {BROKEN_MONTH}
            THEN '/csv/OR/' || state || '/' || lpad(CAST(year AS VARCHAR), 4, '0') || '/' || lpad(CAST(month AS VARCHAR), 2, '0') || '/' || base || '.csv' END AS csv_path,
       CASE WHEN year = {BLOCKED_YEAR} THEN NULL WHEN month = {BROKEN_MONTH} THEN 'failed' ELSE 'done' END AS stage_status,
       year <> {BLOCKED_YEAR} AND month = {BROKEN_MONTH} AS has_error,
       year <> {BLOCKED_YEAR} AND month <> {BROKEN_MONTH} AS published
FROM named""", ("orders",))
def _records_state(t):
    """Good, short and blocked files through the whole job: catalog, stages and published files."""
    spark = t.spark
    base = _scratch(spark, "orders-state")
    files = _landed(t, base)
    years = [y for y in range(1980, 2040) if y != BLOCKED_YEAR]
    letters = [chr(65 + i) for i in range(26)]
    policy = P.Policy.from_lists(spark, catalogs=["OR"], states=[a + b for a in letters for b in letters], years=years)
    result, blocked = CV.convert_admitted(files, policy, tsv_root=f"{base}/csv")
    new_files, new_stages = CV.record_conversion(files, spark.createDataFrame([], S.FILE_STAGES), result.outcomes, "csv_conversion", f"{base}/csv", AS_OF, blocked)
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{base}/csv").select(
        F.regexp_replace("path", "^file:/*", "/").alias("_there")).distinct()
    st = new_stages.select(F.col("file_id").alias("id"), F.col("status").alias("stage_status"), F.col("error_message").isNotNull().alias("has_error"))
    out = new_files.join(st, "id", "left").join(there, F.regexp_replace("csv_path", "^file:/*", "/") == F.col("_there"), "left")
    return out.select("filename", "overall_status", F.replace("csv_path", F.lit(base), F.lit("")).alias("csv_path"), "stage_status",
                      F.coalesce("has_error", F.lit(False)).alias("has_error"), F.col("_there").isNotNull().alias("published"))


@register("convert_then_local_sync", "JOB-2,JOIN-14,UPD-13,SNK-3", f"""
WITH {NAMES_SQL}
SELECT base || '.DBC' AS filename, CASE WHEN month = {BROKEN_MONTH} THEN 'downloaded' ELSE 'parquet_ready' END AS overall_status,
       CASE WHEN month <> {BROKEN_MONTH}
            THEN '/parquet/OR/' || state || '/' || lpad(CAST(year AS VARCHAR), 4, '0') || '/' || lpad(CAST(month AS VARCHAR), 2, '0') || '/' || base || '.parquet' END AS parquet_path
FROM named""", ("orders",))
def _then_sync(t):
    """The files that a conversion publishes are the ones that the local sync looks for."""
    spark = t.spark
    base = re.sub("^file:/*", "/", _scratch(spark, "orders-sync"))
    files = _landed(t, base)
    CV.convert(files.select(F.col("dbc_path").alias("path")), parquet_root=f"{base}/parquet")
    listed = lambda d: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(d).select(
        F.regexp_replace("path", "^file:/*", "/").alias("path"), F.col("length").alias("size"), F.col("modificationTime").alias("mod_time"))
    local = listed(f"{base}/landing").select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "size", "mod_time", F.col("path").alias("remote_path"))
    new_files, _, _ = SC.local_sync(spark.createDataFrame([], S.FILES), spark.createDataFrame([], S.FILE_STAGES), local, AS_OF, 2026,
                                    f"{base}/csv", f"{base}/parquet", f"{base}/landing", listed(f"{base}/parquet").select("path"))
    return new_files.select("filename", "overall_status", F.replace("parquet_path", F.lit(base), F.lit("")).alias("parquet_path"))
