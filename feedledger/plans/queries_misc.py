"""Registered queries: listings of landed files, digests, local sync, policy overview and
small scalar families (JSON filter maps, RFC 3339, list normalisation, LIKE escaping)."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import glob as G
from ..functions import names as N
from ..functions import text as TX
from ..operators import audit as AU
from ..operators import policy as P
from ..operators import scan as SC
from ..session import ensure_checkpoint_dir
from ..sources.record_files import write_record_files
from . import convert as CV
from .listspec import normalize_list_col
from .queries import AS_OF, AS_OF_YEAR
from .queries_convert import KEYS_PER_FILE, ORDER_FIELDS
from .registry import register

# File names the landing writer produces from orders (SQL twin of _landing_name).
LANDING_NAME_SQL = """'OR' || ([""" + ", ".join(f"'{x}'" for x in S.KNOWN_STATES) + """])[CAST(floor(o_orderkey / 200000) AS INTEGER) % 27 + 1]
       || strftime(o_orderdate, '%y%m') || chr(65 + CAST(floor(floor(o_orderkey / 200000) / 27) AS INTEGER) % 26) || '.dbc'"""


def _landing_name():
    """OR + a state code and a part letter from the key range (<= 200,000 orders per file) + yymm."""
    chunk = (F.col("o_orderkey") / KEYS_PER_FILE).cast("long")
    state = F.element_at(F.array(*[F.lit(x) for x in S.KNOWN_STATES]), (chunk % 27 + 1).cast("int"))
    part = F.char(F.lit(65) + (chunk / 27).cast("long") % 26)
    return F.concat(F.lit("OR"), state, F.date_format("o_orderdate", "yyMM"), part, F.lit(".dbc"))


def _landing(t, label: str) -> str:
    """Write the orders as record files into {base}/landing/{yyyy}/NAME.dbc; return base."""
    base = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/feedledger-{label}-{uuid.uuid4().hex[:12]}"
    name = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("/"), _landing_name())
    fields = [(fn, F.col(c), ft, ln, d) for fn, c, ft, ln, d in ORDER_FIELDS]
    write_record_files(t.orders, f"{base}/landing", name, F.col("o_orderkey"), fields).write.format("noop").mode("overwrite").save()
    return base


@register("list_landing_recursive", "SRC-1,SRC-3,FLT-22", f"""
SELECT DISTINCT strftime(o_orderdate, '%Y') AS dir, {LANDING_NAME_SQL} AS name FROM orders""", ("orders",))
def _list_recursive(t):
    base = _landing(t, "landing")
    ls = SC.list_directories(t.spark, f"{base}/landing", recursive=True)
    return ls.where(N.has_data_extension("name")).select(
        F.regexp_extract("ftp_dir", r"([^/]*)$", 1).alias("dir"), "name")


@register("list_landing_dirs", "SRC-2", f"""
SELECT strftime(o_orderdate, '%Y') AS dir, count(DISTINCT {LANDING_NAME_SQL}) AS files FROM orders GROUP BY 1""", ("orders",))
def _list_dirs(t):
    base = _landing(t, "landing-dirs")
    fs_years = t.orders.select(F.date_format("o_orderdate", "yyyy").alias("y")).distinct()
    dirs = [f"{base}/landing/{r['y']}" for r in fs_years.collect()]  # distinct years: a bounded handful
    ls = SC.list_directories(t.spark, dirs)
    return ls.groupBy(F.regexp_extract("ftp_dir", r"([^/]*)$", 1).alias("dir")).agg(F.count(F.lit(1)).alias("files"))


def _landed_files(t, base):
    """A catalog table for the landed files (as a scan would have registered them)."""
    ls = SC.list_directories(t.spark, f"{base}/landing", recursive=True)
    c = SC.classify_listing(ls, t.spark.createDataFrame([], S.FILES), None, AS_OF_YEAR)
    up = SC.upsert_files(t.spark.createDataFrame([], S.FILES), SC.upsert_rows(c, "/data"), AS_OF).drop("is_new")
    return up.join(ls.select(F.upper("name").alias("filename"), F.col("remote_path").alias("_p")), "filename") \
        .withColumn("dbc_path", F.col("_p")).drop("_p")


@register("land_inventory", "JOB-3,SNK-6,HASH-1", f"""
SELECT DISTINCT upper({LANDING_NAME_SQL}) AS filename FROM orders""", ("orders",))
def _land_inventory(t):
    base = _landing(t, "land")
    files = _landed_files(t, base)
    inv = CV.land_inventory(t.spark, f"{base}/landing", files)
    ok = inv.where((F.length("local_hash") == 64) & F.col("local_hash").rlike("^[0-9a-f]+$"))
    return ok.select("filename")


# A catalog name for every document id (SQL twin of _document_name): two letters, state, year, month, letter.
DOCUMENT_PARTS_SQL = """
SELECT doc_id, text, chr(65 + CAST(doc_id // 21902400 AS INTEGER) % 26) || chr(65 + CAST(doc_id // 842400 AS INTEGER) % 26) AS catalog,
       ([""" + ", ".join(f"'{x}'" for x in S.KNOWN_STATES) + """])[CAST(doc_id // 31200 AS INTEGER) % 27 + 1] AS state,
       CAST(doc_id // 312 AS INTEGER) % 100 AS yy, CAST(doc_id // 26 AS INTEGER) % 12 + 1 AS month, chr(65 + CAST(doc_id AS INTEGER) % 26) AS segment FROM documents"""


def _document_parts(docs):
    i = F.col("doc_id")
    digit = lambda size, radix: (F.floor(i / size) % radix).cast("int")
    letter = lambda c: F.char(F.lit(65) + c)
    return docs.select("doc_id", "text", F.concat(letter(digit(21902400, 26)), letter(digit(842400, 26))).alias("catalog"),
                       F.element_at(F.array(*[F.lit(x) for x in S.KNOWN_STATES]), digit(31200, 27) + 1).alias("state"),
                       (digit(312, 100) + 2000).alias("year"), (digit(26, 12) + 1).alias("month"), letter(digit(1, 26)).alias("segment"))


@register("land_records_state", "JOB-3,SNK-3,SNK-4,SNK-6,HASH-1,UPD-5", f"""
WITH p AS ({DOCUMENT_PARTS_SQL}),
n AS (SELECT *, catalog || state || lpad(CAST(yy AS VARCHAR), 2, '0') || lpad(CAST(month AS VARCHAR), 2, '0') || segment AS base,
             CASE WHEN doc_id % 10 = 3 THEN 'failed' WHEN coalesce(text, '') = '' THEN 'unlisted' ELSE 'landed' END AS how FROM p)
SELECT base || '.DBC' AS filename, CASE how WHEN 'failed' THEN 'failed' WHEN 'unlisted' THEN 'downloading' ELSE 'downloaded' END AS overall_status,
       CASE WHEN how = 'landed' THEN '/store/' || catalog || '/' || state || '/20' || lpad(CAST(yy AS VARCHAR), 2, '0') || '/' || lpad(CAST(month AS VARCHAR), 2, '0') || '/' || base || '.dbc' END AS dbc_path,
       CASE WHEN how = 'landed' THEN sha256(text) END AS local_hash, CASE how WHEN 'failed' THEN 'failed' WHEN 'landed' THEN 'done' END AS stage_status,
       how = 'failed' AS has_error, CASE how WHEN 'failed' THEN 'failed' WHEN 'landed' THEN 'completed' END AS logged, how = 'landed' AS there
FROM n""", ("documents",))
def _land_state(t):
    """Documents as source files, some of them lost before they are copied; the store, the catalog,
    the stages and the log afterwards."""
    from ..sources import fsio
    from . import landing as LD

    spark, base = t.spark, re.sub("^file:/*", "/", f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/feedledger-land-{uuid.uuid4().hex[:12]}")
    name = F.concat("catalog", "state", F.format_string("%02d", F.col("year") % 100), F.format_string("%02d", "month"), "segment")
    parts = _document_parts(t.documents).withColumn("base", name).withColumn("lost", F.col("doc_id") % 10 == 3)
    # a folder for each catalog, state and year: a task that lists one has a bounded number of files
    parts = parts.withColumn("folder", F.concat(F.lit(f"{base}/source/"), "catalog", F.lit("/"), "state", F.col("year").cast("string")))

    def write(batches):
        for pdf in batches:
            for folder, stem, text in zip(pdf["folder"], pdf["base"], pdf["text"]):
                fsio.write_bytes(f"{folder}/{stem}.dbc", text.encode())
            yield pdf[["base"]]

    parts.where(~F.col("lost") & (F.coalesce("text", F.lit("")) != "")).select("folder", "base", "text").mapInPandas(write, "base string").write.format("noop").mode("overwrite").save()
    given = {"id": F.col("base"), "filename": F.concat("base", F.lit(".DBC")), "ftp_dir": F.lit("/pub"), "ftp_path": F.col("base"), "root_path": F.lit("/data"),
             "overall_status": F.lit("downloading")} | {c: F.col(c) for c in ("catalog", "state", "year", "month", "segment")}
    files = parts.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.FILES.fields))
    listing = SC.list_directories(spark, f"{base}/source", recursive=True)
    lost = parts.where("lost").select(F.col("folder").alias("ftp_dir"), F.concat("base", F.lit(".dbc")).alias("name"), F.lit(0).cast("long").alias("size"),
                                      F.lit(None).cast("timestamp").alias("mod_time"), F.concat("folder", F.lit("/"), "base", F.lit(".dbc")).alias("remote_path"))
    outcomes = LD.land(files, listing.unionByName(lost), f"{base}/store")
    new_files, stages, logs = LD.record_landing(files, spark.createDataFrame([], S.FILE_STAGES), outcomes, AS_OF)
    there = SC.list_directories(spark, f"{base}/store", recursive=True).select(F.col("remote_path").alias("_there"))
    st = stages.select(F.col("file_id").alias("id"), F.col("status").alias("stage_status"), F.col("error_message").isNotNull().alias("has_error"))
    out = new_files.join(st, "id", "left").join(logs.select(F.col("file_id").alias("id"), F.col("event_type").alias("logged")), "id", "left").join(
        there, F.col("dbc_path") == F.col("_there"), "left")
    return out.select("filename", "overall_status", F.replace("dbc_path", F.lit(base), F.lit("")).alias("dbc_path"), "local_hash", "stage_status",
                      F.coalesce("has_error", F.lit(False)).alias("has_error"), "logged", F.col("_there").isNotNull().alias("there"))


@register("convert_admitted_outcomes", "JOB-4,JOB-2,JOIN-3", """
SELECT count(*) AS records FROM orders WHERE year(o_orderdate) IN (1997, 2000)""", ("orders",))
def _convert_admitted(t):
    base = _landing(t, "gate")
    files = _landed_files(t, base)
    pol = P.Policy.from_lists(t.spark, catalogs=["OR"], states=S.KNOWN_STATES, years=[1997, 2000])
    res, blocked = CV.convert_admitted(files, pol)
    return res.outcomes.agg(F.sum("records").cast("long").alias("records"))


@register("local_sync_counters", "UPD-13,AGG-31,JOIN-14,SNK-3", f"""
SELECT count(DISTINCT {LANDING_NAME_SQL}) AS found, count(DISTINCT {LANDING_NAME_SQL}) AS mapped, CAST(0 AS BIGINT) AS ignored,
       count(DISTINCT {LANDING_NAME_SQL}) AS completed, 2 * count(DISTINCT {LANDING_NAME_SQL}) AS enqueued FROM orders""", ("orders",))
def _local_sync(t):
    base = _landing(t, "sync")
    local = SC.list_directories(t.spark, f"{base}/landing", recursive=True)
    empty_files = t.spark.createDataFrame([], S.FILES)
    empty_stages = t.spark.createDataFrame([], S.FILE_STAGES)
    _, _, counters = SC.local_sync(empty_files, empty_stages, local, AS_OF, AS_OF_YEAR,
                                   f"{base}/csv", f"{base}/parquet", f"{base}/landing",
                                   artifacts=t.spark.createDataFrame([], "path string"))
    return counters.select(*[F.col(c).cast("long").alias(c) for c in ("found", "mapped", "ignored", "completed", "enqueued")])


@register("local_sync_status", "UPD-13", f"""
SELECT DISTINCT upper({LANDING_NAME_SQL}) AS filename, 'downloaded' AS overall_status FROM orders""", ("orders",))
def _local_sync_status(t):
    base = _landing(t, "sync2")
    local = SC.list_directories(t.spark, f"{base}/landing", recursive=True)
    files, stages, _ = SC.local_sync(t.spark.createDataFrame([], S.FILES), t.spark.createDataFrame([], S.FILE_STAGES),
                                     local, AS_OF, AS_OF_YEAR, f"{base}/csv", f"{base}/parquet", f"{base}/landing",
                                     artifacts=t.spark.createDataFrame([], "path string"))
    return files.select("filename", "overall_status")


@register("compare_tsv_parquet", "AGG-30", """
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS s, trim(o_orderpriority) AS p FROM orders)
SELECT 'O_ORDERKEY' AS "column", count(*) AS rows_a, count(*) AS rows_b, CAST(0 AS BIGINT) AS only_in_a, CAST(0 AS BIGINT) AS only_in_b,
       count(DISTINCT k) AS distinct_a, count(DISTINCT k) AS distinct_b FROM o
UNION ALL SELECT 'O_STATUS', count(*), count(*), 0, 0, count(DISTINCT s), count(DISTINCT s) FROM o
UNION ALL SELECT 'O_PRIORITY', count(*), count(*), 0, 0, count(DISTINCT p), count(DISTINCT p) FROM o""", ("orders",))
def _compare(t):
    base = _landing(t, "cmp")
    paths = SC.list_directories(t.spark, f"{base}/landing", recursive=True).select(F.col("remote_path").alias("path"))
    CV.convert(paths, tsv_root=f"{base}/tsv", parquet_root=f"{base}/pq")
    cols = ["O_ORDERKEY", "O_STATUS", "O_PRIORITY"]
    tsv = (t.spark.read.option("sep", "\t").option("header", True).option("escape", '"')
           .schema(", ".join(f"{fn} string" for fn, *_ in ORDER_FIELDS)).option("recursiveFileLookup", "true").csv(f"{base}/tsv").select(*cols))
    pq = t.spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/pq").select(*cols)
    return AU.compare_datasets(tsv, pq)


# ======================================================================= catalog table loads


@register("load_files_table", "SRC-5", "SELECT id, filename, overall_status, size_bytes FROM files")
def _load_files(t):
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/feedledger-files-{uuid.uuid4().hex[:12]}"
    SC.conform_files(t.files).write.parquet(path)
    return t.spark.read.schema(S.FILES).parquet(path).select("id", "filename", "overall_status", "size_bytes")


@register("directory_snapshot", "SRC-6", """
SELECT id, filename, size_bytes, remote_timestamp, overall_status, ftp_dir FROM files WHERE ftp_dir = '/pub/RD'""")
def _snapshot(t):
    return SC.snapshot(t.files, "/pub/RD")


@register("policy_overview", "SET-11,SRC-7", """
SELECT 'available_catalog' AS section, value FROM (
  SELECT upper(trim(catalog)) AS value FROM files UNION SELECT upper(trim(catalog)) FROM policy_catalogs
  UNION SELECT * FROM (VALUES ('AD'),('RD'),('SP'),('AQ'),('AM'),('BI'),('RJ'),('PA'),('AR'),('ER'),('PS'),('AN')) k(value)) a
  WHERE value IS NOT NULL AND trim(value) <> ''
UNION ALL SELECT 'available_state', value FROM (
  SELECT upper(trim(state)) AS value FROM files UNION SELECT upper(trim(state)) FROM policy_states
  UNION SELECT * FROM (VALUES """ + ", ".join(f"('{s}')" for s in S.KNOWN_STATES) + """) k(value)) b
  WHERE value IS NOT NULL AND trim(value) <> ''
UNION ALL SELECT DISTINCT 'available_period', printf('%04d-%02d', year, month) FROM files WHERE year >= 0 AND month BETWEEN 1 AND 12
UNION ALL SELECT DISTINCT 'selected_catalog', upper(trim(catalog)) FROM policy_catalogs
UNION ALL SELECT DISTINCT 'selected_state', upper(trim(state)) FROM policy_states
UNION ALL SELECT DISTINCT 'selected_year', CAST(year AS VARCHAR) FROM policy_years
UNION ALL SELECT DISTINCT 'selected_month', printf('%04d-%02d', year, month) FROM policy_months
UNION ALL SELECT 'processing', '{"enable_download":true,"enable_csv":true,"enable_parquet":true}' FROM policy_config""")
def _overview(t):
    return P.policy_overview(t.files, P.Policy.from_tables(t))


@register("seed_policy_from_legacy", "SNK-7", """
WITH cp AS (SELECT DISTINCT catalog, catalog IN (SELECT catalog FROM policy_catalogs) OR catalog = 'AM' AS download_enabled FROM files),
ap AS (SELECT DISTINCT catalog, year, month FROM files WHERE year = 1999),
en AS (SELECT DISTINCT catalog FROM cp WHERE download_enabled),
cats AS (SELECT catalog FROM policy_catalogs UNION ALL SELECT catalog FROM en WHERE catalog NOT IN (SELECT catalog FROM policy_catalogs)),
mons AS (SELECT year, month FROM policy_months UNION ALL
         SELECT DISTINCT year, month FROM ap WHERE catalog IN (SELECT catalog FROM en)
           AND NOT EXISTS (SELECT 1 FROM policy_months pm WHERE pm.year = ap.year AND pm.month = ap.month))
SELECT 'catalog' AS kind, catalog AS value FROM cats UNION ALL SELECT 'month', printf('%04d-%02d', year, month) FROM mons""")
def _seed(t):
    pol = P.Policy.from_tables(t)
    sel = F.broadcast(t.policy_catalogs.select("catalog").distinct().withColumn("_sel", F.lit(True)))
    cp = (t.files.select("catalog").distinct().join(sel, "catalog", "left")
          .select("catalog", (F.coalesce("_sel", F.lit(False)) | (F.col("catalog") == "AM")).alias("download_enabled")))
    ap = t.files.where(F.col("year") == 1999).select("catalog", "year", "month").distinct()
    seeded = P.seed_from_legacy(cp, ap, pol)
    return seeded.catalogs.select(F.lit("catalog").alias("kind"), F.col("catalog").alias("value")).unionByName(
        seeded.months.select(F.lit("month").alias("kind"), F.format_string("%04d-%02d", "year", "month").alias("value")))


# ======================================================================== scalar families


@register("json_filter_values", "JSON-2,STR-7", """
SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract_string(props, '$.k') AS INTEGER) = 1 AS truthy FROM events""", ("events",))
def _json_filters(t):
    m = F.from_json("props", "map<string,string>")
    k = F.element_at(m, "k").try_cast("int")
    return t.events.select(F.col("event_id").alias("id"), k.alias("k"), (k == 1).alias("truthy"))


@register("rfc3339_times", "DATE-5", """
SELECT id, strftime(created_at, '%Y-%m-%dT%H:%M:%S')
       || CASE WHEN rtrim(strftime(created_at, '%f'), '0') <> '' THEN '.' || rtrim(strftime(created_at, '%f'), '0') ELSE '' END
       || 'Z' AS created FROM stage_events""")
def _rfc3339(t):
    return t.stage_events.select("id", TX.rfc3339("created_at").alias("created"))


@register("normalize_code_lists", "FLT-17,STR-1,STR-7", """
SELECT id, array_to_string(list_filter(list_transform(string_split(' ' || lower(catalog) || ', ,' || state || ' ,' || lower(state), ','),
       lambda x: upper(trim(x))), lambda x: x <> ''), '|') AS codes FROM files""")
def _normalize_lists(t):
    raw = F.concat(F.lit(" "), F.lower("catalog"), F.lit(", ,"), F.col("state"), F.lit(" ,"), F.lower("state"))
    return t.files.select("id", F.array_join(normalize_list_col(raw), "|").alias("codes"))


@register("like_escaped_names", "STR-6,STR-5", r"""
SELECT id, regexp_replace(filename || '%_#', '([%_#])', '#\1', 'g') AS escaped FROM files""")
def _like_escape(t):
    return t.files.select("id", G.escape_like_col(F.concat("filename", F.lit("%_#"))).alias("escaped"))


@register("array_parameter_rows", "SRC-8,SRC-7", """
SELECT file_id, stage, status FROM file_stages""")
def _array_rows(t):
    from ..sources.relations import array_relation

    packed = t.file_stages.groupBy("file_id").agg(  # three rows per file: a bounded group
        F.collect_list(F.struct("stage", "status")).alias("_s"))
    arrays = packed.select("file_id", F.col("_s.stage").alias("stages"), F.col("_s.status").alias("statuses"))
    return array_relation(arrays, ["file_id"], {"stage": "stages", "status": "statuses"})
