"""Catalog-shaped views derived from the driver's tables (``orders`` and ``events``).

Each view is one SQL text with ``{name}`` placeholders for its inputs. Spark runs it through
``spark.sql(text, name=DataFrame)`` (so no global temp views are left behind and two scale
factors can live in one session); the DuckDB oracle inlines the same texts as CTEs in
dependency order (``with_views``). The texts avoid ``now()``, randomness and locale so both
engines give equal rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import schemas as S

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: Orders whose file names share a span of years: the next ones name the files of the next seven years,
#: so the catalog grows with the orders up to the hundred years that a name can hold.
KEYS_PER_SPAN = 12_000


def pick(key: str, codes) -> str:
    """SQL for the code that a key falls on."""
    return f"CASE cast({key} % {len(codes)} as int) " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(codes)) + " END"


# The derived views, in dependency order.
VIEWS: dict[str, str] = {
    "listing": f"""
SELECT '/pub/' || catalog AS ftp_dir, name,
       cast(round(o_totalprice) as bigint) AS size, o_orderdate AS mod_time,
       '/pub/' || catalog || '/' || name AS remote_path, o_orderkey AS seq
FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN lower(base) ELSE base END ||
        CASE WHEN o_orderkey % 41 = 0 THEN '.txt' WHEN o_orderkey % 3 = 0 THEN '.dbc' ELSE '.DBC' END AS name
      FROM (SELECT *, catalog || state || lpad(cast(yy as string), 2, '0') ||
                      CASE WHEN o_orderkey % 37 = 0 THEN '13' ELSE lpad(cast(month(o_orderdate) as string), 2, '0') END ||
                      CASE WHEN o_orderkey % 29 = 0 THEN '7' WHEN o_orderkey % 2 = 0 THEN chr(65 + cast(o_orderkey % 26 as int)) ELSE '' END AS base
            FROM (SELECT *, {pick("o_orderkey", S.KNOWN_CATALOGS)} AS catalog, {pick("o_custkey", S.KNOWN_STATES)} AS state,
                         cast(year(o_orderdate) + 7 * floor(o_orderkey / {KEYS_PER_SPAN}) as int) % 100 AS yy FROM {{orders}}) c) a) b
""",
    "files": """
SELECT 'f' || cast(seq as string) AS id, upper(name) AS filename, substr(upper(name),1,2) AS catalog, substr(upper(name),3,2) AS state,
       CASE WHEN cast(substr(name,5,2) as int) <= 26 THEN 2000 ELSE 1900 END + cast(substr(name,5,2) as int) AS year, cast(month(mod_time) as int) AS month,
       CASE WHEN length(name) = 13 THEN substr(upper(name),9,1) END AS segment, ftp_dir, remote_path AS ftp_path,
       CASE WHEN seq % 11 = 0 THEN NULL WHEN seq % 7 = 0 THEN size + 1 ELSE size END AS size_bytes,
       CASE WHEN seq % 13 = 0 THEN NULL ELSE mod_time END AS remote_timestamp,
       '/data' AS root_path,
       CASE WHEN seq % 10 IN (3,4,5,6,7) THEN '/data/' || upper(name) END AS dbc_path,
       CASE WHEN seq % 10 IN (5,6,7) THEN '/data/' || upper(name) || '.csv' END AS csv_path,
       CASE WHEN seq % 10 = 7 THEN CASE WHEN seq % 3 = 0 THEN ' ' ELSE '/data/' || upper(name) || '.parquet' END END AS parquet_path,
       CASE cast(seq % 10 as int) WHEN 0 THEN 'pending' WHEN 1 THEN 'ignored' WHEN 2 THEN 'downloading' WHEN 3 THEN 'downloaded' WHEN 4 THEN 'converting_csv'
            WHEN 5 THEN 'csv_ready' WHEN 6 THEN 'converting_parquet' WHEN 7 THEN 'parquet_ready' WHEN 8 THEN 'failed' ELSE 'purged' END AS overall_status,
       mod_time + INTERVAL 1 DAY AS last_seen_at, mod_time + INTERVAL 2 DAY AS updated_at, seq
FROM (SELECT *, row_number() OVER (PARTITION BY upper(name) ORDER BY seq) AS rn FROM {listing}
      WHERE seq % 41 <> 0 AND seq % 37 <> 0 AND seq % 29 <> 0) d
WHERE rn = 1 AND seq % 9 <> 2
""",
    "file_stages": """
SELECT id AS file_id, stage, CASE WHEN seq % 10 = 7 AND seq % 4 <> 1 THEN 'done'
         WHEN seq % 10 = 9 THEN 'purged'
         ELSE CASE cast((seq * 3 + stage_no) % 4 as int) WHEN 0 THEN 'pending' WHEN 1 THEN 'running' WHEN 2 THEN 'done' ELSE 'failed' END END AS status,
       cast((seq + stage_no) % 6 as int) AS attempts,
       CASE cast((seq + stage_no) % 5 as int) WHEN 0 THEN 'ftp download: timeout' WHEN 1 THEN ' ' WHEN 2 THEN 'init dbc reader: bad header' WHEN 3 THEN NULL ELSE 'ensure dir: denied ' END AS error_message,
       updated_at
FROM {files} CROSS JOIN (SELECT 'download' AS stage, 0 AS stage_no UNION ALL SELECT 'csv_conversion', 1 UNION ALL SELECT 'parquet_conversion', 2) s
WHERE seq % 23 <> 0
""",
    "job_queue": """
SELECT file_id || ':' || stage AS id, file_id, stage, CASE status WHEN 'purged' THEN 'done' ELSE status END AS status,
       updated_at + INTERVAL 1 HOUR AS available_at, CASE WHEN status = 'running' THEN updated_at END AS locked_at, attempts
FROM {file_stages} WHERE attempts <> 0
""",
    "stage_events": """
SELECT event_id AS id, 'f' || cast(user_id as string) AS file_id,
       CASE cast(event_id % 3 as int) WHEN 0 THEN 'download' WHEN 1 THEN 'csv_conversion' ELSE 'parquet_conversion' END AS stage,
       CASE event_type WHEN 'view' THEN 'enqueued' WHEN 'click' THEN 'started' WHEN 'signup' THEN 'progress' WHEN 'purchase' THEN 'completed' ELSE 'failed' END AS event_type,
       event_type AS message, props AS payload_json, cast(round(value * 10) as bigint) AS duration_ms, ts AS created_at
FROM {events}
""",
    # how many of a file's stages are done, and how many of those before the last one
    "progress": """
SELECT file_id, count(DISTINCT CASE WHEN status = 'done' THEN stage END) AS done_stages,
       count(DISTINCT CASE WHEN status = 'done' AND stage <> 'parquet_conversion' THEN stage END) AS done_before_last
FROM {file_stages} GROUP BY file_id
""",
    "policy_catalogs": "SELECT * FROM (VALUES ('RD'),('SP'),('AD'),('AQ'),('PA')) AS t(catalog)",
    "policy_states": "SELECT * FROM (VALUES ('SP'),('RJ'),('MG'),('AC'),('BA'),('TO'),('PE'),('DF')) AS t(state)",
    "policy_years": "SELECT * FROM (VALUES (1997),(2000)) AS t(year)",
    "policy_months": "SELECT * FROM (VALUES (1998,3),(1999,12),(1996,1)) AS t(year, month)",
    "policy_config": (
        "SELECT 1 AS id, true AS enable_download, true AS enable_csv, true AS enable_parquet, "
        "cast(NULL AS string) AS download_dir, cast(NULL AS string) AS csv_dir, cast(NULL AS string) AS parquet_dir"
    ),
    "status_history": """
SELECT 'f' || cast(user_id as string) AS file_id,
       CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'downloading' WHEN 'signup' THEN 'downloaded'
            WHEN 'purchase' THEN 'parquet_ready' ELSE 'failed' END AS status, ts AS changed_at, event_id AS seq
FROM {events}
""",
    "artifacts": """
SELECT csv_path AS path FROM {files} WHERE csv_path IS NOT NULL AND seq % 6 <> 0
UNION ALL SELECT parquet_path FROM {files} WHERE parquet_path IS NOT NULL AND trim(parquet_path) <> ''
UNION ALL SELECT dbc_path FROM {files} WHERE dbc_path IS NOT NULL AND seq % 8 <> 3
""",
    "selection_keys": (
        "SELECT * FROM (VALUES ('catalog','PNI'),('catalog','UNKNOWN'),('year','CNES:2024'),('year','SIH:2024'),"
        "('year','SIA:9999'),('year','broken-year-key'),('month','SIH:2024:02'),('month','SIH:2024:02'),"
        "('month','SIM:2025:07'),('month','SIM:2024:13'),('month','bad')) AS t(level, value)"
    ),
}

_REF = re.compile(r"\{(\w+)\}")


def deps(name: str) -> list[str]:
    return _REF.findall(VIEWS[name])


def _closure(names) -> list[str]:
    """Views needed by ``names``, in dependency (declaration) order."""
    need: set[str] = set()

    def visit(n: str) -> None:
        if n in need or n in BASE_TABLES:
            return
        for d in deps(n):
            visit(d)
        need.add(n)

    for n in names:
        visit(n)
    return [v for v in VIEWS if v in need]


def with_views(tail_sql: str, views) -> str:
    """Self-contained DuckDB SQL: the needed views as CTEs, then ``tail_sql``.

    ``tail_sql`` may start with its own ``WITH``; its CTEs are appended after the views.
    """
    ordered = _closure(views)
    ctes = ",\n".join(f"{v} AS ({_REF.sub(lambda m: m.group(1), VIEWS[v]).strip()})" for v in ordered)
    tail = tail_sql.strip()
    if not ctes:
        return tail
    if tail[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{tail[5:]}"
    return f"WITH {ctes}\n{tail}"


# Views big enough to store: they stand for the catalog's stored tables.
STORED_VIEWS = ("listing", "files", "file_stages", "job_queue", "stage_events", "status_history", "artifacts")


class Tables:
    """Lazily loaded base tables and derived views of one scale-factor directory.

    With ``materialize`` the derived catalog views are written once per session as Parquet under
    the cluster's checkpoint folder and read back, so every query scans stored tables (with
    column pruning and filter pushdown) the way it would scan the live catalog, instead of
    re-deriving them from ``orders``/``events``.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool | None = None):
        import os

        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}
        if materialize is None:
            materialize = os.environ.get("FEEDLEDGER_MATERIALIZE_VIEWS", "1") != "0"
        self.materialize = materialize
        self._store: str | None = None

    def store_root(self) -> str:
        if self._store is None:
            import uuid

            from .session import ensure_checkpoint_dir

            self._store = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/feedledger-views-{uuid.uuid4().hex[:12]}"
        return self._store

    def materialize_all(self) -> None:
        """Store every derived view, running independent views of each dependency wave as
        concurrent Spark jobs (they share the cluster instead of queueing one after another)."""
        from concurrent.futures import ThreadPoolExecutor

        done: set[str] = set(self._cache)
        todo = [v for v in STORED_VIEWS if v not in done]
        while todo:
            ready = [v for v in todo if all(d in done or d in BASE_TABLES or d not in STORED_VIEWS for d in deps(v))]
            with ThreadPoolExecutor(max_workers=max(1, len(ready))) as pool:
                list(pool.map(self.get, ready))
            done.update(ready)
            todo = [v for v in todo if v not in done]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in VIEWS:
                inputs = {d: self.get(d) for d in deps(name)}
                df = self.spark.sql(VIEWS[name], **inputs)
                if self.materialize and name in STORED_VIEWS:
                    path = f"{self.store_root()}/{name}"
                    df.write.mode("overwrite").parquet(path)
                    df = self.spark.read.parquet(path)
            else:
                raise KeyError(name)
            self._cache[name] = df
        return self._cache[name]


_TABLES: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, sf_dir)
    return _TABLES[key]
