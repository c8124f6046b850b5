"""Table schemas, enum orders, known codes and small helpers shared by all operators.

Spark has no enum type: enums are strings, and where the declared order matters we rank them
with ``array_position`` over the declared order (``enum_rank``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# These must equal the pipeline's own definitions for results to match.
# ---------------------------------------------------------------------------------------------

# Enum orders, in declared order.
STAGES = ["download", "csv_conversion", "parquet_conversion"]
STAGE_STATUSES = ["pending", "running", "done", "failed", "purged"]
OVERALL_STATUSES = [
    "pending", "ignored", "downloading", "downloaded",
    "converting_csv", "csv_ready",
    "converting_parquet", "parquet_ready",
    "failed", "purged",
]
QUEUE_STATUSES = ["pending", "running", "done", "failed"]
LOG_EVENTS = ["enqueued", "started", "progress", "completed", "failed", "retrying", "purged"]

# Known catalog codes (policy screen), in the pipeline's order.
KNOWN_CATALOGS = ["AD", "RD", "SP", "AQ", "AM", "BI", "RJ", "PA", "AR", "ER", "PS", "AN"]

# Known state codes (27), in the pipeline's order.
KNOWN_STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA",
    "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI", "RJ", "RN",
    "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]

# Catalog display names.
CATALOG_NAMES = {
    "AD": "APAC de Laudos Diversos",
    "RD": "AIH Reduzida",
    "SP": "Serviços Profissionais",
    "AQ": "APAC de Quimioterapia",
    "AM": "APAC de Medicamentos",
    "BI": "Boletim de Produção Ambulatorial Individualizado",
    "RJ": "AIH Rejeitada",
    "PA": "Produção Ambulatorial",
    "AR": "APAC de Radioterapia",
    "ER": "AIH Rejeitada com código de Erro",
    "PS": "RAAS Psicossocial",
    "AN": "APAC de Nefrologia",
}
CATALOG_UNMAPPED = "Catálogo não mapeado"

# State display names.
STATE_NAMES = {
    "AC": "Acre", "AL": "Alagoas", "AP": "Amapa", "AM": "Amazonas", "BA": "Bahia",
    "CE": "Ceara", "DF": "Distrito Federal", "ES": "Espirito Santo", "GO": "Goias",
    "MA": "Maranhao", "MT": "Mato Grosso", "MS": "Mato Grosso do Sul", "MG": "Minas Gerais",
    "PA": "Para", "PB": "Paraiba", "PR": "Parana", "PE": "Pernambuco", "PI": "Piaui",
    "RJ": "Rio de Janeiro", "RN": "Rio Grande do Norte", "RS": "Rio Grande do Sul",
    "RO": "Rondonia", "RR": "Roraima", "SC": "Santa Catarina", "SP": "Sao Paulo",
    "SE": "Sergipe", "TO": "Tocantins",
}
STATE_UNKNOWN = "UF desconhecida"

# Overall status and stage status display names.
OVERALL_LABELS = {
    "pending": "Pendente",
    "ignored": "Ignorado",
    "downloading": "Baixando",
    "downloaded": "Baixado",
    "converting_csv": "Convertendo para CSV",
    "csv_ready": "CSV pronto",
    "converting_parquet": "Convertendo para Parquet",
    "parquet_ready": "Parquet pronto",
    "failed": "Falhou",
    "purged": "Removido",
    "unknown": "Desconhecido",
}
STAGE_STATUS_LABELS = {
    "pending": "Pendente",
    "running": "Em execução",
    "done": "Concluído",
    "failed": "Falhou",
    "purged": "Removido",
}

# Allowed overall-status transitions (from -> to).
ALLOWED_TRANSITIONS = {
    "pending": ["ignored", "downloading", "failed", "purged"],
    "ignored": ["pending", "purged"],
    "downloading": ["downloaded", "failed", "purged"],
    "downloaded": ["converting_csv", "converting_parquet", "downloading", "failed", "purged"],
    "converting_csv": ["csv_ready", "failed", "purged"],
    "csv_ready": ["converting_parquet", "converting_csv", "failed", "purged"],
    "converting_parquet": ["parquet_ready", "failed", "purged"],
    "parquet_ready": ["converting_parquet", "converting_csv", "downloading", "failed", "purged"],
    "failed": ["downloading", "converting_csv", "converting_parquet", "purged"],
    "purged": [],
}

# Statuses a policy reconcile may move to ignored; stage attempts limit; retry backoff.
RECONCILE_TO_IGNORED = ["pending", "downloaded", "csv_ready"]
MAX_STAGE_ATTEMPTS = 5
RETRY_BASE_SECONDS = 30
RETRY_MAX_SECONDS = 3600
RETRY_JITTER = 0.10
STUCK_TIMEOUT_SECONDS = 30 * 60
LIST_DEFAULT_LIMIT = 50
LIST_MAX_LIMIT = 500
LOG_DEFAULT_LIMIT = 100
AUDIT_DEFAULT_LIMIT = 50
UNKNOWN_ERROR = "Unknown error"
DEFAULT_ACTOR = "ui"

# Texts that reports and alerts carry.
ALERT_MESSAGES = {"failure_spike": "Aumento de falhas na ultima hora", "queue_stalled": "Fila com item pendente antigo"}
BAD_CATALOG = "unknown catalog"
BAD_KEY_FORMAT = "invalid key format"
BAD_YEAR = "invalid year"
BAD_MONTH = "invalid month"
YEAR_OUT_OF_RANGE = "year out of range"
MONTH_OUT_OF_RANGE = "month out of range"

# Histogram bucket bounds, seconds.
JOB_DURATION_BUCKETS = [1, 5, 15, 30, 60, 120, 300, 600]
SCAN_DURATION_BUCKETS = [5, 15, 30, 60, 120, 300]

# ---------------------------------------------------------------------------------------------
# Table schemas.
# ---------------------------------------------------------------------------------------------

FILES = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("catalog", T.StringType(), False),
    T.StructField("state", T.StringType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("segment", T.StringType(), True),
    T.StructField("ftp_dir", T.StringType(), False),
    T.StructField("ftp_path", T.StringType(), False),
    T.StructField("size_bytes", T.LongType(), True),
    T.StructField("remote_checksum", T.StringType(), True),
    T.StructField("remote_timestamp", T.TimestampType(), True),
    T.StructField("local_hash", T.StringType(), True),
    T.StructField("root_path", T.StringType(), False),
    T.StructField("dbc_path", T.StringType(), True),
    T.StructField("csv_path", T.StringType(), True),
    T.StructField("parquet_path", T.StringType(), True),
    T.StructField("overall_status", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
    T.StructField("last_seen_at", T.TimestampType(), True),
])

FILE_STAGES = T.StructType([
    T.StructField("file_id", T.StringType(), False),
    T.StructField("stage", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("attempts", T.IntegerType(), False),
    T.StructField("started_at", T.TimestampType(), True),
    T.StructField("finished_at", T.TimestampType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])

LISTING = T.StructType([
    T.StructField("ftp_dir", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("size", T.LongType(), True),
    T.StructField("mod_time", T.TimestampType(), True),
    T.StructField("remote_path", T.StringType(), False),
])

JOB_QUEUE = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("file_id", T.StringType(), False),
    T.StructField("stage", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("available_at", T.TimestampType(), True),
    T.StructField("locked_at", T.TimestampType(), True),
    T.StructField("attempts", T.IntegerType(), False),
])

LOG_ENTRY = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("file_id", T.StringType(), False),
    T.StructField("stage", T.StringType(), True),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("message", T.StringType(), True),
    T.StructField("payload_json", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), False),
])

AUDIT = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("action", T.StringType(), False),
    T.StructField("stage", T.StringType(), True),
    T.StructField("actor", T.StringType(), True),
    T.StructField("details_json", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), False),
])

# ---------------------------------------------------------------------------------------------
# Helpers.
# ---------------------------------------------------------------------------------------------


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def enum_rank(c: str | Column, order: list[str]) -> Column:
    """1-based position of the value in the declared enum order (0 when unknown)."""
    return F.array_position(F.array(*[F.lit(v) for v in order]), col_of(c))


def pg_asc(c: str | Column) -> Column:
    """Ascending with PostgreSQL's null placement (nulls last)."""
    return col_of(c).asc_nulls_last()


def pg_desc(c: str | Column) -> Column:
    """Descending with PostgreSQL's null placement (nulls first)."""
    return col_of(c).desc_nulls_first()


def pg_bigint(c: str | Column) -> Column:
    """numeric -> bigint cast as PostgreSQL does it: round half away from zero, not truncate."""
    return F.round(col_of(c)).cast("long")


def norm_code(c: str | Column) -> Column:
    """CHAR(n) code as compared by the pipeline: upper(trim(x))."""
    return F.upper(F.trim(col_of(c)))


def as_ts(c: str | Column) -> Column:
    """Session-zone timestamp; the supplied Parquet timestamps are timestamp_ntz."""
    return col_of(c).cast("timestamp")


def values_df(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small inline relation (VALUES list)."""
    return spark.createDataFrame(rows, schema=schema)


def code_table(spark: SparkSession, codes: list[str], name: str = "code") -> DataFrame:
    """Inline relation of codes with their declared position."""
    return spark.createDataFrame([(c, i + 1) for i, c in enumerate(codes)], schema=f"{name} string, pos int")


def ts_lit(value) -> Column:
    """A timestamp literal read in the session time zone (strings and naive datetimes alike)."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if value is None:
        return F.lit(None).cast("timestamp")
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp")
