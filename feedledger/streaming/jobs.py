"""Structured Streaming forms of the pipeline's polling loops (STM-1..5; the landing merge is in
``landing``, keyed state in ``keyed``).

The transformations are the batch operators; only sources, sinks, watermarks and state are
stream-specific. Every sink keeps its stream checkpoint beside its output, under one fixed name, so a
second start goes on where the first one ended; a batch that is delivered again is consumed and
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import jobs as J
from ..operators import stages as ST

EVENT_SCHEMA = ("id long, file_id string, stage string, event_type string, message string, payload_json string, "
                "duration_ms long, created_at timestamp")


def checkpoint_location(state_root: str, name: str) -> str:
    """Where a sink's progress is kept: fixed by the state folder and the sink's name."""
    return f"{state_root.rstrip('/')}/_streams/{name}"


class Folder:
    """A sink's batches below one folder of any Hadoop file system, as ``{table}/v=N``. A batch counts
    once its writer has committed it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self, table: str) -> list[int]:
        at = self._path(f"{self.root}/{table}")
        if not self._fs.exists(at):
            return []
        names = [st.getPath().getName() for st in self._fs.listStatus(at)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("v=") and self._fs.exists(self._path(f"{self.root}/{table}/{n}/_SUCCESS")))

    def write(self, table: str, version: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/v={version}")

    def drop(self, table: str, upto: int) -> None:
        for v in self.versions(table):
            if v <= upto:
                self._fs.delete(self._path(f"{self.root}/{table}/v={v}"), True)


def consume(batch: DataFrame) -> None:
    """Run a batch that is not used: a stateful query must commit its state stores."""
    batch.write.format("noop").mode("overwrite").save()


def read_events(spark: SparkSession, path: str, schema: str = EVENT_SCHEMA, max_files: int | None = None) -> DataFrame:
    """A stream of stage events from Parquet files landing in ``path``."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path).withColumn("created_at", S.as_ts("created_at"))


def run_available_now(df: DataFrame, name: str, mode: str = "append", root: str | None = None) -> DataFrame:
    """Run a streaming query over everything available into versioned Parquet tables and return the
    result: all batches (append, update) or the last one (complete). With the same ``root`` a later
    call goes on where this one ended. No row passes through the driver."""
    import uuid

    from ..session import ensure_checkpoint_dir

    spark = df.sparkSession
    root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/feedledger-sink-{uuid.uuid4().hex[:12]}"
    schema = df.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        out = Folder(batch.sparkSession, root)
        if batch_id in out.versions(name):
            consume(batch)
            return
        out.write(name, batch_id, batch)
        if mode == "complete":
            out.drop(name, batch_id - 1)

    q = (df.writeStream.foreachBatch(write).outputMode(mode).queryName(name)
         .option("checkpointLocation", checkpoint_location(root, name)).trigger(availableNow=True).start())
    q.awaitTermination()
    versions = Folder(spark, root).versions(name)
    if not versions:
        return spark.createDataFrame([], schema)
    if mode == "complete":
        versions = versions[-1:]
    return spark.read.schema(schema).parquet(*(f"{root}/{name}/v={v}" for v in versions))


# ----------------------------------------------------------------------------- STM-5 dedupe


def dedupe_events(events: DataFrame, delay: str = "1 hour", id_col: str = "id") -> DataFrame:
    """STM-5: idempotent delivery -- drop re-delivered events (same id) within the watermark."""
    return events.withWatermark("created_at", delay).dropDuplicatesWithinWatermark([id_col])


# ------------------------------------------------------------------------ STM-2 stage state


def stage_state_summary(events: DataFrame) -> DataFrame:
    """STM-2: running per-(file, stage) summary -- newest status-changing event (max_by on
    (time, id)), starts count -- as a streaming aggregate (update or complete mode). The summary
    is associative, so any split into micro-batches gives the batch result."""
    changing = events.where(F.col("event_type").isin(list(ST.EVENT_STATUS)))
    key = F.struct(F.col("created_at").alias("t"), F.col("id").alias("i"))
    payload = F.struct("event_type", "message", "created_at")
    return changing.groupBy("file_id", "stage").agg(
        F.max_by(payload, key).alias("last"),
        F.count_if(F.col("event_type") == "started").alias("starts"),
    ).select("file_id", "stage", ST.event_status(F.col("last.event_type")).alias("status"),
             F.col("last.event_type").alias("last_event"), F.col("last.created_at").alias("last_event_at"), "starts")


# ----------------------------------------------------------------------------- STM-3 alerts


def failure_windows(events: DataFrame, delay: str = "2 hours", width: str = "1 hour") -> DataFrame:
    """STM-3: failures per tumbling hour with a watermark, so closed hours are final and old
    state is dropped."""
    return (events.where(F.col("event_type") == "failed").withWatermark("created_at", delay)
            .groupBy(F.window("created_at", width).alias("w")).agg(F.count(F.lit(1)).alias("failures"))
            .select(F.col("w.start").alias("hour"), "failures"))


# ------------------------------------------------------------------------ STM-4 queue depth


def queue_depth_stream(queue_rows: DataFrame) -> DataFrame:
    """STM-4: jobs per (stage, status) as a streaming aggregate (complete mode)."""
    return J.depth(queue_rows)
