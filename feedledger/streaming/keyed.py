"""Keyed state for the stage summaries (STM-2) and the failure alerts (STM-3).

Both streams use Spark's arbitrary state API: typed state variables per key in the state store, which
keeps versions, recovers and compacts by itself. A stateless reduction in each input task comes first,
so a hot key sends a few rows per task through the shuffle. The stage summaries are kept in a map state
per bucket of (file, stage): a call of the processor takes a bucket's rows, not those of one pair, whose
frames and calls would cost far more than its fold. The checkpoint folder is the only place
where state is kept: a later start goes on from it, and ``stage_summaries`` reads it back as a table.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import schemas as S
from ..operators import stages as ST

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SUMMARY_KEY = "file_id string, stage string"
SUMMARY_VALUE = "last_event string, last_message string, t long, id long, starts long, last_started long"
SUMMARY = f"{SUMMARY_KEY}, {SUMMARY_VALUE}"
SUMMARY_COLUMNS = [c.split()[0] for c in SUMMARY.split(", ")]
#: Groups of (file, stage) pairs that share a call; fixed, as the state is kept by them.
SUMMARY_BUCKETS = 1024
HOUR = "hour timestamp, failures long, previous long, spike boolean"


@contextmanager
def state_store(spark: SparkSession, empty_batches: bool = True):
    """Queries started inside keep their state in RocksDB, which typed state needs. A query on
    processing time must not get batches without data: it would never have seen all that is available."""
    wanted = {PROVIDER: ROCKSDB, EMPTY_BATCHES: str(empty_batches).lower()}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ------------------------------------------------------------------------- stage state (STM-2)


def _reduced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per (file, stage) of an Arrow batch: the newest status-changing event, starts, last start."""
    keys = ["file_id", "stage"]
    for events in batches:
        own = events[events["event_type"].isin(list(ST.EVENT_STATUS))]
        if own.empty:
            continue
        begun = own[own["event_type"] == "started"].groupby(keys, sort=False)["t"].agg(starts="size", last_started="max")
        last = own.sort_values(["t", "id"]).drop_duplicates(keys, keep="last").set_index(keys)
        out = last.join(begun).reset_index().rename(columns={"event_type": "last_event", "message": "last_message"})
        out["starts"] = out["starts"].fillna(0).astype("int64")
        out["last_started"] = out["last_started"].astype("Int64")
        yield out[["file_id", "stage", "last_event", "last_message", "t", "id", "starts", "last_started"]]


def _none(value):
    return None if pd.isna(value) else value


def _folded(now: tuple | None, new: tuple) -> tuple:
    """A summary (None: nothing yet) with a further partial summary of the same key."""
    if now is None:
        return new
    newest = new if new[2:4] > now[2:4] else now
    begun = [x for x in (now[5], new[5]) if x is not None]
    return (*newest[:4], now[4] + new[4], max(begun, default=None))


class StageSummaries(StatefulProcessor):
    """Newest status-changing event and starts of every (file, stage) of a bucket, as a map state that
    is read and written for the pairs with rows only."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.summaries = handle.getMapState("summary", SUMMARY_KEY, SUMMARY_VALUE, self.ttl_ms)

    def _fold(self, frames: Iterator[pd.DataFrame]) -> dict[tuple, tuple]:
        touched: dict[tuple, tuple] = {}
        for rows in frames:
            for file_id, stage, event, message, t, i, starts, last_started in rows[SUMMARY_COLUMNS].itertuples(index=False, name=None):
                key = (_none(file_id), _none(stage))
                if key not in touched:
                    touched[key] = tuple(self.summaries.getValue(key)) if self.summaries.containsKey(key) else None
                touched[key] = _folded(touched[key], (event, _none(message), int(t), int(i), int(starts), None if pd.isna(last_started) else int(last_started)))
        for key, now in touched.items():
            self.summaries.updateValue(key, now)
        return touched

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        touched = self._fold(rows)
        if touched:
            out = pd.DataFrame([(*pair, *now) for pair, now in touched.items()], columns=SUMMARY_COLUMNS)
            out["last_started"] = out["last_started"].astype("Int64")
            yield out

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._fold(iter([initialState]))

    def close(self) -> None:
        pass


def _bucketed(summaries: DataFrame) -> GroupedData:
    return summaries.withColumn("bucket", F.pmod(F.hash("file_id", "stage"), F.lit(SUMMARY_BUCKETS))).groupBy("bucket")


def partial_summaries(summary: DataFrame) -> DataFrame:
    """``stages.latest_stage_state`` rows in the form of the state."""
    return summary.select("file_id", "stage", "last_event", "last_message", F.unix_micros("last_event_at").alias("t"), F.col("last_event_id").alias("id"),
                          F.col("starts").cast("long").alias("starts"), F.unix_micros("last_started").alias("last_started"))


def stage_state(events: DataFrame, initial: DataFrame | None = None, ttl_seconds: int | None = None) -> DataFrame:
    """STM-2: the running summary of every (file, stage) that a batch touches (update mode).

    ``initial`` (``stages.latest_stage_state`` of the events before the stream) is loaded on the very
    first start. With ``ttl_seconds`` a key that gets no event for so long (processing time) leaves
    the state.
    """
    slim = events.select("id", "file_id", "stage", "event_type", "message", F.unix_micros("created_at").alias("t"))
    reduced = slim.mapInPandas(_reduced, SUMMARY)
    start = None if initial is None else _bucketed(partial_summaries(initial))
    return _bucketed(reduced).transformWithStateInPandas(
        StageSummaries(None if ttl_seconds is None else 1000 * ttl_seconds), SUMMARY, "Update", "None" if ttl_seconds is None else "ProcessingTime", start)


def start_stage_fold(spark: SparkSession, events_dir: str, checkpoint: str, max_files: int | None = None,
                     initial: DataFrame | None = None, ttl_seconds: int | None = None):
    """STM-2: fold an event file stream into the state below ``checkpoint`` (available-now)."""
    from .jobs import read_events

    with state_store(spark, empty_batches=ttl_seconds is None):
        folded = stage_state(read_events(spark, events_dir, max_files=max_files), initial, ttl_seconds)
        return folded.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _committed(spark: SparkSession, checkpoint: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(path) and any(st.getPath().getName().isdigit() for st in fs.listStatus(path))


def stage_summaries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stream's state as a table (``stages.latest_stage_state`` columns), read from the state
    store's files; no query needs to run. Keys past their time to live are left out."""
    if not _committed(spark, checkpoint):
        rows = spark.createDataFrame([], SUMMARY)
    else:
        state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "summary").load()
        held = [f.name for f in state.schema["user_map_value"].dataType.fields]
        if "ttlExpirationMs" in held:
            state = state.where(F.col("user_map_value.ttlExpirationMs") > F.lit(int(time.time() * 1000))).withColumn("user_map_value", F.col("user_map_value.value"))
        rows = state.select("user_map_key.*", "user_map_value.*")
    at = lambda c: F.timestamp_micros(c)
    return rows.select("file_id", "stage", ST.event_status("last_event").alias("status"), "last_event", "last_message", at("t").alias("last_event_at"),
                       F.col("id").alias("last_event_id"), "starts", at("last_started").alias("last_started"))


def folded_stages(spark: SparkSession, checkpoint: str, stages: DataFrame) -> DataFrame:
    """The stage table with the stream's events applied (UPD-6)."""
    return ST.apply_stage_summary(stages, stage_summaries(spark, checkpoint))


# ------------------------------------------------------------------------------ alerts (STM-3)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Failures per hour of an Arrow batch, and the hour of its newest event (with none, perhaps), so
    that the watermark moves with all events."""
    for events in batches:
        if events.empty:
            continue
        hours = events["created_at"].dt.floor("h")
        counts = (events["event_type"] == "failed").groupby(hours).sum()
        counts = counts[(counts > 0) | (counts.index == hours.max())]
        yield pd.DataFrame({"hour": counts.index, "failures": counts.to_numpy("int64")})


class HourAlerts(StatefulProcessor):
    """Failures of the open hours; a timer at an hour's end judges it once, against the hour with
    failures before it."""

    def __init__(self, min_failures: int):
        self.min_failures = min_failures

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "hour long", "failures long")
        self.before = handle.getValueState("before", "failures long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for hour, n in frame.groupby("hour")["failures"].sum().items():
                ms = int(hour.timestamp() * 1000)
                if n > 0 and ms + 3_600_000 > timerValues.getCurrentWatermarkInMs():  # a judged hour stays as it is
                    if not self.open.containsKey((ms,)):
                        self.handle.registerTimer(ms + 3_600_000)
                        self.open.updateValue((ms,), (int(n),))
                    else:
                        self.open.updateValue((ms,), (self.open.getValue((ms,))[0] + int(n),))
        yield pd.DataFrame({"hour": pd.Series(dtype="datetime64[ns]"), "failures": pd.Series(dtype="int64"), "previous": pd.Series(dtype="Int64"), "spike": pd.Series(dtype="bool")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ms = expiredTimerInfo.getExpiryTimeInMs() - 3_600_000
        n = self.open.getValue((ms,))[0]
        previous = self.before.get()[0] if self.before.exists() else None
        self.open.removeKey((ms,))
        self.before.update((n,))
        yield pd.DataFrame({"hour": [pd.Timestamp(ms, unit="ms")], "failures": [n], "previous": pd.array([previous], dtype="Int64"),
                            "spike": [n > 2 * (previous or 0) and n > self.min_failures]})

    def close(self) -> None:
        pass


def hour_alerts(events: DataFrame, delay: str = "2 hours", min_failures: int = 10) -> DataFrame:
    """STM-3: hour, failures, previous, spike of every hour with failures, once, when the watermark
    has passed its end (append mode). An event that comes later than ``delay`` after the newest
    changes nothing that was judged. One key holds a few open hours; input tasks send it their
    hourly counts, not their events."""
    hours = events.select("event_type", "created_at").mapInPandas(_counted, "hour timestamp, failures long").withWatermark("hour", delay)
    return hours.withColumn("series", F.lit("failures")).groupBy("series").transformWithStateInPandas(HourAlerts(min_failures), HOUR, "Append", "EventTime")


def start_hour_alerts(spark: SparkSession, events_dir: str, out_dir: str, checkpoint: str, delay: str = "2 hours",
                      min_failures: int = 10, max_files: int | None = None):
    """STM-3: judged hours of an event file stream, appended to the Parquet table ``out_dir`` exactly
    once (available-now)."""
    from .jobs import read_events

    with state_store(spark):
        judged = hour_alerts(read_events(spark, events_dir, max_files=max_files), delay, min_failures)
        return (judged.writeStream.format("parquet").outputMode("append").option("path", out_dir).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())


def judged_hours(spark: SparkSession, out_dir: str) -> DataFrame:
    """The hours judged so far (S.as_ts keeps the session's time zone out of it)."""
    return spark.read.schema(HOUR).parquet(out_dir).withColumn("hour", S.as_ts("hour"))
