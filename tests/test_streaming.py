"""Streaming jobs: watermark semantics and stream = batch."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from feedledger.operators import stages as ST
from feedledger.streaming import jobs as SJ
from feedledger.streaming import keyed as K

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _events(spark, rows):
    return spark.createDataFrame(
        [(i, f, s, e, e, None, 10, T0 + dt.timedelta(minutes=m)) for i, (f, s, e, m) in enumerate(rows)], SJ.EVENT_SCHEMA)


def test_failure_windows_append_emits_closed_hours(spark, tmp_dir):
    rows = [("f", "download", "failed", m) for m in (1, 2, 3, 70, 71, 300, 360)]
    _events(spark, rows[:3]).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/ev")
    _events(spark, rows[3:6]).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/ev")
    _events(spark, rows[6:]).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/ev")
    stream = SJ.read_events(spark, f"{tmp_dir}/ev", max_files=1)
    out = SJ.run_available_now(SJ.failure_windows(stream, delay="1 hour"), "fw_" + uuid.uuid4().hex[:6], "append")
    got = {r["hour"]: r["failures"] for r in out.collect()}
    # after the second batch the watermark is 04:00 (max 05:00 - 1 h), so the third batch emits the
    # closed hours 00:00 and 01:00; 05:00 and 06:00 are still open
    assert got == {dt.datetime(2024, 1, 1, 0): 3, dt.datetime(2024, 1, 1, 1): 2}


def test_stream_summary_equals_batch(spark, tmp_dir):
    rows = [("f", "download", e, m) for m, e in enumerate(["enqueued", "started", "failed", "retrying", "started", "completed"])]
    rows += [("g", "csv_conversion", "started", 1), ("g", "csv_conversion", "progress", 2)]
    ev = _events(spark, rows)
    ev.repartition(4).write.parquet(f"{tmp_dir}/ev")
    s = SJ.run_available_now(SJ.stage_state_summary(SJ.read_events(spark, f"{tmp_dir}/ev", max_files=1)),
                             "ss_" + uuid.uuid4().hex[:6], "complete")
    b = ST.latest_stage_state(ev)
    got = {(r["file_id"], r["stage"]): (r["status"], r["starts"]) for r in s.collect()}
    want = {(r["file_id"], r["stage"]): (r["status"], r["starts"]) for r in b.collect()}
    assert got == want == {("f", "download"): ("done", 2), ("g", "csv_conversion"): ("running", 1)}


def test_dedupe(spark, tmp_dir):
    ev = _events(spark, [("f", "download", "started", 1), ("f", "download", "completed", 2)])
    ev.write.mode("append").parquet(f"{tmp_dir}/ev")
    ev.write.mode("append").parquet(f"{tmp_dir}/ev")
    out = SJ.run_available_now(SJ.dedupe_events(SJ.read_events(spark, f"{tmp_dir}/ev", max_files=1)),
                               "dd_" + uuid.uuid4().hex[:6], "append")
    assert out.count() == 2


def _started(start):
    q = start()
    q.awaitTermination()
    assert q.exception() is None


def _add(spark, folder, rows, first=0):
    _events(spark, rows).withColumn("id", F.col("id") + first).coalesce(1).write.mode("append").parquet(folder)


def test_stage_fold_goes_on_after_a_restart(spark, tmp_dir):
    from feedledger import schemas as S

    base = spark.createDataFrame([], S.FILE_STAGES)
    start = lambda: K.start_stage_fold(spark, f"{tmp_dir}/ev", f"{tmp_dir}/state", max_files=1)
    assert K.stage_summaries(spark, f"{tmp_dir}/state").count() == 0  # nothing has run yet
    _add(spark, f"{tmp_dir}/ev", [("f", "download", "started", 1), ("f", "download", "progress", 9)])
    _started(start)
    _add(spark, f"{tmp_dir}/ev", [("f", "download", "completed", 2), ("g", "download", "failed", 3)], 10)
    _add(spark, f"{tmp_dir}/ev", [("h", "download", "started", 4), ("f", "download", "started", 0)], 20)  # the last one comes late
    _started(start)
    _started(start)  # nothing new
    events = spark.read.schema(SJ.EVENT_SCHEMA).parquet(f"{tmp_dir}/ev")
    got, want = K.stage_summaries(spark, f"{tmp_dir}/state"), ST.latest_stage_state(events)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    out = K.folded_stages(spark, f"{tmp_dir}/state", base).collect()
    assert sorted((r["file_id"], r["status"], r["attempts"]) for r in out) == [("f", "done", 2), ("g", "failed", 0), ("h", "running", 1)]


def test_stage_fold_starts_from_a_batch_summary(spark, tmp_dir):
    old = _events(spark, [("f", "download", "started", 5), ("z", "download", "failed", 6)])
    _add(spark, f"{tmp_dir}/ev", [("f", "download", "completed", 4), ("f", "download", "started", 7)], 10)
    _started(lambda: K.start_stage_fold(spark, f"{tmp_dir}/ev", f"{tmp_dir}/state", initial=ST.latest_stage_state(old)))
    got = {r["file_id"]: (r["status"], r["starts"], r["last_event_id"]) for r in K.stage_summaries(spark, f"{tmp_dir}/state").collect()}
    assert got == {"f": ("running", 2, 11), "z": ("failed", 0, 1)}


def test_stage_fold_forgets_after_its_time_to_live(spark, tmp_dir):
    import time

    start = lambda ttl: K.start_stage_fold(spark, f"{tmp_dir}/ev{ttl}", f"{tmp_dir}/state{ttl}", ttl_seconds=ttl)
    for ttl in (1, 3600):
        _add(spark, f"{tmp_dir}/ev{ttl}", [("f", "download", "started", 1)])
        _started(lambda ttl=ttl: start(ttl))
    time.sleep(1.5)
    assert K.stage_summaries(spark, f"{tmp_dir}/state1").count() == 0
    assert K.stage_summaries(spark, f"{tmp_dir}/state3600").count() == 1


def test_a_hot_key_leaves_one_row_a_batch(spark):
    import pandas as pd

    rows = [("f", "download", "started" if i % 2 else "failed", None, i, i) for i in range(1000)] + [("g", "download", "progress", None, 1, 1)]
    out = list(K._reduced(iter([pd.DataFrame(rows, columns=["file_id", "stage", "event_type", "message", "t", "id"])])))
    assert [len(x) for x in out] == [1]
    assert out[0].iloc[0][["last_event", "id", "starts", "last_started"]].tolist() == ["started", 999, 500, 999]


def test_alerts_judge_an_hour_once_over_restarts(spark, tmp_dir):
    ev, out = f"{tmp_dir}/ev", f"{tmp_dir}/out"
    start = lambda: K.start_hour_alerts(spark, ev, out, f"{tmp_dir}/state", delay="1 hour", max_files=1)
    hours = lambda: sorted((r["hour"].hour, r["failures"], r["previous"], r["spike"]) for r in K.judged_hours(spark, out).collect())
    _add(spark, ev, [("f", "download", "failed", 1)] * 2)
    _started(start)
    assert hours() == []  # the hour is open
    _add(spark, ev, [("f", "download", "failed", 2), *[("g", "download", "failed", 70)] * 11])
    _started(start)
    _add(spark, ev, [("g", "download", "started", 200)])  # 03:20: hours 0 and 1 are closed by an event of another kind
    _started(start)
    assert hours() == [(0, 3, None, False), (1, 11, 3, True)]
    _add(spark, ev, [("f", "download", "failed", 3), *[("f", "download", "failed", 250)] * 12])  # the first is too late
    _add(spark, ev, [("g", "download", "started", 500)])
    _started(start)
    assert hours() == [(0, 3, None, False), (1, 11, 3, True), (4, 12, 11, False)]


def test_stage_fold_calls_take_buckets_of_pairs(spark, tmp_dir):
    pairs = [(f"f{i}", s, e, i % 50) for i in range(1500) for s, e in (("download", "started"), ("csv_conversion", "failed"))]
    _add(spark, f"{tmp_dir}/ev", pairs)
    _add(spark, f"{tmp_dir}/ev", [(f, s, "completed", 60) for f, s, _, _ in pairs if s == "download"], 10_000)
    _started(lambda: K.start_stage_fold(spark, f"{tmp_dir}/ev", f"{tmp_dir}/state", max_files=1))
    groups = spark.read.format("statestore").option("path", f"{tmp_dir}/state").option("stateVarName", "summary").load().select("key").distinct().count()
    assert groups <= K.SUMMARY_BUCKETS
    got = K.stage_summaries(spark, f"{tmp_dir}/state")
    want = ST.latest_stage_state(spark.read.schema(SJ.EVENT_SCHEMA).parquet(f"{tmp_dir}/ev"))
    assert got.count() == 3000 and got.exceptAll(want.select(*got.columns)).isEmpty()
