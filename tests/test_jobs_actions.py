"""Job-table and action semantics on small hand-made tables."""

import datetime as dt

from pyspark.sql import functions as F

from feedledger import schemas as S
from feedledger.operators import actions as A
from feedledger.operators import jobs as J

T0 = dt.datetime(2026, 1, 1, 12, 0, 0)
Q = "id string, file_id string, stage string, status string, available_at timestamp, locked_at timestamp, attempts int"
ST_SCHEMA = ("file_id string, stage string, status string, attempts int, started_at timestamp, finished_at timestamp, "
             "error_message string, updated_at timestamp")


def test_upsert_queue_leaves_running_alone(spark):
    q = spark.createDataFrame([("f1:download", "f1", "download", "running", T0, T0, 2),
                               ("f2:download", "f2", "download", "failed", T0, None, 5)], Q)
    req = spark.createDataFrame([("f1", "download"), ("f2", "download"), ("f3", "download"), ("f3", "download")],
                                "file_id string, stage string")
    out, counts = J.upsert_queue(q, req, T0 + dt.timedelta(hours=1))
    rows = {r["id"]: r for r in out.collect()}
    assert rows["f1:download"]["status"] == "running" and rows["f1:download"]["attempts"] == 2
    assert rows["f2:download"]["status"] == "pending" and rows["f2:download"]["attempts"] == 0
    assert rows["f3:download"]["status"] == "pending" and len(rows) == 3
    c = counts.first()
    assert (c["affected"], c["kept_running"]) == (2, 1)


def test_recover_stuck(spark):
    q = spark.createDataFrame([("a", "f", "download", "running", T0, T0 - dt.timedelta(hours=1), 1),
                               ("b", "g", "download", "running", T0, T0 - dt.timedelta(minutes=5), 1)], Q)
    out, c = J.recover_stuck(q, T0)
    rows = {r["id"]: r for r in out.collect()}
    assert rows["a"]["status"] == "pending" and rows["a"]["locked_at"] is None
    assert rows["b"]["status"] == "running" and c.first()["recovered"] == 1


def test_ack_and_apply_retries(spark):
    q = spark.createDataFrame([("a", "f", "download", "running", T0, T0, 1), ("b", "g", "download", "running", T0, T0, 5)], Q)
    st = spark.createDataFrame([("f", "download", "running", 1, T0, None, None, T0),
                                ("g", "download", "running", 5, T0, None, None, T0)], ST_SCHEMA)
    q2, s2 = J.ack(q, st, spark.createDataFrame([("a", "f", "download")], "id string, file_id string, stage string"), T0)
    assert {r["id"]: r["status"] for r in q2.collect()}["a"] == "done"
    assert {r["file_id"]: r["status"] for r in s2.collect()} == {"f": "done", "g": "running"}
    fails = spark.createDataFrame([("b", "g", "download", 5, "boom")], "id string, file_id string, stage string, attempts int, error string")
    plan = J.plan_retries(fails, T0)
    q3, s3 = J.apply_retries(q2, s2, plan, T0)
    assert {r["id"]: r["status"] for r in q3.collect()}["b"] == "failed"
    g = [r for r in s3.collect() if r["file_id"] == "g"][0]
    assert g["status"] == "failed" and g["error_message"] == "boom" and g["finished_at"] is not None


def test_purge_is_idempotent(spark):
    files = spark.createDataFrame(
        [("f1", "A.DBC", "csv_ready", "/d/a", "/c/a", None, T0), ("f2", "B.DBC", "purged", None, None, None, T0)],
        "id string, filename string, overall_status string, dbc_path string, csv_path string, parquet_path string, updated_at timestamp")
    st = spark.createDataFrame([("f1", s, "done", 1, None, None, None, T0) for s in S.STAGES], ST_SCHEMA)
    f2, s2, logs, paths = A.purge(files, st, files.select("id"), T0)
    assert {r["id"]: r["overall_status"] for r in f2.collect()} == {"f1": "purged", "f2": "purged"}
    assert f2.where(F.col("id") == "f1").first()["dbc_path"] is None
    assert {r["status"] for r in s2.collect()} == {"purged"}
    assert logs.count() == 1  # the already purged file is a no-op
    assert sorted(r["path"] for r in paths.collect()) == ["/c/a", "/d/a"]
