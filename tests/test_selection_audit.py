"""Selection expansion, transition audit, skew-safe ordered lag, retries."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from feedledger.operators import audit as AU
from feedledger.operators import jobs as J
from feedledger.operators import selection as SEL


def _keys(spark, rows):
    return spark.createDataFrame(rows, "level string, value string")


def test_selection_expansion(spark):
    y = 2026
    assert SEL.build_download_jobs(_keys(spark, [("catalog", "CNES")]), y).count() == (y + 1) * 12
    assert SEL.build_download_jobs(_keys(spark, [("year", "SIH:2024")]), y).count() == 12
    mixed = _keys(spark, [("catalog", "CNES"), ("year", "CNES:2024"), ("year", "SIH:2024"), ("month", "SIH:2024:02"),
                          ("month", "SIH:2024:02"), ("month", "SIM:2025:07")])
    assert SEL.build_download_jobs(mixed, y).count() == (y + 1) * 12 + 12 + 1
    bad = _keys(spark, [("catalog", "UNKNOWN"), ("year", "SIA:2019"), ("year", "broken-year-key"),
                        ("month", "SIM:2024:13"), ("month", "bad")])
    inv = {(r["value"], r["reason"]) for r in SEL.invalid_selections(bad, y).collect()}
    assert inv == {("UNKNOWN", "unknown catalog"), ("broken-year-key", "invalid key format"),
                   ("SIM:2024:13", "month out of range"), ("bad", "invalid key format")}


def test_compact_and_remove(spark):
    months = spark.createDataFrame([(2020, m) for m in range(1, 13)] + [(2021, 3)], "year int, month int")
    years = spark.createDataFrame([], "year int")
    ny, nm = SEL.compact_periods(years, months)
    assert [r[0] for r in ny.collect()] == [2020] and [tuple(r) for r in nm.collect()] == [(2021, 3)]
    ry, rm = SEL.remove_month(ny, nm, 2020, 5)
    assert ry.count() == 0 and rm.count() == 12 and rm.where("year = 2020 AND month = 5").count() == 0


def test_ordered_previous_matches_window_lag_with_hot_key(spark):
    rows = [("hot", i, f"s{i % 7}") for i in range(3000)] + [(f"k{j}", i, f"s{i}") for j in range(50) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, t long, v string")
    got = AU.ordered_previous(df, ["k"], ["t"], ["v"], partitions=7).select("k", "t", "prev_v")
    want = df.select("k", "t", F.lag("v").over(Window.partitionBy("k").orderBy("t")).alias("prev_v"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_transition_audit(spark):
    h = spark.createDataFrame([("f", 1, "pending"), ("f", 2, "downloading"), ("f", 3, "csv_ready"), ("g", 1, "purged"),
                               ("g", 2, "pending")], "file_id string, seq long, status string").withColumn("changed_at", F.lit(None).cast("timestamp"))
    a = {(r["file_id"], r["seq"]): r["valid"] for r in AU.transition_audit(h, order=("seq",)).collect()}
    assert a == {("f", 1): True, ("f", 2): True, ("f", 3): False, ("g", 1): True, ("g", 2): False}


def test_retry_plan(spark):
    f = spark.createDataFrame([("j1", "f", "download", 1, "x"), ("j2", "f", "csv_conversion", 5, "y"),
                               ("j3", "g", "download", 9, "z")], "id string, file_id string, stage string, attempts int, error string")
    p = {r["id"]: r for r in J.plan_retries(f, dt.datetime(2026, 1, 1)).collect()}
    assert p["j2"]["final"] and p["j2"]["queue_status"] == "failed" and p["j2"]["retry_at"] is None
    assert not p["j1"]["final"] and 54 <= p["j1"]["delay_seconds"] <= 66  # 30 * 2^1 +/- 10 %
    again = {r["id"]: r["delay_seconds"] for r in J.plan_retries(f, dt.datetime(2026, 1, 1)).collect()}
    assert again["j1"] == p["j1"]["delay_seconds"]  # repeatable jitter


def test_ordered_previous_with_empty_partitions(spark):
    df = spark.createDataFrame([("a", i, str(i)) for i in range(5)] + [("b", i, str(i)) for i in range(3)], "k string, t long, v string")
    got = {(r["k"], r["t"]): r["prev_v"] for r in AU.ordered_previous(df, ["k"], ["t"], ["v"], partitions=40).collect()}
    assert got[("a", 0)] is None and got[("a", 4)] == "3" and got[("b", 0)] is None and got[("b", 2)] == "1"


def test_cluster_conf_sizes_partitions():
    from feedledger.session import cluster_conf

    c = cluster_conf(100 * (1 << 40), executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600  # 100 TB / 256 MB
    assert int(cluster_conf(1 << 30, 10, 4)["spark.sql.shuffle.partitions"]) == 120  # 3 tasks per core


def test_ordered_previous_is_lag_with_null_keys_and_one_key_everywhere(spark):
    rows = [(None if i % 3 else "k", float("nan") if i % 2 else None, i, None if i % 5 == 0 else i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, x double, t long, v long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")  # many batches a partition
    try:
        got = AU.ordered_previous(df, ["k", "x"], ["t"], ["v", "t"], partitions=9).select("t", "prev_v", "prev_t")
        w = Window.partitionBy("k", "x").orderBy("t")
        want = df.select("t", F.lag("v").over(w), F.lag("t").over(w))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.toDF("t", "prev_v", "prev_t").collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert AU.ordered_previous(df.limit(0), ["k"], ["t"], ["v"]).count() == 0


def test_ordered_previous_joins_boundary_rows_only(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = AU.ordered_previous(df, ["k"], ["id"], ["id"], partitions=4)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def _compared(a, b, **how):
    return {r["column"]: tuple(r)[1:] for r in AU.compare_datasets(a, b, **how).collect()}


def test_compare_finds_changed_added_and_repeated_rows(spark):
    rows = [(i, None if i % 10 == 0 else f"v{i % 7}", None if i % 4 else i / 3) for i in range(500)] + [(1, "v1", None)] * 3
    schema = "k int, v string, x double"
    frame = lambda r: spark.createDataFrame(r, schema).repartition(5)
    a = frame(rows)
    distinct = lambda r: [len({x[c] for x in r if x[c] is not None}) for c in range(3)]
    n = len(rows)
    assert _compared(a, frame(rows[::-1])) == {c: (n, n, 0, 0, d, d) for c, d in zip("kvx", distinct(rows))}
    changed = [(i, "other", x) if i == 77 else (i, v, x) for i, v, x in rows]
    cases = [(changed, 1, 1), (rows + [(900, None, None)], 0, 1), (rows + rows[:1], 0, 1), (rows[:-1], 1, 0), (rows[:100], n - 100, 0), ([], n, 0),
             ([(i, None, None) if i == 5 else (i, v, x) for i, v, x in rows], 1, 1)]
    for other, only_a, only_b in cases:
        for buckets in (4096, 1):
            got = _compared(a, frame(other), buckets=buckets)
            assert got == {c: (n, len(other), only_a, only_b, d, e) for c, d, e in zip("kvx", distinct(rows), distinct(other))}
    swapped = frame([(1, None, 2.0)])
    assert _compared(swapped, frame([(None, "1", 2.0)]))["k"][2:4] == (1, 1)  # a null is no value of the next column
    empty = frame([])
    assert _compared(empty, empty) == {c: (0, 0, 0, 0, 0, 0) for c in "kvx"}


def test_equal_datasets_are_not_grouped_by_row(spark):
    a = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("v"))
    plan = AU.compare_datasets(a, a.repartition(7))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "_h" not in plan
