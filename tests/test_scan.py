"""Scan diff, upsert and merge (FIXTURES Part B)."""

import datetime as dt

from pyspark.sql import functions as F

from feedledger.operators import policy as P
from feedledger.operators import scan as SC

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)
AS_OF = dt.datetime(2026, 1, 1)
LISTING = "ftp_dir string, name string, size long, mod_time timestamp, remote_path string, seq long"


def _listing(spark, entries):
    return spark.createDataFrame([("/d", n, s, t, "/d/" + n, i) for i, (n, s, t) in enumerate(entries)], LISTING)


def _empty(spark):
    files = spark.createDataFrame([], SC.S.FILES)
    stages = spark.createDataFrame([], SC.S.FILE_STAGES)
    queue = spark.createDataFrame([], SC.S.JOB_QUEUE)
    return files, stages, queue


def test_unchanged_rule(spark):
    df = spark.createDataFrame([(1, T0, 1, T0), (1, T0, 2, T0), (1, T0, 1, T0 + dt.timedelta(hours=1)),
                                (None, T0, 1, T0), (1, None, 1, T0)], "a long, ta timestamp, b long, tb timestamp")
    got = [r[0] for r in df.select(SC.is_unchanged(F.col("a"), F.col("ta"), F.col("b"), F.col("tb"))).collect()]
    assert got == [True, False, False, False, False]


def test_ignore_rule(spark):
    df = spark.createDataFrame([(s,) for s in ["pending", "downloaded", "csv_ready", "failed", "purged", "parquet_ready"]], "overall_status string")
    assert [r[0] for r in df.select(SC.should_move_to_ignored()).collect()] == [True, True, True, False, False, False]


def test_three_scans(spark):
    pol = P.Policy.from_lists(spark, catalogs=["RD"], states=["SP"], years=[2024])
    files, stages, queue = _empty(spark)
    entries = [(f"RDSP24{m:02d}{chr(65 + k)}.dbc", 100, T0) for m in range(1, 6) for k in range(5)]
    l1 = _listing(spark, entries)
    r1 = SC.merge_scan(files, stages, queue, l1, pol, AS_OF, 2026, order_col="seq")
    t1 = SC.scan_totals(r1.summary).first()
    assert (t1["new"], t1["skipped"], t1["found"]) == (25, 0, 25)
    f1 = r1.files.drop("is_new").cache()
    assert f1.count() == 25
    assert t1["enqueued"] == 25  # a download each
    r2 = SC.merge_scan(f1, r1.stages.cache(), r1.queue.cache(), l1, pol, AS_OF, 2026, order_col="seq")
    t2 = SC.scan_totals(r2.summary).first()
    assert (t2["new"], t2["changed"], t2["skipped"]) == (0, 0, 25)
    changed = [(n, 200, T0 + dt.timedelta(hours=1)) if i < 3 else (n, s, t) for i, (n, s, t) in enumerate(entries)]
    r3 = SC.merge_scan(r2.files.drop("is_new").cache(), r2.stages, r2.queue, _listing(spark, changed), pol, AS_OF, 2026,
                       order_col="seq")
    t3 = SC.scan_totals(r3.summary).first()
    assert t3["new"] == 0 and t3["changed"] == 3
    sizes = {r["filename"]: r["size_bytes"] for r in r3.files.collect()}
    assert sizes["RDSP2401A.DBC"] == 200 and sizes["RDSP2401D.DBC"] == 100


def test_invalid_names(spark):
    files, stages, queue = _empty(spark)
    l = _listing(spark, [("BADNAME.txt", 1, T0), ("WRONGFMT.dbc", 1, T0), ("ZZSP2401.dbc", 1, T0)])
    r = SC.merge_scan(files, stages, queue, l, None, AS_OF, 2026)
    t = SC.scan_totals(r.summary).first()
    assert t["found"] == 1 and t["skipped"] >= 1
    legacy = SC.scan_totals(SC.scan_summary(r.classified, count_mode="legacy")).first()
    assert legacy["found"] == 2


def test_upsert_is_new_and_update(spark):
    files, _, _ = _empty(spark)
    l = _listing(spark, [("RDSP2401.dbc", 10, T0), ("RDSP2402.dbc", 11, T0), ("RDSP2403.dbc", 12, T0)])
    c = SC.classify_listing(l, files, None, 2026)
    up = SC.upsert_files(files, SC.upsert_rows(c, "/data"), AS_OF).cache()
    assert {r["is_new"] for r in up.collect()} == {True}
    ids = {r["filename"]: r["id"] for r in up.collect()}
    l2 = _listing(spark, [("RDSP2401.dbc", 99, T0 + dt.timedelta(hours=2))])
    c2 = SC.classify_listing(l2, up.drop("is_new"), None, 2026)
    up2 = SC.upsert_files(up.drop("is_new"), SC.upsert_rows(c2, "/data"), AS_OF)
    row = up2.where(F.col("filename") == "RDSP2401.DBC").first()
    assert row["is_new"] is False and row["id"] == ids["RDSP2401.DBC"] and row["size_bytes"] == 99


def test_duplicate_names_last_wins(spark):
    files, _, _ = _empty(spark)
    l = _listing(spark, [("RDSP2401.dbc", 10, T0), ("rdsp2401.DBC", 20, T0), ("RDSP2401.dbc", 10, T0)])
    c = SC.classify_listing(l, files, None, 2026, order_col="seq")
    up = SC.upsert_files(files, SC.upsert_rows(c, "/data", "seq"), AS_OF)
    assert [r["size_bytes"] for r in up.collect()] == [10]  # the third (last) entry wins
    # exact copies are collapsed before the diff but still counted
    assert SC.diff_counts(c).first()["new"] == 3
    l2 = _listing(spark, [("RDSP2401.dbc", 10, T0), ("rdsp2401.DBC", 20, T0)])
    c2 = SC.classify_listing(l2, files, None, 2026, order_col="seq")
    assert [r["size_bytes"] for r in SC.upsert_files(files, SC.upsert_rows(c2, "/data", "seq"), AS_OF).collect()] == [20]


def test_segments_filters(spark):
    from feedledger.operators import catalog as C
    from feedledger.plans.listspec import ListSpec

    files, _, _ = _empty(spark)
    l = _listing(spark, [("RDSP2401A.dbc", 1, T0), ("RDSP2401B.dbc", 1, T0), ("RDSP2401.dbc", 1, T0)])
    up = SC.upsert_files(files, SC.upsert_rows(SC.classify_listing(l, files, None, 2026), "/data"), AS_OF).cache()
    assert up.count() == 3
    assert C.count_files(up, ListSpec(segment="a")).first()[0] == 1
    assert C.count_files(up, ListSpec(has_segment=True)).first()[0] == 2
    assert C.count_files(up, ListSpec(has_segment=False)).first()[0] == 1
