"""Catalog lists, specs, sorts, stages and insights."""

import datetime as dt

from pyspark.sql import functions as F

from feedledger import schemas as S
from feedledger.functions import text as TX
from feedledger.operators import catalog as C
from feedledger.operators import insights as I
from feedledger.operators import stages as ST
from feedledger.plans import listspec as LS


def test_truthy_words():
    for w in ["", "0", "false"]:
        assert LS.truthy(w) is False
    for w in ["1", "true", "TRUE", " yes ", "on"]:
        assert LS.truthy(w) is True


def test_terminal_status():
    assert ST.expected_terminal_status(True, True, True) == "parquet_ready"
    assert ST.expected_terminal_status(True, True, False) == "csv_ready"
    assert ST.expected_terminal_status(True, False, False) == "downloaded"
    assert ST.expected_terminal_status(False, False, False) == "pending"


def test_spec_from_query():
    s = LS.from_query({"catalog": ["sp, rd", " aq"], "status": ["Pending,IGNORED", ""], "limit": "900", "offset": "-3",
                       "segment": " a ", "has_segment": "no", "period_from_year": "2020", "period_from_month": "2",
                       "pipeline_completed": "on", "policy_match": "bogus"})
    assert s.catalogs == ("SP", "RD", "AQ") and s.catalog == "SP, RD"
    assert s.statuses == ("pending", "ignored")
    assert s.limit == 500 and s.offset == 0
    assert s.segment == "A" and s.has_segment is False
    assert s.period_from == (2020, 2) and s.period_to is None
    assert s.pipeline_completed and s.policy_match == ""
    assert LS.from_query({"limit": "0"}).limit == 1


def test_batch_filter_guard():
    assert not LS.has_catalog_or_period_filters({"state": "SP"})
    assert LS.has_catalog_or_period_filters({"catalogs": ["", "SP"]})
    assert LS.has_catalog_or_period_filters({"period_to_month": 3})
    assert not LS.has_catalog_or_period_filters({"period_to_month": "3"})


def test_null_segment_sort_both_directions(spark):
    df = spark.createDataFrame([("a", None), ("b", "A"), ("c", "B")], "id string, segment string")
    asc = [r[0] for r in C.page(df, LS.ListSpec(sort_by="segment", sort_dir="asc", limit=10)).collect()]
    desc = [r[0] for r in C.page(df, LS.ListSpec(sort_by="segment", sort_dir="desc", limit=10)).collect()]
    assert asc == ["b", "c", "a"]  # nulls last ascending
    assert desc == ["a", "c", "b"]  # nulls first descending


def test_three_valued_completion(spark):
    files = spark.createDataFrame([("f1", "parquet_ready"), ("f2", "parquet_ready"), ("f3", "pending")], "id string, overall_status string")
    stages = spark.createDataFrame([("f2", s, "done") for s in S.STAGES] + [("f3", "download", "done")],
                                   "file_id string, stage string, status string")
    r = ST.pipeline_consistency(files, stages, True, True, True, with_unknown=True).first()
    # f1 has no stages: unknown, not a mismatch; f2 completed; f3 not completed and not terminal
    assert (r["pipeline_completed_count"], r["status_stage_mismatch_count"], r["unknown_count"]) == (1, 0, 1)
    r0 = ST.pipeline_consistency(files, stages, False, False, False).first()
    assert r0["pipeline_completed_count"] == 3  # nothing required: every file completed


def test_size_by_rounding(spark):
    files = spark.createDataFrame([("SP", 1), ("SP", 2), ("RJ", None), (" sp", None)], "state string, size_bytes long")
    got = {r["key"]: (r["count"], r["total_size_bytes"], r["avg_size_bytes"]) for r in C.size_by_state(files).collect()}
    assert got == {"SP": (3, 3, 2), "RJ": (1, 0, 0)}  # 1.5 rounds half up, unlike a truncating cast


def test_sextile_levels(spark):
    b = spark.createDataFrame([(str(i), i * 10) for i in range(6)], "key string, total_size_bytes long")
    lv = {r["key"]: r["level"] for r in I.with_size_level(b).collect()}
    assert lv["0"] == 0 and lv["5"] == 5
    same = spark.createDataFrame([("a", 7), ("b", 7)], "key string, total_size_bytes long")
    assert {r["level"] for r in I.with_size_level(same).collect()} == {5}


def test_bytes_and_labels(spark):
    df = spark.createDataFrame([(0,), (512,), (1536,), (10 * 1024,), (5 * 1024 ** 3,)], "v long")
    got = [r[0] for r in df.select(TX.format_bytes("v")).collect()]
    assert got == ["0 B", "512 B", "1.5 KB", "10 KB", "5.0 GB"]
    lab = df.select(TX.size_and_count_label(F.lit(2048), F.lit(1234567))).first()[0]
    assert lab == "2.0 KB (1.234.567 arquivos)"


def test_dates(spark):
    df = spark.createDataFrame([("2026-04-28T13:14:15Z",), ("not a date",)], "s string")
    r = df.select(TX.date_br("s", "date").alias("d"), TX.date_br("s", "datetime").alias("dt"),
                  TX.date_br("s", "seconds").alias("ds"), TX.date_br("s", "time").alias("t")).collect()
    assert tuple(r[0]) == ("28/04/2026", "28/04/2026 13:14", "28/04/2026 13:14:15", "13:14:15")
    assert tuple(r[1]) == ("Data desconhecida", "Data desconhecida", "Data desconhecida", "")


def test_number_to_text(spark):
    vals = [1e7, 12345678.5, 0.0001, -3.0, 0.1, 1e15, 1e19, None, 31.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(TX.number_to_text("v")).collect()]
    assert got == ["10000000", "12345678.5", "0.0001", "-3", "0.1", "1000000000000000", "10000000000000000000", "", "31"]


def test_rfc3339(spark):
    df = spark.createDataFrame([("2026-04-28 13:14:15",), ("2026-04-28 13:14:15.5",), ("2026-04-28 13:14:15.000123",)], "s string")
    got = [r[0] for r in df.select(TX.rfc3339(F.col("s").cast("timestamp"))).collect()]
    assert got == ["2026-04-28T13:14:15Z", "2026-04-28T13:14:15.5Z", "2026-04-28T13:14:15.000123Z"]


def test_dashboard_buckets_match_separate_reports(spark):
    from feedledger import fixtures as FX

    files = FX.tables(spark, "/root/testdata/sf0.001").files
    one = {(r["dim"], r["key"]): (r["count"], r["total_size_bytes"], r["avg_size_bytes"])
           for r in I.dashboard_buckets(files).collect()}
    sep = {("catalog", r["key"]): (r["count"], r["total_size_bytes"], r["avg_size_bytes"]) for r in C.size_by_catalog(files).collect()}
    sep.update({("state", r["key"]): (r["count"], r["total_size_bytes"], r["avg_size_bytes"]) for r in C.size_by_state(files).collect()})
    assert {k: v for k, v in one.items() if k[0] != "status"} == sep
    assert {k[1]: v[0] for k, v in one.items() if k[0] == "status"} == {r["overall_status"]: r["count"] for r in C.status_counts(files).collect()}


def test_dashboard_results_equal_the_separate_reports(spark):
    from feedledger.operators import policy as P

    files = spark.createDataFrame([(f"f{i}", ("pending", "parquet_ready", "failed", "ignored")[i % 4], ("RD", " rd", "SP")[i % 3], "AC" if i % 5 else None, 2020 + i % 2, i % 13,
                                    None if i % 6 == 0 else i) for i in range(60)], "id string, overall_status string, catalog string, state string, year int, month int, size_bytes long")
    stages = spark.createDataFrame([(f"f{i}" if i < 50 else f"orphan{i}", s, "done" if (i + k) % 3 else "failed", (None, " ", "lost ")[i % 3]) for i in range(55) for k, s in enumerate(I.DONE) if i % 7 or k],
                                   "file_id string, stage string, status string, error_message string")
    r = I.dashboard(files, stages)
    rows = lambda df: sorted(map(str, df.collect()))
    for name, want in (("status_counts", C.status_counts(files)), ("by_state", I.with_bar_share(I.with_size_level(C.size_by_state(files)))), ("failure_reasons", ST.top_failure_reasons(stages)),
                       ("by_catalog", I.with_bar_share(I.with_size_level(C.size_by_catalog(files)))), ("pipeline", ST.pipeline_consistency(files, stages)), ("stage_done_counts", ST.stage_done_counts(stages)),
                       ("policy_counts", P.pending_and_ignored_counts(files)), ("bucket_mismatch", I.bucket_mismatch(files)), ("kpis", I.kpis(files)), ("facets", C.facets(files))):
        assert rows(r[name]) == rows(want.select(*r[name].columns)), name
    empty = I.dashboard(files.limit(0), stages.limit(0))
    assert empty["kpis"].first()["total_files"] == 0 and empty["status_counts"].count() == 0


def test_dashboard_reads_files_and_stages_once(spark, tmp_dir):
    files = spark.range(50).selectExpr("'f' || id AS id", "'pending' AS overall_status", "'RD' AS catalog", "'AC' AS state", "2024 AS year", "1 AS month", "id AS size_bytes")
    stages = spark.range(50).selectExpr("'f' || id AS file_id", "'download' AS stage", "'done' AS status", "cast(NULL AS string) AS error_message")
    files.write.parquet(f"{tmp_dir}/files")
    stages.write.parquet(f"{tmp_dir}/stages")
    r = I.dashboard(spark.read.parquet(f"{tmp_dir}/files"), spark.read.parquet(f"{tmp_dir}/stages"))
    for name, df in r.items():
        if name != "expected_terminal_status":  # every result reads the checkpointed cells alone
            assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString(), name
    assert r["kpis"].first()["total_files"] == 50
