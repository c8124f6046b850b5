"""Plan shape: filters and columns reach the scan, top-k instead of sorts, partial window limits,
broadcasts only of bounded dimensions, no cartesian products in the catalog/policy/scan queries."""

import pytest

from feedledger.plans.registry import load_all

SF = "/root/testdata/sf0.001"
REG = load_all()


def plan(spark, name):
    df = REG[name].build(spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_list_pushes_filters_and_uses_top_k(spark):
    p = plan(spark, "list_files_period")
    assert "TakeOrderedAndProject" in p
    assert "PushedFilters: [In(catalog" in p or "PushedFilters: [IsNotNull" in p
    assert "Sort [" not in p  # no full sort: the page is a bounded top-k


def test_count_prunes_columns(spark):
    p = plan(spark, "count_by_state")
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<state:string>" in scan


@pytest.mark.parametrize("name", ["newest_logs_per_file", "due_jobs"])
def test_top_n_per_key_is_partially_limited(spark, name):
    p = plan(spark, name)
    # a WindowGroupLimit below the exchange trims every map task to n rows per key
    assert p.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["policy_admission", "reconcile_statuses", "scan_summary_by_dir", "completion_consistency",
                                  "size_by_state", "upsert_listing", "batch_preview", "failed_since"])
def test_no_cartesian_products(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_policy_sets_are_broadcast_after_dedupe(spark):
    p = plan(spark, "policy_admission")
    assert p.count("BroadcastHashJoin") >= 4


@pytest.mark.parametrize("name,scans", [("facets", 1), ("dashboard_buckets", 1)])
def test_single_scan_reports(spark, name, scans):
    p = plan(spark, name)
    assert p.count("FileScan parquet") == scans


def test_scan_merge_reads_listing_once(spark):
    p = plan(spark, "scan_merge_files")
    # the listing is the only input with a remote_path column (the catalog has ftp_path)
    listing_scans = [line for line in p.splitlines() if "FileScan parquet" in line and "remote_path#" in line]
    assert len(listing_scans) == 1
