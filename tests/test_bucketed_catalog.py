"""The bucketed catalog: a listing touches its groups only, batches take effect once, reports follow."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from feedledger import fixtures as FX
from feedledger import schemas as S
from feedledger.operators import catalog as C
from feedledger.operators import jobs as J
from feedledger.operators import maintained as M
from feedledger.operators import policy as P
from feedledger.operators import scan as SC
from feedledger.operators import stages as ST
from feedledger.sources.bucketed import Catalog, name_group
from feedledger.streaming import landing as L

SF, AS_OF, YEAR, GROUPS = "/root/testdata/sf0.001", dt.datetime(2026, 1, 1), 2026, 64


@pytest.fixture(scope="module")
def tables(spark):
    return FX.tables(spark, SF)


def seeded(spark, t, root):
    catalog = Catalog(spark, root, groups=GROUPS, buckets=2)
    catalog.seed(SC.conform_files(t.files), ST.conform_stages(t.file_stages), J.conform_queue(t.job_queue))
    return catalog


def listing(t):
    return t.listing.select("ftp_dir", "name", "size", S.as_ts("mod_time").alias("mod_time"), "remote_path")


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_batches_by_directory_equal_one_merge_and_reports_follow(spark, tables, tmp_dir):
    t, catalog = tables, seeded(spark, tables, f"{tmp_dir}/state")
    policy, dirs = P.Policy.from_tables(t), sorted(r[0] for r in listing(t).select("ftp_dir").distinct().collect())
    parts = [dirs[:1], dirs[1:4], dirs[4:]]
    for batch, some in enumerate(parts):
        L.merge_listing(catalog, listing(t).where(F.col("ftp_dir").isin(some)), policy, AS_OF, YEAR, batch)
        files, cells = catalog.read("files"), catalog.read("cells")
        for kept, full in ((M.status_counts(cells), C.status_counts(files)), (M.size_by(cells, "state"), C.size_by_state(files)), (M.size_by(cells, "catalog"), C.size_by_catalog(files)),
                           (M.count_by(cells, "catalog"), C.count_by(files, "catalog")), (M.counts_raw(cells, "state"), C.counts_raw(files, "state")),
                           (M.pending_and_ignored_counts(cells), P.pending_and_ignored_counts(files)), (M.facets(cells), C.facets(files))):
            assert rows(kept) == rows(full)
    whole = SC.merge_scan(SC.conform_files(t.files), ST.conform_stages(t.file_stages), J.conform_queue(t.job_queue), listing(t), policy, AS_OF, YEAR)
    names = S.FILES.fieldNames()
    assert rows(catalog.read("files").select(*names)) == rows(whole.files.select(*names))
    assert rows(catalog.read("stages").drop("g")) == rows(whole.stages)
    assert rows(catalog.read("queue").drop("g")) == rows(whole.queue)
    counted = [r for b in range(3) for r in rows(catalog.summary(b))]
    assert sorted(counted) == rows(whole.summary)


def test_a_directory_reads_and_writes_its_groups_only(spark, tables, tmp_dir):
    t, catalog = tables, seeded(spark, tables, f"{tmp_dir}/state")
    one = listing(t).where(F.col("ftp_dir") == listing(t).agg(F.min("ftp_dir")).first()[0]).limit(5)
    groups = L.touched_groups(catalog, one, YEAR)
    of_group = lambda df: {f.split("/g=")[1].split("/")[0] for f in df.inputFiles()}
    everything, own = of_group(catalog.read("files")), of_group(catalog.read("files", groups))
    assert own <= {str(g) for g in groups} and len(own) <= 5 < len(everything)
    before = {f: g for f, g in ((f, f) for f in catalog.read("files").inputFiles())}
    L.merge_listing(catalog, one, None, AS_OF, YEAR, 0)
    kept = set(before) & set(catalog.read("files").inputFiles())
    assert {f.split("/g=")[1].split("/")[0] for f in set(before) - kept} <= {str(g) for g in groups}
    assert of_group(catalog.read("files")) - everything <= {str(g) for g in groups}


def test_files_are_joined_by_bucket_without_a_shuffle(spark, tables, tmp_dir):
    t, catalog = tables, seeded(spark, tables, f"{tmp_dir}/state")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", L._CO_PARTITION)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set(L._CO_PARTITION, "false")
    try:
        files = catalog.read("files").drop("g")
        up = SC.upsert_files(files, SC.upsert_rows(SC.classify_listing(listing(t), files, None, YEAR), "/data"), AS_OF)
        plan = up._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

    def depth(line):
        return re.match("[ :]*[+:]?-?", line).end()

    scans = [i for i, line in enumerate(plan) if "FileScan parquet" in line and "_files" in line]
    assert len(scans) == 2
    for i in scans:  # up from the scan to the first join
        level = depth(plan[i])
        for line in reversed(plan[:i]):
            if depth(line) < level:
                level = depth(line)
                assert "Exchange" not in line
                if "Join" in line:
                    break
        else:
            raise AssertionError("no join above the scan")


def test_an_interrupted_batch_is_put_in_again(spark, tables, tmp_dir, monkeypatch):
    t, catalog = tables, seeded(spark, tables, f"{tmp_dir}/state")
    some = listing(t).limit(40)
    real, calls = Catalog.replace, []

    def fails_at_the_second(self, name, df):
        calls.append(name)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(self, name, df)

    monkeypatch.setattr(Catalog, "replace", fails_at_the_second)
    with pytest.raises(RuntimeError):
        L.merge_listing(catalog, some, None, AS_OF, YEAR, 0)
    assert catalog.staged(0) and not catalog.applied(0)
    again = Catalog(spark, f"{tmp_dir}/state", groups=GROUPS, buckets=2)
    L.merge_listing(again, listing(t).limit(0), None, AS_OF, YEAR, 0)  # put in from what was staged, not merged anew
    want = SC.merge_scan(SC.conform_files(t.files), ST.conform_stages(t.file_stages), J.conform_queue(t.job_queue), some, None, AS_OF, YEAR)
    assert rows(again.read("files").select("id", "overall_status", "last_seen_at")) == rows(want.files.select("id", "overall_status", "last_seen_at"))
    assert rows(again.read("stages").drop("g")) == rows(want.stages)
    L.merge_listing(again, listing(t), None, AS_OF, YEAR, 0)  # delivered again: nothing changes
    assert rows(M.status_counts(again.read("cells"))) == rows(C.status_counts(want.files))


def test_signed_delta_cancels_what_did_not_change(spark):
    one = lambda rows: spark.createDataFrame([(f"f{i}", s, "RD", "AC", 2024, 1, z) for i, s, z in rows], "id string, overall_status string, catalog string, state string, year int, month int, size_bytes long")
    old, new = one([(1, "pending", 5), (2, "failed", None), (3, "failed", 7)]), one([(1, "pending", 5), (2, "failed", 9), (3, "done", 7), (4, "done", 1)])
    delta = {r["overall_status"]: (r["files"], r["sized"], r["bytes"]) for r in M.signed_delta(old, new).collect()}
    assert delta == {"failed": (-1, 0, 2), "done": (2, 2, 8)}
    assert M.signed_delta(old, old).count() == 0
    assert rows(M.folded(M.cells(old), M.signed_delta(old, new))) == rows(M.cells(new))
    assert M.folded(M.cells(old), M.signed_delta(old, old.limit(0))).count() == 0


def test_group_depends_on_the_leading_characters(spark):
    df = spark.createDataFrame([("RDAC2401.dbc",), ("rdac2312A.DBC",), ("X",), ("",)], "n string").select(name_group("n", 1 << 20).alias("g"))
    g = [r["g"] for r in df.collect()]
    assert g[0] == g[1] != g[2] and all(0 <= x < 1 << 20 for x in g)


def test_a_listing_is_written_and_read_in_many_tasks(spark, tables, monkeypatch):
    from feedledger.plans import queries_stream as Q

    seen, start = [], L.start_landing
    files = lambda d: len(Q._files_of(spark, d))

    def started(spark, folder, *args, **kwargs):
        seen.append((files(folder), kwargs["max_files"]))
        return start(spark, folder, *args, **kwargs)

    monkeypatch.setattr(Q.L, "start_landing", started)
    Q._stream_landing(tables).count()
    (first, one), (both, two) = seen
    assert first > 1 and one == first and two == both - first  # each start takes its half as one batch


def test_touched_groups_are_those_of_parsed_names(spark, tmp_dir):
    names = ["RDAC2401.dbc", "rdac2402.DBC", "SPRJ2413.dbc", "XYZ.dbc", "RDAC2401.txt", "AMSP2401A.dbc"]
    given = spark.createDataFrame([("/pub", n, 1, AS_OF, "/pub/x") for n in names], S.LISTING)
    want = {spark.range(1).select(name_group(F.lit(n), GROUPS)).first()[0] for n in ("RDAC2401.DBC", "AMSP2401A.DBC")}
    assert L.touched_groups(Catalog(spark, f"{tmp_dir}/state", groups=GROUPS), given, YEAR) == sorted(want)
