"""Conversion job: record files -> TSV / Parquet (FIXTURES Part A/B data files)."""

import os

import pytest
from pyspark.sql import functions as F

from feedledger.functions import names as N
from feedledger.operators import audit as AU
from feedledger.plans import convert as CV
from feedledger.sources import dbc


def _write(path, data):
    with open(path, "wb") as f:
        f.write(data)


def test_dcl_roundtrip_and_tables():
    assert dbc.kraft_sum(dbc.LITERAL_LENGTHS) == 1.0
    assert dbc.kraft_sum(dbc.LENGTH_LENGTHS) == 1.0
    assert dbc.kraft_sum(dbc.DISTANCE_LENGTHS) == 1.0
    for data in [b"", b"a", b"abcabcabcabc" * 50, os.urandom(3000), b"\x00" * 5000]:
        for d in (4, 5, 6):
            assert dbc.explode(dbc.implode(data, d)) == data
    with pytest.raises(ValueError):
        dbc.explode(b"\x07\x06\x00")


def test_header_parse():
    raw = dbc.build_dbc([("NAME", "C", 8), ("AGE", "N", 3)], [["ALICE", "031"], ["BOB", "042"]])
    h = dbc.parse_header(raw)
    assert (h.n_records, h.record_len, [f.name for f in h.fields]) == (2, 12, ["NAME", "AGE"])


def test_convert_two_fields(spark, tmp_dir):
    src = f"{tmp_dir}/in/SPTO2602.dbc"
    os.makedirs(os.path.dirname(src))
    _write(src, dbc.build_dbc([("NAME", "C", 8), ("AGE", "N", 3)], [["ALICE", "031"], ["BOB", "042"]]))
    paths = spark.createDataFrame([(src,)], "path string")
    res = CV.convert(paths, tsv_root=f"{tmp_dir}/tsv", parquet_root=f"{tmp_dir}/pq", tasks=2)
    out = res.outcomes.first()
    assert out["ok"] and out["records"] == 2
    assert "SPTO2602.parquet" in os.listdir(f"{tmp_dir}/pq/SP/TO/2026/02")
    pq = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/pq")
    assert pq.columns == ["NAME", "AGE"]
    assert sorted(tuple(r) for r in pq.select("NAME", "AGE").collect()) == [("ALICE", "31"), ("BOB", "42")]
    # TSV: header line, tab separated, same cells
    files = [os.path.join(dp, f) for dp, _, fs in os.walk(f"{tmp_dir}/tsv") for f in fs if f.endswith(".csv")]
    text = "".join(open(p).read() for p in files)
    assert "NAME\tAGE" in text and "ALICE\t31" in text
    tsv = spark.read.option("sep", "\t").option("header", True).schema("NAME string, AGE string").option("recursiveFileLookup", "true").csv(f"{tmp_dir}/tsv")
    cmp = {r["column"]: r for r in AU.compare_datasets(tsv.select("NAME", "AGE"), pq.select("NAME", "AGE")).collect()}
    assert cmp["NAME"]["only_in_a"] == 0 and cmp["NAME"]["only_in_b"] == 0 and cmp["AGE"]["distinct_a"] == 2


def test_convert_200_rows_and_four_fields(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    a = f"{tmp_dir}/in/AQAC2601.dbc"
    _write(a, dbc.build_dbc([("NAME", "C", 8), ("CODE", "N", 3)], [[f"{i:08d}", f"{i % 1000:03d}"] for i in range(200)]))
    b = f"{tmp_dir}/in/ADDF2602.dbc"
    rows = [[f"c{i}", str(i * 7), f"x{i}", str(i)] for i in range(50)]
    _write(b, dbc.build_dbc([("COL1", "C", 10), ("COL2", "N", 5), ("COL3", "C", 8), ("COL4", "N", 4)], rows))
    bad = f"{tmp_dir}/in/RDSP2601.dbc"
    _write(bad, b"not a data file")
    paths = spark.createDataFrame([(a,), (b,), (bad,)], "path string")
    res = CV.convert(paths, parquet_root=f"{tmp_dir}/pq", tasks=3)
    oc = {r["file"]: r for r in res.outcomes.collect()}
    assert oc["AQAC2601"]["records"] == 200 and oc["ADDF2602"]["records"] == 50
    assert not oc["RDSP2601"]["ok"] and oc["RDSP2601"]["error"]
    assert len(res.layouts) == 2
    t200 = [t for t in res.tables.values() if "CODE" in t.columns][0]
    assert t200.select("NAME").distinct().count() == 200  # no collapse of rows
    t4 = [t for t in res.tables.values() if "COL4" in t.columns][0]
    assert t4.where(F.col("COL2") == "343").count() == 1


def test_deleted_records_and_types(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    p = f"{tmp_dir}/in/PSBA2512.dbc"
    fields = [("A", "C", 4), ("B", "N", 8), ("C", "L", 1), ("D", "D", 8)]
    rows = [["x", "  1.50", "T", "20240131"], ["y", "", "?", ""], ["z", "abc", "n", "2024xx01"]]
    _write(p, dbc.build_dbc(fields, rows, deleted={1}))
    res = CV.convert(spark.createDataFrame([(p,)], "path string"), tasks=1)
    t = list(res.tables.values())[0]
    got = sorted(tuple(r) for r in t.select("A", "B", "C", "D").collect())
    assert got == [("x", "1.5", "true", "2024-01-31"), ("z", "abc", "false", "2024xx01")]


def test_column_normalisation():
    assert CV.normalize_columns(["a", "a", "a_1", "", "b-c", "ç"]) == ["a", "a_1", "a_1_1", "column", "b_c", "_"]
    assert len(set(CV.normalize_columns(["x", "x", "x_1", "x_1"]))) == 4


def test_truncated_file_drops_its_records(spark, tmp_dir, monkeypatch):
    os.makedirs(f"{tmp_dir}/in")
    good = f"{tmp_dir}/in/SPAC2401.dbc"
    cut = f"{tmp_dir}/in/SPAC2402.dbc"
    fields = [("NAME", "C", 8)]
    _write(good, dbc.build_dbc(fields, [[f"{i:08d}"] for i in range(3000)]))
    raw = dbc.build_dbc(fields, [[f"{i:08d}"] for i in range(3000)])
    _write(cut, raw[: len(raw) - 40])
    # small batches and chunks: records of the cut file are emitted before it fails
    res = CV.convert(spark.createDataFrame([(good,), (cut,)], "path string"), tasks=2,
                     decode_opts={"record_batch": 500, "chunk": 2000})
    decoded_cut = CV.decode_files(spark.createDataFrame([(cut,)], "path string"), tasks=1, record_batch=500, chunk=2000)
    assert decoded_cut.where("kind = 'record'").count() > 0  # partial output existed
    oc = {r["file"]: r for r in res.outcomes.collect()}
    assert oc["SPAC2401"]["ok"] and not oc["SPAC2402"]["ok"]
    t = list(res.tables.values())[0]
    assert t.count() == 3000 and t.select("file").distinct().count() == 1


def test_dcl_modes():
    data = b"".join(f"{i:08d}ABC  {i % 7}".encode() for i in range(2000))
    for matches in (True, False):
        for coded in (True, False):
            z = dbc.implode(data, 5, matches=matches, coded=coded)
            assert z[0] == (1 if coded else 0)
            assert dbc.explode(z) == data
    with pytest.raises(ValueError):
        dbc.explode(dbc.implode(data, 6)[:-20])


@pytest.mark.parametrize("matches", [True, False])
def test_every_cut_body_ends_in_an_error(matches):
    whole = dbc.implode(bytes(range(200)) * 2, 4, matches=matches)
    for n in range(2, len(whole)):
        with pytest.raises(ValueError):
            dbc.explode(whole[:n])


def test_outcome_log_rows(spark, tmp_dir):
    import datetime as dt

    os.makedirs(f"{tmp_dir}/in")
    good = f"{tmp_dir}/in/SPAC2401.dbc"
    bad = f"{tmp_dir}/in/SPAC2402.dbc"
    _write(good, dbc.build_dbc([("A", "C", 3)], [["x"], ["y"]]))
    _write(bad, b"junk")
    res = CV.convert(spark.createDataFrame([(good,), (bad,)], "path string"), tasks=2)
    files = spark.createDataFrame([("f1", good), ("f2", bad)], "id string, dbc_path string")
    logs = {r["file_id"]: r for r in CV.outcome_log_rows(res.outcomes, files, "parquet_conversion", dt.datetime(2026, 1, 1)).collect()}
    assert logs["f1"]["event_type"] == "completed" and '"records":2' in logs["f1"]["payload_json"]
    assert logs["f2"]["event_type"] == "failed" and logs["f2"]["message"]


def test_files_without_records_get_their_header(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    fields = [("NAME", "C", 8), ("AGE", "N", 3), ("AGE", "N", 3)]
    data = {"SPAC2401": dbc.build_dbc(fields, []), "SPAC2402": dbc.build_dbc(fields, [["a", "1", "2"]] * 4, deleted={0, 1, 2, 3}),
            "SPAC2403": dbc.build_dbc(fields, [["b", "3", "4"]])}
    for name, raw in data.items():
        _write(f"{tmp_dir}/in/{name}.dbc", raw)
    paths = spark.createDataFrame([(f"{tmp_dir}/in/{name}.dbc",) for name in data], "path string")
    CV.convert(paths, tsv_root=f"{tmp_dir}/tsv", parquet_root=f"{tmp_dir}/pq")
    for name in data:
        at = f"SP/AC/2024/{name[-2:]}/{name}"
        with open(f"{tmp_dir}/tsv/{at}.csv") as f:
            lines = f.read().splitlines()
        assert lines == ["NAME\tAGE\tAGE_1"] + ["b\t3\t4"] * (name == "SPAC2403")
        table = spark.read.parquet(f"{tmp_dir}/pq/{at}.parquet")
        assert table.columns == ["NAME", "AGE", "AGE_1"] and table.count() == (name == "SPAC2403")
    assert not [f for _, _, names in os.walk(f"{tmp_dir}/tsv") for f in names if f.startswith(".") and not f.endswith(".crc")]


def test_parts_of_a_name_come_from_one_parse(spark):
    paths = spark.createDataFrame([("/x/ORAB2401.dbc",), ("/x/orab9913p.DBC",), ("/x/odd",), (None,)], "path string")
    parts = CV.with_file_parts(paths)
    assert sorted(map(str, parts.collect())) == sorted(map(str, paths.select("path", *_old_parts()).collect()))
    assert parts._jdf.queryExecution().optimizedPlan().toString().lower().count("rlike") < 30  # one set of checks, not one a part


def _old_parts():
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    p = N.parse_filename(name, 2026)
    return [p["catalog"].alias("catalog"), p["state"].alias("state"), F.format_string("%04d", p["year"]).alias("year"),
            F.format_string("%02d", p["month"]).alias("month"), F.upper(N.base_name(name)).alias("file")]


def test_long_runs_of_literals_are_cut_out_in_blocks(monkeypatch):
    import random

    r, blocks, cut = random.Random(5), [], dbc._literal_block
    monkeypatch.setattr(dbc, "_literal_block", lambda *a: blocks.append(cut(*a)) or blocks[-1])
    for n in (0, 1, 31, 32, 33, 64, 1000, 100_000):
        data = r.randbytes(n)
        for packed in (dbc.implode(data, matches=False), dbc.implode(data[:3000] + b"ab" * 20 + data[:3000])):
            want = data if packed == dbc.implode(data, matches=False) else data[:3000] + b"ab" * 20 + data[:3000]
            assert b"".join(dbc.explode_chunks(b"head" + packed, 4, 1000)) == want
            for end in (len(packed) - 1, len(packed) // 2):
                with pytest.raises(ValueError):
                    dbc.explode(packed[:end])
    assert sum(map(len, blocks)) > 200_000  # most of the bytes
