"""Landing: chunked digests, atomic copies, recorded results, broken files."""

import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from feedledger import schemas as S
from feedledger.operators import scan as SC
from feedledger.plans import landing as LD
from feedledger.sources import fsio

AS_OF = dt.datetime(2026, 1, 1)


def catalog(spark, names):
    given = [{"id": n[:8].lower(), "filename": n, "catalog": n[:2], "state": n[2:4], "year": 2000 + int(n[4:6]), "month": int(n[6:8]), "ftp_dir": "/pub", "ftp_path": "/pub/" + n,
              "root_path": "/nowhere", "overall_status": "downloading"} for n in names]
    return spark.createDataFrame([tuple(g.get(f.name) for f in S.FILES.fields) for g in given], S.FILES)


def test_landing_records_digest_path_and_status(spark, tmp_dir):
    data = {"rdac2401.dbc": os.urandom(100_000), "RDAC2402.DBC": b"yy", "RDAC2403.dbc": b"x"}
    os.makedirs(f"{tmp_dir}/src/deep")
    for name, raw in data.items():
        with open(f"{tmp_dir}/src/deep/{name}", "wb") as f:
            f.write(raw)
    with open(f"{tmp_dir}/src/rdac2401.txt", "w") as f:
        f.write("not a data file")
    listing = SC.list_directories(spark, f"{tmp_dir}/src", recursive=True)
    gone = spark.createDataFrame([("/x", "RDAC2404.dbc", 1, AS_OF, f"{tmp_dir}/src/lost.dbc")], listing.schema)
    files = catalog(spark, [n.upper() for n in data] + ["RDAC2404.DBC", "RDAC2405.DBC"])
    outcomes = LD.land(files, listing.unionByName(gone), f"{tmp_dir}/store", chunk=1000)
    new, stages, logs = LD.record_landing(files, spark.createDataFrame([], S.FILE_STAGES), outcomes, AS_OF)
    got = {r["filename"]: r for r in new.collect()}
    for name, raw in data.items():
        r = got[name.upper()]
        assert (r["overall_status"], r["local_hash"]) == ("downloaded", hashlib.sha256(raw).hexdigest())
        assert r["dbc_path"] == f"{tmp_dir}/store/RD/AC/2024/{name[6:8]}/{name[:8].upper()}.dbc"
        with open(r["dbc_path"], "rb") as f:
            assert f.read() == raw
    assert (got["RDAC2404.DBC"]["overall_status"], got["RDAC2404.DBC"]["dbc_path"]) == ("failed", None)
    assert got["RDAC2405.DBC"]["overall_status"] == "downloading"  # nothing listed: nothing changes
    st = {r["file_id"]: (r["status"], bool(r["error_message"])) for r in stages.collect()}
    assert st == {"rdac2401": ("done", False), "rdac2402": ("done", False), "rdac2403": ("done", False), "rdac2404": ("failed", True)}
    told = {r["file_id"]: r for r in logs.collect()}
    assert told["rdac2404"]["event_type"] == "failed" and "FileNotFoundError" in told["rdac2404"]["message"]
    assert json.loads(told["rdac2401"]["payload_json"])["bytes"] == 100_000 and told["rdac2401"]["message"].endswith(got["RDAC2401.DBC"]["local_hash"][:8])
    assert sorted(f for _, _, names in os.walk(f"{tmp_dir}/store") for f in names if not f.endswith(".crc")) == ["RDAC2401.dbc", "RDAC2402.dbc", "RDAC2403.dbc"]
    again = LD.land(files, listing, f"{tmp_dir}/store")  # lands again, with the same result
    assert {r["local_hash"] for r in again.collect()} == {hashlib.sha256(raw).hexdigest() for raw in data.values()}
    assert LD.land(files.limit(0), listing, f"{tmp_dir}/store").count() == 0


def test_listing_reads_no_content(spark, tmp_dir):
    files, listing = catalog(spark, ["RDAC2401.DBC"]), SC.list_directories(spark, tmp_dir)
    plan = LD.sources(files, listing, "/store")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" not in plan or "content" not in plan.split("ReadSchema")[1].split(">")[0]
    assert LD.sources(files, spark.createDataFrame([("/x", "rdac2401.dbc", 1, AS_OF, p) for p in ("/x/b", "/x/a")], listing.schema), F.lit(" ")).first()["to"].startswith("/nowhere/RD")
    assert LD.sources(files, spark.createDataFrame([("/x", "rdac2401.dbc", 1, AS_OF, p) for p in ("/x/b", "/x/a")], listing.schema), "/r").first()["source"] == "/x/a"


def test_a_failed_copy_leaves_nothing(tmp_dir, monkeypatch):
    with open(f"{tmp_dir}/a", "wb") as f:
        f.write(b"12345")
    monkeypatch.setattr(fsio, "move", lambda a, b: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        fsio.copy_with_digest(f"{tmp_dir}/a", f"{tmp_dir}/out/b", 2)
    assert os.listdir(f"{tmp_dir}/out") == []


def test_listing_is_made_in_tasks_level_by_level(spark, tmp_dir, monkeypatch):
    shown = ["a/b/c.dbc", "a/_x=1", "a/sp ace%20.dbc", "z.dbc"]
    for name in [*shown, "a/.h", "a/_x", "a/e._COPYING_", "a/empty", "_deep/q", ".deep/q"]:
        os.makedirs(os.path.dirname(f"{tmp_dir}/{name}"), exist_ok=True)
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write("" if name.endswith("empty") else "xx")
    os.utime(f"{tmp_dir}/z.dbc", (1_700_000_000, 1_700_000_000))
    ls = SC.list_directories(spark, f"file:{tmp_dir}", recursive=True)
    os.remove(f"{tmp_dir}/a/b/c.dbc")  # the listing is that of the call
    assert not ls.inputFiles()  # no file index on the driver
    rows = ls.collect()
    assert sorted(r["remote_path"] for r in rows) == sorted(f"{tmp_dir}/{n}" for n in shown)
    assert all(r["remote_path"] == f"{r['ftp_dir']}/{r['name']}" and r["size"] == 2 for r in rows)
    assert ls.where("name = 'z.dbc'").selectExpr("unix_millis(mod_time)").first()[0] == 1_700_000_000_000
    assert [r["name"] for r in SC.list_directories(spark, [tmp_dir]).collect()] == ["z.dbc"]
    with pytest.raises(Exception, match="FileNotFoundError"):
        SC.list_directories(spark, f"{tmp_dir}/nowhere")
