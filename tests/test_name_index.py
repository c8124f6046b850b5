"""Glob lookup by name range and posting table equals the plain pattern."""

import random

import pytest
from pyspark.sql import functions as F

from feedledger.functions import glob as G
from feedledger.operators import catalog as C
from feedledger.operators import name_index as NI

GLOBS = ["RDAC*", "rdac24*", "*2401*", "*AC24*.dbc", "R*A.DBC", "AC2", "dbc", "", "*", "RD", "x%*", "*_O2*", "_", "*zz*", "RDAC2401.DBC", "**24**01**", "é*", "*é", "A*c*", "*#*", "~*", "DBC*"]


@pytest.fixture(scope="module")
def names(spark, tmp_path_factory):
    rng = random.Random(8)
    made = {f"{rng.choice(['RD', 'SP', 'AQ'])}{rng.choice(['AC', 'DF', 'SP'])}{rng.randrange(20, 26)}{rng.randrange(1, 13):02d}{rng.choice(['', 'A', 'B'])}.DBC" for _ in range(300)}
    made |= {"SP_O2602.DBC", "X%Y.DBC", "AB", "", "É.DBC", "CAFÉ.DBC", "A#B.DBC", "~X.DBC", "ZZZZZZ.DBC"}
    path = str(tmp_path_factory.mktemp("names"))
    spark.createDataFrame([(f"f{i}", n) for i, n in enumerate(sorted(made))], "id string, filename string").sort("filename").write.parquet(f"{path}/files")
    files = spark.read.parquet(f"{path}/files")
    NI.write_postings(files, f"{path}/index")
    return files, f"{path}/index"


@pytest.mark.parametrize("glob", GLOBS)
def test_lookups_equal_the_pattern(names, glob):
    files, path = names
    want = sorted(r[0] for r in files.where(G.matches_glob("filename", glob)).select("filename").collect())
    assert sorted(r["filename"] for r in NI.find_by_glob(files, glob).collect()) == want
    assert sorted(r["filename"] for r in NI.find_by_glob(files, glob, path).collect()) == want
    assert [r["filename"] for r in C.find_by_pattern(files, glob).collect()] == want


def test_the_range_reaches_the_scan(names):
    files, _ = names
    plan = files.where(NI.glob_condition("filename", "rdac*01.dbc"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(filename,RDAC)" in plan and "LessThan(filename,RDAD)" in plan
    assert NI.prefix_bounds("a#%*") == ("A#%", "A#&") and NI.prefix_bounds("*a") is None and NI.prefix_bounds("abc") is None


def test_few_slots_and_parts_are_read(spark, names):
    files, path = names
    some = NI.find_in_postings(spark, path, "*AC2401*")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [slot" in plan.replace("isnotnull(slot), ", "") or "PartitionFilters: [slot#" in plan
    assert "In(part" in plan or "EqualTo(part" in plan
    told = NI.rarest(spark, path, NI.glob_parts("*AC2401*"))
    counts = sorted(files.where(F.upper("filename").contains(p)).count() for p in NI.glob_parts("*AC2401*"))
    assert [n for _, n in told] == counts[: NI.PARTS]
    assert NI.find_in_postings(spark, path, "a*b") is None


def test_postings_of_an_empty_catalog(spark, tmp_dir):
    files = spark.createDataFrame([], "id string, filename string")
    NI.write_postings(files, f"{tmp_dir}/index")
    assert NI.find_by_glob(files, "*abc*", f"{tmp_dir}/index").count() == 0
