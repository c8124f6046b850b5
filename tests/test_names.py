"""Golden vectors: file names, globs, paths (FIXTURES Part B)."""

import itertools

import pytest
from pyspark.sql import functions as F

from feedledger.functions import glob as G
from feedledger.functions import names as N

AS_OF_YEAR = 2031
LETTERS = "QWKZ"


def _valid():
    """Names built from their parts: every month, both sides of the pivot, with and without a segment."""
    for month in range(1, 13):
        for yy in (0, 31, 32, 99):
            for segment in (None, LETTERS[month % 4]):
                name = f"KX{LETTERS[yy % 4]}Y{yy:02d}{month:02d}{segment or ''}.DBC"
                yield (name.lower() if (yy + month) % 2 else name), ("KX", f"{LETTERS[yy % 4]}Y", (2000 if yy <= 31 else 1900) + yy, month, segment)


# one fault each, in the order in which they are looked for: a name with several has the first
FAULTS = {
    "extension": ["KXQY0501.DB", "KXQY0501.DBCX", "KXQY0501", ".", "KX"],
    "length": [f"{'KXQY0501'[:n]}.DBC" for n in range(1, 8)] + ["KXQY0501AB.DBC", "KXQY0501ABCD.DBC"],
    "segment": [f"KXQY0501{c}.DBC" for c in "09-_"],
    "catalog": ["1XQY0501.DBC", "K9QY0501.DBC", "K-QY05X1.DBC"],
    "state": ["KX1Y0501.DBC", "KXQ00501.DBC", "KXQ-A501.DBC"],
    "year": ["KXQYA501.DBC", "KXQY0Z01.DBC", "KXQY-5XX.DBC"],
    "month": ["KXQY05A1.DBC", "KXQY050B.DBC"],
    "month_range": ["KXQY0500.DBC", "KXQY0513.DBC", "KXQY0599.DBC"],
}


def test_parse_filename_of_built_names(spark):
    cases = dict(_valid())
    df = spark.createDataFrame([(n,) for n in cases], "name string")
    rows = {r["name"]: r["p"] for r in df.select("name", N.parse_filename("name", AS_OF_YEAR).alias("p")).collect()}
    for name, want in cases.items():
        p = rows[name]
        assert (p["catalog"], p["state"], p["year"], p["month"], p["segment"], p["error"]) == (*want, None), name


@pytest.mark.parametrize("fault", FAULTS)
def test_parse_faults(spark, fault):
    df = spark.createDataFrame([(n,) for n in FAULTS[fault]], "name string")
    for r in df.select("name", N.parse_filename("name", AS_OF_YEAR).alias("p")).collect():
        assert r["p"]["error"] == fault, r["name"]
        assert r["p"]["catalog"] is None


#: A literal, the wildcard, and every sign that a pattern escapes, as (glob, pattern).
PARTS = [("ab", "ab"), ("*", "%"), ("#", "##"), ("%", "#%"), ("_", "#_")]
GLOBS = [tuple(map("".join, zip(*some))) for n in (1, 2, 3) for some in itertools.product(PARTS, repeat=n)]


def expected_pattern(glob, pattern):
    return pattern if "*" in glob else f"%{pattern}%"


def test_globs_of_all_parts():
    assert G.glob_to_ilike("") == "%"
    for glob, pattern in GLOBS:
        assert G.glob_to_ilike(glob) == expected_pattern(glob, pattern)


def test_glob_column_form_matches_literal(spark):
    df = spark.createDataFrame([(g, expected_pattern(g, p)) for g, p in GLOBS] + [("", "%")], "g string, p string")
    assert df.where(G.glob_to_ilike_col("g") != F.col("p")).count() == 0


def test_glob_matching_is_case_insensitive_and_literal(spark):
    df = spark.createDataFrame([("SPTO2602.DBC",), ("SP_O2602.DBC",), ("XX%Y.DBC",)], "filename string")
    assert [r[0] for r in df.where(G.matches_glob("filename", "spto")).collect()] == ["SPTO2602.DBC"]
    assert [r[0] for r in df.where(G.matches_glob("filename", "SP_")).collect()] == ["SP_O2602.DBC"]
    assert [r[0] for r in df.where(G.matches_glob("filename", "xx%*")).collect()] == ["XX%Y.DBC"]


def test_canonical_paths(spark):
    cases = [(c, st, y, m, f"{c}{st}{y % 100:02d}{m:02d}{seg}", ext) for c, st, seg in (("AQ", "AC", ""), ("ER", "DF", "K")) for y, m in ((7, 3), (2011, 10)) for ext in (".a", ".long")]
    df = spark.createDataFrame([(c, st, y, m, base + old, ext) for c, st, y, m, base, ext in cases for old in (".dbc", ".DBC")], "c string, s string, y int, m int, f string, e string")
    for root in ("/r", "/r/", "/r//"):
        for ext in (".a", ".long"):
            got = [r[0] for r in df.where(F.col("e") == ext).select(N.canonical_path(root, "c", "s", "y", "m", "f", ext)).collect()]
            assert got == [f"/r/{c}/{st}/{y:04d}/{m:02d}/{base}{ext}" for c, st, y, m, base, e in cases for _ in range(2) if e == ext]


def test_segment_backfill(spark):
    df = spark.createDataFrame([("RDSP2401A.DBC", None), ("RDSP2401.DBC", None), ("RDSP24017.DBC", None), ("RDSP2401B.DBC", "C")],
                               "f string, s string")
    assert [r[0] for r in df.select(N.segment_backfill("f", "s")).collect()] == ["A", None, None, "C"]
