"""Row rules against the edge tables of FIXTURES.md §4."""

import datetime as dt

from leakwatch.functions.context import after_hours_flag, day_of_week, parse_timestamp, risky_day_flag, risky_domain_flag
from leakwatch.functions.files import base_name, double_extension_flag, file_extension, keyword_flag
from leakwatch.functions.patterns import alternation, clean_entries

NAMES = [
    # name, extension, base, double, keyword
    ("a.csv", "csv", "a", 0, 0),
    ("noext", "noext", "noext", 0, 0),
    (".bashrc", "bashrc", "", 0, 0),
    ("file.", "", "file.", 0, 0),
    ("Data.CSV.zip", "zip", "Data.CSV", 0, 0),
    ("x.pyramid.txt", "txt", "x.pyramid", 1, 0),
    ("classnotes.txt", "txt", "classnotes", 0, 1),
    ("a.b.c", "c", "a.b", 0, 0),
    ("", "", "", 0, 0),
    (None, None, None, 0, 0),
]


def test_file_name_rules(spark):
    df = spark.createDataFrame([(n,) for n, *_ in NAMES], "name string")
    base = base_name("name")
    out = df.select(
        "name",
        file_extension("name").alias("ext"),
        base.alias("base"),
        double_extension_flag(base, ["pdf", "csv", "py"]).alias("dbl"),
        keyword_flag(base, ["ssn", "auth"]).alias("kw"),
    ).collect()
    got = {r["name"]: (r["ext"], r["base"], r["dbl"], r["kw"]) for r in out}
    for name, ext, b, dbl, kw in NAMES:
        assert got[name] == (ext, b, dbl, kw), name


def test_strict_double_extension(spark):
    df = spark.createDataFrame([("Data.CSV.zip",), ("x.pyramid.txt",), ("a.py.zip",)], "name string")
    out = df.select("name", double_extension_flag(base_name("name"), ["csv", "py"], strict=True).alias("f"))
    got = {r["name"]: r["f"] for r in out.collect()}
    assert got == {"Data.CSV.zip": 1, "x.pyramid.txt": 0, "a.py.zip": 1}


def test_time_bounds(spark):
    rows = [(dt.datetime(2024, 1, 7, 5, 59, 59),), (dt.datetime(2024, 1, 7, 6, 0, 0),),
            (dt.datetime(2024, 1, 8, 18, 59, 59),), (dt.datetime(2024, 1, 12, 19, 0, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    out = df.select(after_hours_flag("ts").alias("ah"), day_of_week("ts").alias("dow"),
                    risky_day_flag(day_of_week("ts")).alias("mf")).collect()
    assert [r["ah"] for r in out] == [1, 0, 0, 1]
    # 2024-01-07 is a Sunday, 01-08 a Monday, 01-12 a Friday.
    assert [r["dow"] for r in out] == [1, 1, 2, 6]
    assert [r["mf"] for r in out] == [0, 0, 1, 1]


def test_dictionary_cleaning_and_quoting():
    assert clean_entries(["  A+b ", "", None, "a+B", "c.d"]) == ["a+b", "c.d"]
    assert alternation([]) is None
    assert alternation(["   "]) is None
    assert alternation(["a+b", "c.d"]) == r"a\+b|c\.d"


def test_domain_matching_modes(spark):
    doms = ["drop.files.example", "DROP.Files.Example", "notquickshare.example", "quickshare.example.evil",
            "cdxd.example", None]
    df = spark.createDataFrame([(d,) for d in doms], "d string")
    out = df.select(
        "d",
        risky_domain_flag("d", [" Quickshare.example ", "drop.files.example", "c.d"]).alias("sub"),
        risky_domain_flag("d", ["quickshare.example", "drop.files.example"], mode="suffix").alias("suf"),
        risky_domain_flag("d", []).alias("empty"),
    ).collect()
    got = {r["d"]: (r["sub"], r["suf"], r["empty"]) for r in out}
    assert got["drop.files.example"] == (1, 1, 0)
    assert got["DROP.Files.Example"] == (1, 1, 0)
    assert got["notquickshare.example"] == (1, 0, 0)
    assert got["quickshare.example.evil"] == (1, 0, 0)
    assert got["cdxd.example"] == (0, 0, 0)  # "c.d" is literal, not a regex
    assert got[None] == (0, 0, 0)


def test_parse_timestamp(spark):
    df = spark.createDataFrame([("2024-03-01T10:00:00Z",), ("2024-03-01T10:00:00+02:00",), ("junk",), (None,)],
                               "t string")
    out = [r[0] for r in df.select(parse_timestamp("t")).collect()]
    assert out[0] == dt.datetime(2024, 3, 1, 10, 0, 0)
    assert out[1] == dt.datetime(2024, 3, 1, 8, 0, 0)  # offset applied
    assert out[2] is None and out[3] is None


def test_dictionary_loader(spark, tmp_path):
    from leakwatch.sources.dictionaries import dictionary_values, load_dictionary, read_dictionary_file

    p = tmp_path / "kw.csv"
    p.write_text("keyword\n  Client \nPAYROLL\n\n a+b\nclient\n")
    df = load_dictionary(spark, str(p), "keyword")
    assert dictionary_values(df) == ["a+b", "client", "payroll"]
    assert read_dictionary_file(str(p), "keyword") == ["client", "payroll", "a+b"]
    empty = tmp_path / "empty.csv"
    empty.write_text("keyword\n")
    assert dictionary_values(load_dictionary(spark, str(empty), "keyword")) == []


def test_fixture_rates_match_measurement(spark):
    """FIXTURES.md §1: rates measured independently at sf0.01 (whole percent)."""
    from pyspark.sql import functions as F

    from leakwatch.plans import fixture_queries as Q

    f = Q.features(spark, "/root/testdata/sf0.01")
    row = f.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("AccountDisplayName").alias("users"),
        F.sum(F.col("ObjectName").isNull().cast("int")).alias("null_names"),
        *[F.avg(c).alias(c) for c in ("file_name_has_sensitive_keyword", "double_extension_check",
                                      "is_high_risk_extension", "is_risky_target_domain", "is_high_risk_position",
                                      "is_after_hours", "is_monday_or_friday", "Risk_Label")],
    ).first()
    assert (row["n"], row["users"], row["null_names"]) == (10000, 150, 104)
    expected = {"file_name_has_sensitive_keyword": 41, "double_extension_check": 14, "is_high_risk_extension": 59,
                "is_risky_target_domain": 39, "is_high_risk_position": 50, "is_after_hours": 45,
                "is_monday_or_friday": 30, "Risk_Label": 43}
    assert {c: round(100 * row[c]) for c in expected} == expected
