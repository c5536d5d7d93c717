from datetime import datetime

from pyspark.sql import functions as F

from tallybook import functions as fn
from tallybook.functions.text import extract_or_null


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_title_case(spark):
    rows = [("CREDIT and THE card",), ("the card",), ("a  b",), ("",), (None,), ("élan OF x",)]
    assert values(spark, rows, "s string", fn.title_case(F.col("s"))) == [
        "Credit and the Card", "the Card", "a  B", "", None, "Élan Of X",
    ]


def test_format_size(spark):
    rows = [(0,), (1023,), (1024,), (1536,), (1048576,), (1073741824,), (1024 * 100,), (None,)]
    assert values(spark, rows, "n bigint", fn.format_size(F.col("n"))) == [
        "0 B", "1023 B", "1 KB", "1.5 KB", "1 MB", "1 GB", "100 KB", None,
    ]


def test_extract_or_null(spark):
    rows = [("ACME DES:X",), ("ACME",), (None,), ("",)]
    assert values(spark, rows, "s string", extract_or_null(F.col("s"), r"^(.*?)(?: DES:|$)")) == [
        "ACME", "ACME", None, "",
    ]
    assert values(spark, rows, "s string", extract_or_null(F.col("s"), r"^(.*) DES:")) == [
        "ACME", None, None, None,
    ]


def test_category_path(spark):
    rows = [("a", "b", "c"), ("a", None, "c"), ("a", "b", None), (None, "b", "c")]
    path = fn.category_path(F.col("x"), F.col("y"), F.col("z"))
    assert values(spark, rows, "x string, y string, z string", path) == [
        "a - b - c", "a - c", "a - b", None,
    ]


def test_first_of(spark):
    rows = [(["x", "y"],), ([],), (None,)]
    assert values(spark, rows, "a array<string>", fn.first_of(F.col("a"))) == ["x", None, None]


def test_pct_change(spark):
    rows = [(11.0, 10.0), (1.0, 0.0), (None, 1.0), (-5.0, -10.0)]
    assert values(spark, rows, "a double, b double", F.expr(fn.pct_change_sql("a", "b"))) == [
        10.0, None, None, 50.0,
    ]


def test_money_sum_is_exact(spark):
    rows = [(0.1,)] * 10 + [(0.2,)] * 10
    df = spark.createDataFrame(rows, "x double").repartition(7)
    assert df.agg(fn.money_sum(F.col("x"))).first()[0] == 3.0


def test_partition_offset(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 31, 0, 30),)], "ts timestamp_ntz")
    got = df.select(
        *[
            fn.partition_offset(F.col("ts"), F.lit(o), g)
            for g, o in (("day", -1), ("month", -1), ("month", 1), ("hour", -1), ("hour_t", 0))
        ]
    ).first()
    assert list(got) == ["20240330", "202402", "202404", "2024033023", "20240331T00"]


def test_offset_of_floors_days_and_hours_but_truncates_months(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 31, 13, 30),)], "ts timestamp_ntz")

    def at(text):
        return F.lit(text).cast("timestamp_ntz")

    cases = [
        ("day", "2024-03-31 00:00:00", -1),
        ("day", "2024-04-01 00:00:00", 0),
        ("hour", "2024-03-31 12:00:00", -2),
        ("hour", "2024-03-31 13:30:00", 0),
        ("month", "2024-03-01 00:00:00", 0),
        ("month", "2024-02-01 00:00:00", -1),
        ("month", "2024-05-01 00:00:00", 1),
    ]
    got = df.select(*[fn.offset_of(at(t), F.col("ts"), g) for g, t, _ in cases]).first()
    assert list(got) == [c[2] for c in cases]


def test_partition_id(spark):
    names = ["a_YYYYMMDD", "b_YYYYMM", "c_YYYYMMDDHH", "d_YYYYMMDDTHH", "plain", None]
    rows = [(n, datetime(2024, 1, 1, 5)) for n in names]
    made = fn.partition_id(F.col("t"), F.col("ts"), F.lit(-1))
    assert values(spark, rows, "t string, ts timestamp_ntz", made) == [
        "a_20231231", "b_202312", "c_2024010104", "d_20240101T04", "plain", None,
    ]


def test_suffix_round_trip(spark):
    rows = [("events_20240105",), ("a_202401",), ("b_2024010512",), ("c_20240105T12",), ("temp",)]
    df = spark.createDataFrame(rows, "t string").select(fn.split_suffix(F.col("t")).alias("p"))
    assert [tuple(r.p) for r in df.collect()] == [
        ("events_", "day", "20240105"),
        ("a_", "month", "202401"),
        ("b_", "hour", "2024010512"),
        ("c_", "hour_t", "20240105T12"),
        ("temp", None, None),
    ]
    hour = spark.range(1).select(fn.parse_suffix(F.lit("20240105T12"), "hour_t")).first()[0]
    assert hour == datetime(2024, 1, 5, 12)
