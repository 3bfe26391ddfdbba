"""Scalar rules on hand-written rows, including the dialect traps."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions import expr as X


def one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_first_upper_is_not_initcap(spark):
    out = one(spark, X.first_upper("c"), "c string",
              [("north andover",), ("NEW HAMPSHIRE",), (" bos",), ("x",)])
    assert out == ["North andover", "New hampshire", "bos", "X"]


def test_title_or_blank(spark):
    out = one(spark, X.title_or("c", "Unknown"), "c string", [("",), ("  ",), (None,), ("white",)])
    assert out == ["Unknown", "Unknown", "Unknown", "White"]
    out = one(spark, X.title_or("c", None), "c string", [("",), ("boston",)])
    assert out == [None, "Boston"]


def test_person_name_null_as_empty(spark):
    rows = [("Mr.", "John", "Smith"), (None, "Ann", "Lee"), ("Mrs.", None, "Doe"), (" Dr. ", " Bo ", " Li ")]
    out = one(spark, X.person_name("p", "f", "l"), "p string, f string, l string", rows)
    assert out == ["Mr. John Smith", "Ann Lee", "Mrs.  Doe", "Dr. Bo Li"]


def test_recode_case_and_blank_insensitive(spark):
    out = one(spark, X.recode("c", {"S": "Single", "M": "Married"}), "c string",
              [("s",), (" M ",), ("D",), (None,)])
    assert out == ["Single", "Married", "Unknown", "Unknown"]


def test_null_to_only_null(spark):
    assert one(spark, X.null_to("c", "Unknown"), "c string", [(None,), ("",)]) == ["Unknown", ""]


def test_minute_diff_counts_boundaries(spark):
    rows = [(dt.datetime(2020, 1, 1, 10, 0, 59), dt.datetime(2020, 1, 1, 10, 1, 0)),
            (dt.datetime(2020, 1, 1, 10, 0, 0), dt.datetime(2020, 1, 1, 10, 0, 59, 999999)),
            (dt.datetime(2020, 1, 1, 10, 5, 30), dt.datetime(2020, 1, 1, 10, 0, 0)),
            (dt.datetime(1969, 12, 31, 23, 59, 30), dt.datetime(1970, 1, 1, 0, 0, 30))]
    out = one(spark, X.minute_diff("a", "b"), "a timestamp_ntz, b timestamp_ntz", rows)
    assert out == [1, 0, -5, 1]


def test_year_diff_calendar_years(spark):
    rows = [(dt.date(1990, 12, 31), dt.datetime(1991, 1, 1)), (dt.date(1990, 1, 1), dt.datetime(1990, 12, 31))]
    assert one(spark, X.year_diff("a", "b"), "a date, b timestamp_ntz", rows) == [1, 0]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2023, 9, 30),), (dt.date(2023, 10, 1),), (dt.date(2024, 2, 29),),
                                (dt.date(2024, 3, 2),), (dt.date(2024, 3, 3),)], "d date")
    rows = df.select(X.date_key("d"), X.fiscal_year("d"), X.fiscal_quarter("d"), X.fiscal_month("d"),
                     X.day_of_week("d"), X.day_name("d"), X.is_weekend("d")).collect()
    assert [tuple(r) for r in rows] == [
        (20230930, 2023, 4, 12, 7, "Saturday", True),
        (20231001, 2024, 1, 1, 1, "Sunday", True),
        (20240229, 2024, 2, 5, 5, "Thursday", False),
        (20240302, 2024, 2, 6, 7, "Saturday", True),
        (20240303, 2024, 2, 6, 1, "Sunday", True)]


def test_floors_and_caps(spark):
    rows = [(Decimal("0.00"), Decimal("10.00")), (Decimal("-5.00"), Decimal("10.00")),
            (None, Decimal("10.00")), (Decimal("12.50"), Decimal("10.00")), (Decimal("3.25"), Decimal("10.00")),
            (Decimal("4.00"), Decimal("-1.00"))]
    df = spark.createDataFrame(rows, "cov decimal(10,2), claim decimal(10,2)")
    out = df.select(X.floor_to_one("cov", "decimal(10,2)").alias("f"),
                    X.cap_coverage("cov", "claim", "decimal(10,2)").alias("c"))
    assert out.schema["f"].dataType.simpleString() == "decimal(10,2)"
    got = [(r.f, r.c) for r in out.collect()]
    assert got == [(Decimal("1.00"), Decimal("1.00")), (Decimal("1.00"), Decimal("1.00")), (None, None),
                   (Decimal("12.50"), Decimal("10.00")), (Decimal("3.25"), Decimal("3.25")),
                   (Decimal("4.00"), Decimal("-1.00"))]


def test_cap_duration_keeps_zero(spark):
    out = one(spark, X.cap_duration("d", F.lit(100)), "d int", [(0,), (-7,), (150,), (100,), (None,)])
    assert out == [0, 1, 100, 100, None]


def test_ntz_literal_is_time_zone_free(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = spark.range(1).select(X.ntz_lit(dt.datetime(2024, 1, 1, 0, 0))).first()[0]
        assert got == dt.datetime(2024, 1, 1, 0, 0)
        mins = spark.range(1).select(X.minute_diff(X.ntz_lit("2024-03-10 01:59:00"),
                                                   X.ntz_lit("2024-03-10 03:01:00"))).first()[0]
        assert mins == 62
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
