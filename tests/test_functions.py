from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fieldtally.functions import casts, columns, periods
from fieldtally.functions.rates import rate


def test_standard_names_and_clashes(spark):
    df = spark.createDataFrame([(1, 2)], " ` Last-Updated ` int, `Org Unit` int")
    assert columns.standardize_names(df).columns == ["last_updated", "org_unit"]
    with pytest.raises(ValueError, match="a_b"):
        columns.standardize_names(spark.createDataFrame([(1, 2)], "`a b` int, `A-B` int"))


def test_existing_and_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert columns.select_existing(df, ["b", "c", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match=r"t lacks \['c'\]"):
        columns.require_columns(df, ["a", "c"], "t")


def test_period_dates(spark):
    df = spark.createDataFrame([("202401",), ("202413",), (None,), ("202402",),
                                ("20240",), ("2024011",), ("2024-1",), ("202400",)], "period string")
    rows = {r.period: r for r in periods.with_period_dates(df).collect()}
    first = rows["202401"]
    assert (first.period_start_date, first.period_end_date) == (date(2024, 1, 1), date(2024, 1, 31))
    assert (first.year, first.month, first.quarter, first.year_month) == (2024, 1, 1, "202401")
    assert rows["202402"].period_end_date == date(2024, 2, 29)
    for bad in ("202413", "20240", "2024011", "2024-1", "202400", None):
        assert rows[bad].period_start_date is None and rows[bad].quarter is None


def test_timestamps_never_throw(spark):
    df = spark.createDataFrame([("2024-02-01T00:00:00",), ("junk",), (None,)], "t string")
    found = [r.t for r in periods.standardize_timestamps(df, ["t"]).collect()]
    assert found == [datetime(2024, 2, 1), None, None]


def test_late_from_the_first_second_of_the_deadline_day(spark):
    rows = [("202401", datetime(2024, 3, 31)), ("202401", datetime(2024, 3, 31, 0, 0, 1)),
            ("202401", None)]
    df = spark.createDataFrame(rows, "period string, lastupdated timestamp")
    late = periods.with_late_flag(df).collect()
    assert late[0].reporting_deadline == date(2024, 3, 31)
    assert [r.is_late_submission for r in late] == [False, True, None]


@pytest.mark.parametrize("text, kind, number, flag", [
    ("12", "INTEGER", 12.0, None), (" 12 ", "INTEGER_POSITIVE", 12.0, None),
    ("12.7", "INTEGER", 12.0, None), ("-12.7", "INTEGER", -12.0, None),
    ("12.", "INTEGER", 12.0, None), (".5", "INTEGER", 0.0, None), ("-.5", "INTEGER", 0.0, None),
    (".", "INTEGER", 0.0, None), ("", "INTEGER", None, None), ("+", "INTEGER", None, None),
    ("abc", "INTEGER", None, None), ("3000000000", "INTEGER", None, None),
    ("3000000000.5", "INTEGER", None, None), ("1e3", "INTEGER", None, None),
    ("1e3", "NUMBER", 1000.0, None), ("0.0", "PERCENTAGE", 0.0, None),
    ("abc", "NUMBER", None, None), (None, "NUMBER", None, None),
    ("yes", "BOOLEAN", None, True), ("F", "TRUE_ONLY", None, False),
    ("maybe", "BOOLEAN", None, None), ("5", "TEXT", None, None), ("5", None, None, None),
])
def test_typed_values(spark, text, kind, number, flag):
    df = spark.createDataFrame([(text, kind)], "value string, value_type string")
    row = casts.with_typed_values(df).first()
    assert (row.numeric_value, row.boolean_value) == (number, flag)


def test_guarded_casts_agree_with_plain_ones(spark):
    """The patterns that save failed casts let through all that a cast reads."""
    texts = ["1", " 1 ", "\t-5\n", "+7", "1.5", ".5", "5.", "1e3", "-1E-3", "NaN", "nan", "inf",
             "-Infinity", "1d", "2F", "0x1p3", "abc", "", " ", "12abc", "1 2", "true", " T ",
             "YES", "y", "no", "N", "0", "false\n", "on", "tr ue", "\x01 3", "999999999",
             "2147483647", "2147483648", "-2147483648", "0000000000012"]
    df = spark.createDataFrame([(text,) for text in texts], "v string")
    text = F.col("v")
    rows = df.select(
        "v", casts.number(text).alias("n"), text.try_cast("double").alias("n2"),
        casts.flag(text).alias("b"), text.try_cast("boolean").alias("b2"),
        casts.truncated_int(text).alias("i"), text.try_cast("int").alias("i2")).collect()
    for row in rows:
        assert repr(row.n) == repr(row.n2), row
        assert row.b == row.b2, row
        if row.i2 is not None:
            assert row.i == row.i2, row
    found = {row.v: row.i for row in rows}
    assert found["1.5"] == 1 and found["5."] == 5 and found["0000000000012"] == 12
    assert found["2147483648"] is None and found["12abc"] is None


def test_missing_and_completeness_flags(spark):
    df = spark.createDataFrame([(None,), ("",), ("0",), ("0.0",)], "value string").withColumn(
        "value_type", F.lit("NUMBER"))
    typed = casts.with_completeness_flags(casts.with_missing_flags(casts.with_typed_values(df)))
    found = [(r.is_null_value, r.is_blank_value, r.is_zero_value, r.has_reported_value,
              r.has_valid_numeric_value) for r in typed.collect()]
    assert found == [(True, None, None, False, False), (False, True, False, True, False),
                     (False, False, True, True, True), (False, False, False, True, True)]


def test_rate_of_nothing_is_zero(spark):
    found = spark.range(1).select(
        rate(F.lit(0), F.lit(0)).alias("none"), rate(F.lit(1), F.lit(3)).alias("third")).first()
    assert (found.none, found.third) == (0.0, 0.3333)
