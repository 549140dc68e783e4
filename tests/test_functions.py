"""Expressions whose meaning differs between engines, one test per difference."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from assayflow import functions as fn


def one(spark, col, **values):
    """Value of an expression over one row given as SQL literals."""
    row = spark.sql("select " + ", ".join(f"{v} as {k}" for k, v in values.items()) if values else "select 1 as one")
    return row.select(col).head()[0]


def test_elapsed_days_counts_whole_days_not_midnights(spark):
    days = fn.elapsed_days(F.col("a"), F.col("b"))
    late = dict(a="timestamp_ntz'2024-01-01 23:00:00'", b="timestamp_ntz'2024-01-03 01:00:00'")
    assert one(spark, days, **late) == 1
    assert one(spark, fn.elapsed_days(F.col("b"), F.col("a")), **late) == -1
    assert one(spark, days, a="timestamp_ntz'2024-01-01'", b="cast(null as timestamp_ntz)") is None


def test_elapsed_days_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        span = dict(a="timestamp_ntz'2024-03-09 12:00:00'", b="timestamp_ntz'2024-03-10 12:00:00'")
        assert one(spark, fn.elapsed_days(F.col("a"), F.col("b")), **span) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar_days_is_signed_bigint(spark):
    df = spark.sql("select date'2024-01-05' as a, date'2024-01-01' as b")
    out = df.select(fn.calendar_days(F.col("a"), F.col("b")).alias("d"))
    assert out.dtypes == [("d", "bigint")]
    assert out.head().d == -4


def test_greatest_strict_is_null_with_any_null(spark):
    both = fn.greatest_strict(F.col("a"), F.col("b"))
    assert one(spark, both, a="1", b="2") == 2
    assert one(spark, both, a="1", b="cast(null as int)") is None


def test_trim_strips_all_whitespace(spark):
    df = spark.createDataFrame([("\t　 a b \n",), (" x ",), (None,)], "s string")
    assert [r[0] for r in df.select(fn.trim_whitespace(F.col("s"))).collect()] == ["a b", " x ", None]


def test_month_start_is_a_date(spark):
    df = spark.sql("select date'2024-02-17' as d").select(fn.month_start(F.col("d")).alias("m"))
    assert df.dtypes == [("m", "date")]
    assert df.head().m == dt.date(2024, 2, 1)


def test_blank_text_is_null_and_bad_text_fails(spark):
    assert one(spark, fn.as_timestamp(F.col("t")), t="''") is None
    assert one(spark, fn.as_date(F.col("t")), t="'2024-01-02'") == dt.date(2024, 1, 2)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fn.as_timestamp(F.col("t")), t="'soon'")
    assert one(spark, fn.as_timestamp(F.col("t"), lenient=True), t="'soon'") is None


def test_integer_cast_rounds(spark):
    assert [one(spark, fn.as_integer(F.col("x")), x=f"{v}D") for v in (2.4, 2.5, 2.6, -2.5)] == [2, 3, 3, -3]


def test_flags_are_never_null(spark):
    assert one(spark, fn.flag(F.col("x") != "a"), x="cast(null as string)") is False
    assert one(spark, fn.is_expired(F.col("x"), F.lit(dt.date(2024, 1, 1))), x="cast(null as date)") is False
    assert one(spark, fn.is_depleted(F.col("x")), x="0D") is True
    assert one(spark, fn.is_depleted(F.col("x")), x="cast(null as double)") is False


def test_safe_ratio_of_nothing_is_null(spark):
    assert one(spark, fn.safe_ratio(F.lit(0), F.lit(0))) is None
    assert one(spark, fn.safe_ratio(F.lit(1), F.lit(4))) == 0.25
