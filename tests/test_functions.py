import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.functions import clean, clean_lower, day_of_week, float_ratio, numeric_add, numeric_ratio, numeric_subtract


def test_clean_strips_unicode_blanks(spark):
    df = spark.createDataFrame([("  a b \t",), (" x ",), (None,)], "s string")
    out = [r[0] for r in df.select(clean("s")).collect()]
    assert out == ["a b", "x", None]
    assert df.select(clean_lower(F.lit(" AbC "))).first()[0] == "abc"


def test_numeric_ratio_half_up_and_null_on_zero(spark):
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("3.00")), (Decimal("2.00"), Decimal("0.00")),
                                (Decimal("1.00"), Decimal("1024.00")), (Decimal("-1.00"), Decimal("1024.00"))],
                               "a decimal(18,2), b decimal(18,2)")
    out = [r[0] for r in df.select(numeric_ratio("a", "b")).collect()]
    assert out == [Decimal("0.333333333"), None, Decimal("0.000976563"), Decimal("-0.000976563")]
    assert df.select(numeric_ratio("a", "b", scale=4)).first()[0] == Decimal("0.3333")


def test_float_ratio_and_day_of_week(spark):
    df = spark.createDataFrame([(3, 4, dt.date(2024, 1, 7)), (1, 0, dt.date(2024, 1, 13))], "a int, b int, d date")
    rows = df.select(float_ratio("a", "b").alias("r"), day_of_week("d").alias("w")).collect()
    assert rows[0]["r"] == 0.75 and rows[1]["r"] is None
    assert [r["w"] for r in rows] == [1, 7]  # Sunday = 1, Saturday = 7


def test_numeric_keeps_nine_digits_and_reaches_beyond_1e12(spark):
    df = spark.createDataFrame([(Decimal("0.000000001"), Decimal("0.000000002")), (Decimal("1000000000000.000000001"), Decimal("4"))],
                               "a decimal(38,9), b decimal(38,9)")
    small, large = df.select(numeric_add("a", "b").alias("s"), numeric_subtract("a", "b").alias("d"), numeric_ratio("a", "b").alias("q")).collect()
    assert (small.s, small.d, small.q) == (Decimal("0.000000003"), Decimal("-0.000000001"), Decimal("0.5"))
    assert (large.s, large.d, large.q) == (Decimal("1000000000004.000000001"), Decimal("999999999996.000000001"), Decimal("250000000000"))


def test_trim_takes_every_unicode_blank(spark):
    blanks = "\u00a0\u2003\u2028\u3000\x85\x0b"
    assert spark.range(1).select(clean(F.lit(f"{blanks}a {blanks} b{blanks}"))).first()[0] == f"a {blanks} b"
