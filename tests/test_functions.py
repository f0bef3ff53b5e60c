"""Truth tables for the arrival scalar functions (decisions documented in the README)."""

import pytest
from pyspark.sql import functions as F

from turnstile.functions import arrivals as fx


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("value,dtype,level,mins", [
    (-30, "int", "arriving", -0.5),
    (0, "int", "arriving", 0.0),
    (None, "int", "unknown", 0.0),
    (1, "int", "arriving", 0.02),
    (60, "int", "arriving", 1.0),
    (61, "int", "close", 1.02),
    (300, "int", "close", 5.0),
    (301, "int", "medium", 5.02),
    (600, "int", "medium", 10.0),
    (601, "int", "far", 10.02),
    (45.7, "double", "unknown", 0.0),
    ("45", "string", "arriving", 0.75),
    ("abc", "string", "unknown", 0.0),
])
def test_delay_level_and_minutes(spark, value, dtype, level, mins):
    assert one(spark, fx.delay_level, value, dtype) == level
    assert one(spark, fx.minutes, value, dtype) == pytest.approx(mins)


@pytest.mark.parametrize("text,bucket", [
    ("2024-01-01 06:59:59", "off_peak"),
    ("2024-01-01 07:00:00", "morning_peak"),
    ("2024-01-01T09:59:59Z", "morning_peak"),
    ("2024-01-01 10:00:00", "off_peak"),
    ("2024-01-01 15:59:59", "off_peak"),
    ("2024-01-01 16:00:00", "evening_peak"),
    ("2024-01-01 19:59:59", "evening_peak"),
    ("2024-01-01 20:00:00", "off_peak"),
    ("", "off_peak"),
    ("garbage", "off_peak"),
    (None, "off_peak"),
])
def test_peak_bucket(spark, text, bucket):
    assert one(spark, fx.peak_bucket, text) == bucket


@pytest.mark.parametrize("text,out", [(None, ""), ("", ""), (" King's Cross ", "Kings Cross")])
def test_clean_text(spark, text, out):
    assert one(spark, fx.clean_text, text) == out


def test_row_key(spark):
    df = spark.createDataFrame([("King's Cross", "Hammersmith & City", "042", "T1"),
                                (None, None, None, None)], "s string, l string, v string, t string")
    keys = [r["k"] for r in df.select(fx.row_key("s", "l", "v", "t").alias("k")).collect()]
    assert keys == ["KingsCross#Hammersmith&City#042#T1", "###"]
