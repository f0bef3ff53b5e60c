"""Property tests: the Column helpers against plain-Python statements of the same rules."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnstile.functions import arrivals as fx

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_level(t):
    if t is None:
        return "unknown"
    return "arriving" if t <= 60 else "close" if t <= 300 else "medium" if t <= 600 else "far"


def py_minutes(t):
    return 0.0 if t is None else round(t / 60, 2)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-10_000, 100_000)), min_size=1, max_size=300))
def test_level_and_minutes(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t int")
    got = df.select(fx.delay_level("t").alias("l"), fx.minutes("t").alias("m")).collect()
    assert [(r["l"], r["m"]) for r in got] == [(py_level(v), py_minutes(v)) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(max_size=12)), min_size=1, max_size=200))
def test_clean_and_key(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select(fx.clean_text("s").alias("c"), fx.row_key("s", "s", F.lit("v"), F.lit("t")).alias("k")).collect()
    for v, r in zip(values, got):
        c, (first, second, vehicle, when) = r["c"], r["k"].replace("v#t", "v\0t")[:-4].split("#") + ["v", "t"] \
            if (v or "").count("#") == 0 else (None, None, "v", "t")
        assert "'" not in c and (not c or not (c[0].isspace() or c[-1].isspace()))
        # what is kept stands in the same order, and only quotes and outer white space went
        rest = iter(v or "")
        assert all(ch in rest for ch in c)
        assert sum(not ch.isspace() and ch != "'" for ch in v or "") == sum(not ch.isspace() for ch in c)
        if first is not None:
            assert first == second and " " not in first and "'" not in first
    again = spark.createDataFrame([(r["c"],) for r in got], "s string").select(fx.clean_text("s").alias("c"))
    assert [r["c"] for r in again.collect()] == [r["c"] for r in got]  # idempotent


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 23), st.integers(0, 59)), min_size=1, max_size=100))
def test_peak_bucket(spark, times):
    texts = [f"2024-01-01 {h:02d}:{m:02d}:00" for h, m in times]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(fx.peak_bucket("s")).collect()]
    want = ["morning_peak" if 7 <= h < 10 else "evening_peak" if 16 <= h < 20 else "off_peak"
            for h, _ in times]
    assert got == want
