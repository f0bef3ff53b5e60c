"""Golden marts on hand-made rows, presentation order and plan shape."""

import pytest
from pyspark.sql import functions as F

from star_fixture import EXPECTED, as_set, small_star
from turnstile import adapters
from turnstile.operators import marts
from turnstile.plans import full_load


@pytest.mark.parametrize("name", marts.MART_NAMES)
def test_golden_marts(spark, name):
    got = as_set(marts.mart(small_star(spark), name))
    want = {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in EXPECTED[name]}
    assert got == want


def test_shared_aggregates_give_same_marts(spark):
    star = small_star(spark)
    shared = full_load.build_marts(star, share_aggregates=True)
    for name, df in shared.items():
        assert as_set(df) == as_set(marts.mart(star, name)), name


def test_order_is_presentation_order(spark):
    rows = marts.mart(small_star(spark), "busiest_stations").collect()
    assert [r["station_name"] for r in rows] == ["Angel", "Bank", "Oval"]
    rows = marts.mart(small_star(spark), "quarterly_trend").collect()
    assert [(r["year"], r["quarter"]) for r in rows] == [(2020, 1), (2020, 2), (2021, None)]


def test_mean_of_means_compat(spark):
    a = spark.createDataFrame([(True, 1, 10, 10.0)], "has_night_tube boolean, num_records long, "
                              "total_passengers long, avg_passengers_per_record double")
    b = spark.createDataFrame([(True, 3, 6, 2.0)], a.schema)
    row = marts.merge_mean_of_means(a, b).first()
    assert (row["num_records"], row["total_passengers"], row["avg_passengers_per_record"]) == (4, 16, 6.0)


def test_totals_agree_without_orphans(spark):
    star = adapters.test_star(spark, "/root/testdata/sf0.001")
    totals = {r["gold_table"]: r["grand_total"]
              for r in full_load.total_check(full_load.build_marts(star)).collect()}
    assert len(set(totals.values())) == 1
    net = marts.mart(star, "passengers_by_network").agg(F.sum("total_passengers")).first()[0]
    assert net == totals["busiest_stations"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_period_filter_reaches_scan_and_columns_pruned(spark):
    star = adapters.test_star(spark, "/root/testdata/sf0.001", last_year=2000)
    plan = _plan(marts.mart(star, "busiest_stations"))
    assert "LessThan(l_shipdate" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_bridge_mart_aggregates_before_the_bridge_join(spark):
    """Eager aggregation: the fact reaches the bridge join as one row per station."""
    star = adapters.test_star(spark, "/root/testdata/sf0.001")
    lines = marts.mart(star, "passengers_by_line")._jdf.queryExecution().optimizedPlan().toString()
    lines = lines.splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))
    join = next(i for i, s in enumerate(lines) if "Join Inner, (station_id" in s)
    fact_side = lines[join + 1]
    assert "Aggregate [station_id" in fact_side and depth(fact_side) > depth(lines[join])


def test_no_forced_broadcast_of_dimensions(spark):
    star = adapters.test_star(spark, "/root/testdata/sf0.001")
    for name in marts.MART_NAMES:
        analyzed = marts.mart(star, name)._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in analyzed and "strategy=broadcast" not in analyzed, name


def test_granularity_filter(spark):
    star = small_star(spark)
    dates = star.dates.withColumn("is_annual", F.col("quarter").isNull())
    dt = marts.date_totals(star.fact)
    assert as_set(marts.passengers_by_year(dt, dates, annual=True)) == {(2021, 20)}
    assert as_set(marts.passengers_by_year(dt, dates, annual=False)) == {(2020, 125)}


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_reduced_map_side(spark):
    """A key holding a third of all rows must be combined before the shuffle."""
    from turnstile.operators import events as ev
    fact = spark.range(30000).selectExpr(
        "id AS entry_exit_id",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE CAST(id AS INT) END AS station_id",  # skewed fixture
        "20200101 AS date_id", "CAST(1 AS BIGINT) AS total_entry_exit")
    plan = _executed(marts.station_totals(fact))
    assert "partial_sum" in plan and plan.index("partial_sum") > plan.index("Exchange")
    rows = fact.selectExpr("CAST(station_id AS STRING) AS id", "entry_exit_id AS kafka_offset",
                           "0 AS kafka_partition", "CAST(NULL AS TIMESTAMP) AS kafka_ingest_time")
    plan = _executed(ev.latest_by(rows, ["id"], ["kafka_ingest_time", "kafka_partition", "kafka_offset"]))
    assert "partial_max_by" in plan
    got = marts.station_totals(fact).filter("station_id = 1").first()
    # ids divisible by 3, plus id 1 itself
    assert (got["num_records"], got["total_passengers"]) == (10001, 10001)
