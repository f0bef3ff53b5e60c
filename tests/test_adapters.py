"""The derived tables make the checks mean something: every case that an operator decides occurs."""

from pyspark.sql import functions as F

from turnstile import adapters
from turnstile.functions.arrivals import delay_level
from turnstile.operators import events as ev

SF = "/root/testdata/sf0.01"


def test_bridge_is_not_saturated(spark):
    star, later = adapters.test_star(spark, SF), adapters.increment_star(spark, SF)
    stations, lines = star.stations.count(), star.lines.count()
    assert star.bridge.count() < 0.6 * stations * lines
    assert star.bridge.groupBy("station_id").count().select("count").distinct().count() > 1
    # the replace-by-key merge has stations to keep and stations to replace
    assert 0 < later.bridge.select("station_id").distinct().count() < stations


def test_some_facts_have_no_date_row(spark):
    star = adapters.with_order_dates(adapters.test_star(spark, SF), spark, SF)
    assert star.fact.join(star.dates, "date_id", "left_anti").count() > 0


def test_feed_holds_every_case(spark):
    parsed = ev.parse_arrivals(adapters.arrival_messages(spark, SF))
    valid, bad = ev.split(parsed)
    assert {r["reason"] for r in bad.select("reason").distinct().collect()} == {"malformed", "null_value", "missing_id"}
    levels = valid.select(delay_level("timeToStation").alias("l")).distinct().collect()
    assert {r["l"] for r in levels} == {"arriving", "close", "medium", "far", "unknown"}
    row = valid.agg(F.count_if(F.contains("stationName", F.lit("'"))).alias("quoted"),
                    F.count_if(F.col("message_ingested_at").isNull()).alias("defaulted"),
                    F.count("message_ingested_at").alias("stamped")).first()
    assert all(row)
    keyed = ev.enrich(valid)
    assert keyed.select("row_key").distinct().count() < 0.95 * keyed.count()  # last write wins has work to do


def test_the_bridge_is_dealt_to_as_many_tasks_as_its_rows_ask_for(spark, monkeypatch):
    whole = adapters.test_star(spark, SF).bridge
    rows = sorted(map(tuple, whole.collect()))
    assert whole.rdd.getNumPartitions() == 1 and rows
    monkeypatch.setattr(adapters, "BRIDGE_ROWS", 250)
    dealt = adapters.test_star(spark, SF).bridge
    assert dealt.rdd.getNumPartitions() == adapters.table_rows(spark, SF, "lineitem") // 250 > 20
    assert sorted(map(tuple, dealt.collect())) == rows


def test_the_bridge_leaves_out_keys_without_a_part(spark):
    li = spark.createDataFrame([(1, 1), (1, 1), (2, None), (2, None), (None, 1), (None, 1), (3, 1), (3, 9), (3, 9)],
                               "l_suppkey long, l_partkey long")
    part = spark.createDataFrame([(1, "B", 5), (None, "B", 6)], "p_partkey long, p_brand string, p_size int")
    got = adapters.bridge_from_lineitem(li, part, 3)
    assert set(map(tuple, got.collect())) == {(1, "B#5"), (None, "B#5")} and got.count() == 2
