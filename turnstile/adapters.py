"""Maps the driver's test tables onto the star schema and the arrival feed.

Star mapping (all derived by Spark from the given tables, nothing synthesised):

  fact      lineitem: entry_exit_id = l_orderkey * 8 + l_linenumber,
            station_id = l_suppkey, date_id = yyyymmdd of l_shipdate,
            total_entry_exit = CAST(l_quantity AS BIGINT)
  dates     the distinct ship dates of the fact: year, quarter, month
  stations  supplier: s_suppkey, s_name, s_nationkey, has_night_tube = s_acctbal > 0
  networks  nation JOIN region: n_nationkey, n_name, r_name
  lines     part: distinct p_brand and p_size (id and name "<brand>#<size>")
  bridge    (l_suppkey, line) over lineitem JOIN part, of pairs that the period holds at least twice:
            every order line counts, a station is on some of the lines, and a short period's bridge
            misses some stations

The fact is a single scan of lineitem: the period lives on the line itself
(l_shipdate), so no lineitem x orders join is needed at any scale.

Periods: ``first_year`` / ``last_year`` bound the fact (and the dates and
bridge derived from it) with a range on l_shipdate that Parquet can push
down; the full load is years <= 2000 and the increment is 2001 and later.

Arrival feed: one topic record per ``events`` row (see ``arrival_messages``).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .star import Star

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table.  The frame (file listing + footer schema) is made once per
    session and reused: the tables are read-only, and every query plans its own
    scan from it, so pruning and pushdown are unaffected."""
    key = (id(spark), sf_dir.rstrip("/"), name)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _TABLES[key] = df
    return df


_ROWS: dict[tuple, int] = {}


def table_rows(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a test table, counted once per session (from the files' footers)."""
    df = table(spark, sf_dir, name)
    key = (id(df), sf_dir.rstrip("/"), name)  # a session's frame stays in _TABLES
    if key not in _ROWS:
        _ROWS[key] = df.count()
    return _ROWS[key]


def date_id_of(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def _year_bounds(col: Column, first_year: int | None, last_year: int | None) -> Column | None:
    cond = None
    if first_year is not None:
        cond = col >= F.lit(f"{first_year}-01-01 00:00:00").cast("timestamp_ntz")
    if last_year is not None:
        upper = col < F.lit(f"{last_year + 1}-01-01 00:00:00").cast("timestamp_ntz")
        cond = upper if cond is None else cond & upper
    return cond


def period_lineitem(spark: SparkSession, sf_dir: str, first_year: int | None = None,
                    last_year: int | None = None) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    cond = _year_bounds(F.col("l_shipdate"), first_year, last_year)
    return li if cond is None else li.filter(cond)


def fact_from_lineitem(li: DataFrame) -> DataFrame:
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("entry_exit_id"),
        F.col("l_suppkey").alias("station_id"),
        date_id_of(F.col("l_shipdate")).alias("date_id"),
        F.col("l_quantity").cast("bigint").alias("total_entry_exit"),
    )


def dates_from(df: DataFrame, column: str = "l_shipdate") -> DataFrame:
    return (df.select(F.to_date(F.col(column)).alias("day")).distinct()
            .select(date_id_of(F.col("day")).alias("date_id"),
                    F.year("day").alias("year"),
                    F.quarter("day").alias("quarter"),
                    F.month("day").alias("month"),
                    F.lit(False).alias("is_annual"),
                    F.date_format("day", "yyyy-MM-dd").alias("period_label"),
                    F.col("day").alias("period_start"),
                    F.col("day").alias("period_end")))


def stations_from_supplier(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.col("s_suppkey").alias("station_id"),
        F.col("s_name").alias("station_name"),
        F.col("s_nationkey").alias("network_id"),
        (F.col("s_acctbal") > 0).alias("has_night_tube"),
    )


def networks_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").alias("network_id"),
                    F.col("n_name").alias("network_name"),
                    F.col("r_name").alias("network_type")))


def line_key() -> Column:
    return F.concat_ws("#", "p_brand", F.col("p_size").cast("string"))


def lines_from_part(part: DataFrame) -> DataFrame:
    return part.select(line_key().alias("line_id")).distinct().select("line_id", F.col("line_id").alias("line_name"))


# a station is on a line that it serves so often in the period
BRIDGE_SERVICES = 2


# order lines that one task of the bridge's shuffles holds
BRIDGE_ROWS = 1 << 19


def bridge_from_lineitem(li: DataFrame, part: DataFrame, parts: int) -> DataFrame:
    """``parts``: partitions of every shuffle, which follow the rows (the session's number does not)."""
    # Per (supplier, part) first: a hot part key collapses to one row per
    # supplier before the join, and the join input shrinks to the partsupp size.
    # Parts without a key are on no line, and would all be sent to one task.
    pairs = (li.filter("l_partkey IS NOT NULL").select("l_suppkey", "l_partkey").repartition(parts, "l_suppkey", "l_partkey")
             .groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n")).repartition(parts, "l_partkey"))
    keys = part.select(F.col("p_partkey"), line_key().alias("line_id")).repartition(parts, "p_partkey")
    return (pairs.join(keys, pairs.l_partkey == keys.p_partkey)
            .select(F.col("l_suppkey").alias("station_id"), "line_id", "n").repartition(parts, "station_id", "line_id")
            .groupBy("station_id", "line_id").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= BRIDGE_SERVICES).select("station_id", "line_id"))


def test_star(spark: SparkSession, sf_dir: str, first_year: int | None = None,
              last_year: int | None = None) -> Star:
    li = period_lineitem(spark, sf_dir, first_year, last_year)
    part = table(spark, sf_dir, "part")
    return Star(
        fact=fact_from_lineitem(li),
        dates=dates_from(li),
        stations=stations_from_supplier(table(spark, sf_dir, "supplier")),
        networks=networks_from_nation(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")),
        lines=lines_from_part(part),
        bridge=bridge_from_lineitem(li, part, max(1, table_rows(spark, sf_dir, "lineitem") // BRIDGE_ROWS)),
    )


# Full load / increment split used by the incremental queries.
FULL_LAST_YEAR = 2000
INCREMENT_YEAR = 2001


def full_star(spark: SparkSession, sf_dir: str) -> Star:
    return test_star(spark, sf_dir, last_year=FULL_LAST_YEAR)


def increment_star(spark: SparkSession, sf_dir: str) -> Star:
    return test_star(spark, sf_dir, first_year=INCREMENT_YEAR)


def with_order_dates(star: Star, spark: SparkSession, sf_dir: str) -> Star:
    """The star with the dates of ``orders``: ship dates after the last order have no date row."""
    return replace(star, dates=dates_from(table(spark, sf_dir, "orders"), "o_orderdate"))


def arrival_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic record per ``events`` row, in the envelope a topic source delivers.

      value      JSON arrival: id = "<user_id>-<event_type>" (a prediction id that
                 repeats as it is refreshed), vehicleId = user_id,
                 stationName = " Stop '<first digit of props.k>' ", lineName = event_type,
                 expectedArrival = ts (ISO, UTC), timeToStation = floor(10 * value),
                 event time = the week of ts (so row keys repeat), named arr_timestamp
                 in purchases and timestamp elsewhere; clicks carry their own
                 ingested_at (ts and 90 minutes, in seconds); absent fields are omitted.
                 timeToStation is a fraction in signups and text at stop 7 (wrong types).
                 Rows of type 'error' carry their raw ``props`` text instead (no id), cut
                 short for values below 20 (malformed) and null for those above 200.
      partition  user_id mod 4 (records of one vehicle share a partition)
      offset     event_id (increasing with ts)
      timestamp  ts
    """
    ev = table(spark, sf_dir, "events")
    kind, stop = F.col("event_type"), F.substring(F.get_json_object("props", "$.k"), 1, 1)
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd HH:mm:ss")
    tenths = F.floor(F.col("value") * 10).cast("int")

    def arrival(time_to_station: Column) -> Column:
        return F.to_json(F.struct(
            F.concat_ws("-", F.col("user_id").cast("string"), kind).alias("id"),
            F.col("user_id").cast("string").alias("vehicleId"),
            F.concat(F.lit(" Stop '"), stop, F.lit("' ")).alias("stationName"),
            kind.alias("lineName"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("expectedArrival"),
            time_to_station.alias("timeToStation"),
            F.when(kind != "purchase", week).alias("timestamp"),
            F.when(kind == "purchase", week).alias("arr_timestamp"),
            F.when(kind == "click", F.date_format(F.col("ts") + F.expr("INTERVAL 90 MINUTES"), "yyyy-MM-dd HH:mm:ss"))
            .alias("ingested_at"),
        ))

    text = F.col("props")
    broken = (F.when(F.col("value") < 20, F.expr("substring(props, 1, length(props) - 1)"))
              .when(F.col("value") > 200, F.lit(None)).otherwise(text))
    value = (F.when(kind == "error", broken).when(kind == "signup", arrival(F.col("value") + 0.5))
             .when(stop == "7", arrival(tenths.cast("string"))).otherwise(arrival(tenths)))
    return ev.select(
        value.cast("binary").alias("value"),
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
