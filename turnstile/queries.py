"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus DuckDB oracle SQL.

Every query reads the driver's tables (or frames Spark derives from them)
whole; nothing here runs on made-up input.  Queries that exercise sinks or
streams write under a fresh folder below ``spark.checkpoint.dir`` and return
what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapters, oracle
from .operators import events as ev
from .operators import marts
from .operators.dedup import latest_rows
from .operators import joins
from .plans import backlog, catalog, full_load, periods
from .plans import incremental as inc
from .session import scratch_dir
from .sources import delimited, files, messages
from .streaming import arrivals as stream
from .streaming.keyed import BUCKETS
from .streaming.timed import run_timed

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- marts M1-M7
_MART_QUERY = {
    "mart_entity_totals": "busiest_stations",
    "mart_by_year": "passengers_by_year",
    "mart_by_line_bridge": "passengers_by_line",
    "mart_by_network": "passengers_by_network",
    "mart_bridge_degree": "interchange_stations",
    "mart_by_year_quarter": "quarterly_trend",
    "mart_flag_stats": "night_tube_analysis",
}


def _mart_query(mart_name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return marts.mart(adapters.test_star(spark, sf_dir), mart_name)
    run.__name__ = f"mart_{mart_name}"
    return run


for _q, _m in _MART_QUERY.items():
    register(_q, oracle.mart_sql(_m))(_mart_query(_m))


@register("top10_entities", oracle.mart_sql("busiest_stations")
          + "\nORDER BY total_passengers DESC, station_name LIMIT 10")
def top10_entities(spark, sf_dir):
    """Top-n preview of the busiest-stations mart (limit is the feature)."""
    from .operators.topn import top_n
    star = adapters.test_star(spark, sf_dir)
    m = marts.busiest_stations(marts.station_totals(star.fact), star.stations)
    return top_n(m, 10, F.desc("total_passengers"), F.asc("station_name"))


def _row_counts_sql() -> str:
    parts = [f"SELECT '{m}' AS gold_table, COUNT(*) AS row_count FROM ({oracle.MART_SQL[m]}) t"
             for m in marts.MART_NAMES]
    return f"WITH {oracle.star_cte()}\n" + "\nUNION ALL\n".join(parts)


@register("mart_row_counts", _row_counts_sql())
def mart_row_counts(spark, sf_dir):
    """Row count of every mart, labelled and unioned (one plan, shared exchanges)."""
    built = marts.all_marts(adapters.test_star(spark, sf_dir))
    counted = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("gold_table"), "row_count")
               for name, df in built.items()]
    return reduce(DataFrame.unionByName, counted)


# ---------------------------------------------------------------- arrival feed


def _topic(spark, sf_dir):
    """The topic's messages."""
    return messages.envelope_files(spark, _message_files(spark, sf_dir))


def _parsed(spark, sf_dir):
    return ev.parse_arrivals(_topic(spark, sf_dir))


def _valid(spark, sf_dir):
    return ev.valid_rows(_parsed(spark, sf_dir))


def _deduped(spark, sf_dir):
    return ev.dedup_arrivals(_valid(spark, sf_dir))


_PARSED_OUT = [*ev.PARSED_FIELDS, *ev.META, "arrival_date"]


@register("json_parse_events", oracle.messages_sql(f"SELECT {oracle.PARSED_COLS} FROM parsed"))
def json_parse_events(spark, sf_dir):
    """Binary value -> text -> JSON with the declared schema; envelope kept."""
    return _parsed(spark, sf_dir).select(*_PARSED_OUT)


@register("json_valid_rows", oracle.messages_sql(f"SELECT {oracle.PARSED_COLS} FROM valid"))
def json_valid_rows(spark, sf_dir):
    return _valid(spark, sf_dir).select(*_PARSED_OUT)


@register("json_quarantine", oracle.messages_sql(
    "SELECT kafka_partition, kafka_offset, kafka_ingest_time, reason, raw AS raw_value FROM parsed WHERE bad"))
def json_quarantine(spark, sf_dir):
    return ev.quarantine_rows(_parsed(spark, sf_dir))


@register("dedup_events_by_id", oracle.messages_sql(f"SELECT {oracle.PARSED_COLS} FROM dedup"))
def dedup_events_by_id(spark, sf_dir):
    """Latest message per id by (ingest time, partition, offset)."""
    return _deduped(spark, sf_dir).select(*_PARSED_OUT)


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@register("dedup_lineitem_latest", f"""
SELECT {', '.join(_LI_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(c + ' DESC' for c in _LI_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedup_lineitem_latest(spark, sf_dir):
    """Natural duplicates of (l_orderkey, l_linenumber): keep the latest version."""
    li = adapters.table(spark, sf_dir, "lineitem")
    return latest_rows(li, ["l_orderkey", "l_linenumber"], _LI_ORDER).select(*_LI_COLS)


@register("events_per_line", oracle.messages_sql(
    "SELECT lineName, COUNT(*) AS record_count FROM dedup GROUP BY lineName"))
def events_per_line(spark, sf_dir):
    return (_deduped(spark, sf_dir).groupBy("lineName")
            .agg(F.count(F.lit(1)).alias("record_count"))
            .orderBy(F.desc("record_count"), F.asc_nulls_first("lineName")))


@register("events_per_date", oracle.messages_sql(
    "SELECT arrival_date, COUNT(*) AS record_count FROM dedup GROUP BY arrival_date"))
def events_per_date(spark, sf_dir):
    return (_deduped(spark, sf_dir).groupBy("arrival_date")
            .agg(F.count(F.lit(1)).alias("record_count"))
            .orderBy(F.asc_nulls_first("arrival_date")))


@register("load_reconciliation", oracle.messages_sql("""
SELECT COUNT(*) AS raw_records,
       COUNT(*) FILTER (WHERE NOT bad) AS valid_records,
       COUNT(*) FILTER (WHERE bad) AS quarantined_records,
       COUNT(DISTINCT id) AS deduplicated_records,
       COUNT(*) FILTER (WHERE NOT bad) - COUNT(DISTINCT id) AS duplicate_records
FROM parsed"""))
def load_reconciliation(spark, sf_dir):
    """raw = valid + quarantined; valid = deduplicated + duplicates."""
    from .operators.quality import reconcile
    return reconcile(_parsed(spark, sf_dir))


@register("enrich_delay_level", oracle.messages_sql(
    f"SELECT kafka_partition, kafka_offset, timeToStation, {oracle.DELAY_SQL} AS delayLevel FROM valid"))
def enrich_delay_level(spark, sf_dir):
    from .functions.arrivals import delay_level
    return _valid(spark, sf_dir).select("kafka_partition", "kafka_offset", "timeToStation",
                                        delay_level("timeToStation").alias("delayLevel"))


@register("enrich_peak_hours", oracle.messages_sql(
    f"SELECT kafka_partition, kafka_offset, {oracle.peak_sql('kafka_ingest_time')} AS peakHours FROM valid"))
def enrich_peak_hours(spark, sf_dir):
    from .functions.arrivals import peak_bucket
    return _valid(spark, sf_dir).select("kafka_partition", "kafka_offset",
                                        peak_bucket("kafka_ingest_time").alias("peakHours"))


@register("enrich_minutes", oracle.messages_sql(
    f"SELECT kafka_partition, kafka_offset, {oracle.MINUTES_SQL} AS timeToStationMin FROM valid"))
def enrich_minutes(spark, sf_dir):
    from .functions.arrivals import minutes
    return _valid(spark, sf_dir).select("kafka_partition", "kafka_offset",
                                        minutes("timeToStation").alias("timeToStationMin"))


@register("row_key", oracle.messages_sql(f"SELECT {oracle.ENRICHED_SELECT} FROM valid"))
def keyed_rows(spark, sf_dir):
    """Cleaned cells, defaults and composite row key for every valid message."""
    return ev.enrich(_valid(spark, sf_dir))


@register("row_key_fallback", oracle.messages_sql(
    f"SELECT kafka_partition, kafka_offset, row_key, arr_timestamp FROM (SELECT {oracle.ENRICHED_SELECT} FROM valid)"))
def row_key_fallback(spark, sf_dir):
    """Event time from the message's arr_timestamp, else its timestamp, in cell and key."""
    return ev.enrich(_valid(spark, sf_dir)).select("kafka_partition", "kafka_offset", "row_key", "arr_timestamp")


@register("ingest_default", oracle.messages_sql(
    f"SELECT kafka_partition, kafka_offset, ingestionTime, peakHours FROM (SELECT {oracle.ENRICHED_SELECT} FROM valid)"))
def ingest_default(spark, sf_dir):
    """Ingestion time from the message, else from the envelope."""
    return ev.enrich(_valid(spark, sf_dir)).select("kafka_partition", "kafka_offset", "ingestionTime", "peakHours")


@register("keyed_latest", oracle.messages_sql(oracle.LATEST_PER_KEY))
def keyed_latest(spark, sf_dir):
    """Keyed store contents after all messages: last write wins per row key (K6, V6)."""
    return ev.keyed_latest(ev.enrich(_valid(spark, sf_dir)))


# ---------------------------------------------------------------- incremental load

_STORES: dict[tuple, inc.MartStore] = {}


def loaded_store(spark: SparkSession, sf_dir: str, rerun: bool = False) -> inc.MartStore:
    """A fresh store with the full load (years <= 2000) then the increment applied."""
    key = (id(spark), sf_dir, rerun)
    cached = _STORES.get(key)
    if cached is None or cached.spark is not spark:
        store = inc.MartStore(spark, scratch_dir(spark, "store"))
        store.load(adapters.full_star(spark, sf_dir))
        store.load(adapters.increment_star(spark, sf_dir))
        if rerun:
            store.load(adapters.increment_star(spark, sf_dir))
        _STORES[key] = store
    return _STORES[key]


@register("incoming_years", f"WITH {oracle.star_cte()}\nSELECT DISTINCT d.year FROM fact f JOIN dates d ON f.date_id = d.date_id")
def incoming_years_q(spark, sf_dir):
    return inc.incoming_years(adapters.test_star(spark, sf_dir))


@register("years_to_process", f"""WITH {oracle.star_cte()}
SELECT DISTINCT d.year FROM fact f JOIN dates d ON f.date_id = d.date_id
WHERE d.year NOT IN (SELECT DISTINCT d2.year FROM fact f2 JOIN dates d2 ON f2.date_id = d2.date_id
                     WHERE d2.year <= {adapters.FULL_LAST_YEAR})""")
def years_to_process_q(spark, sf_dir):
    """Ledger written by the full load vs the years of the whole fact -> only new years."""
    ledger = inc.ledger_rows(inc.incoming_years(adapters.full_star(spark, sf_dir)))
    return inc.years_to_process(inc.incoming_years(adapters.test_star(spark, sf_dir)), ledger)


@register("incr_by_year", oracle.period_union_sql("passengers_by_year", ["year"], ["total_passengers"]))
def incr_by_year(spark, sf_dir):
    return loaded_store(spark, sf_dir).mart("passengers_by_year")


@register("incr_by_year_quarter", oracle.period_union_sql(
    "quarterly_trend", ["year", "quarter"], ["total_passengers"]))
def incr_by_year_quarter(spark, sf_dir):
    return loaded_store(spark, sf_dir).mart("quarterly_trend")


@register("incr_entity_totals", oracle.period_union_sql(
    "busiest_stations", ["station_name"], ["total_passengers"]))
def incr_entity_totals(spark, sf_dir):
    return loaded_store(spark, sf_dir).mart("busiest_stations")


_UNDATED: dict[tuple, inc.MartStore] = {}


def _undated_store(spark, sf_dir) -> inc.MartStore:
    """Full load and increment whose dates come from ``orders``: some facts have no date row."""
    key = (id(spark), sf_dir)
    if key not in _UNDATED:
        store = inc.MartStore(spark, scratch_dir(spark, "undated-store"))
        for star in (adapters.full_star(spark, sf_dir), adapters.increment_star(spark, sf_dir)):
            store.load(adapters.with_order_dates(star, spark, sf_dir))
        _UNDATED[key] = store
    return _UNDATED[key]


@register("incr_undated_entity_totals", oracle.mart_sql("busiest_stations"))
def incr_undated_entity_totals(spark, sf_dir):
    """Station totals after two loads count every fact, dated or not."""
    return _undated_store(spark, sf_dir).mart("busiest_stations")


@register("incr_undated_flag_stats", oracle.mart_sql("night_tube_analysis"))
def incr_undated_flag_stats(spark, sf_dir):
    return _undated_store(spark, sf_dir).mart("night_tube_analysis")


class _FailingStore(inc.MartStore):
    """A store whose write of one table fails."""

    failing = ""

    def _write(self, df, path, by=None):
        if self.failing and f"/{self.failing}/" in path:
            raise RuntimeError(f"writing {self.failing} failed")
        super()._write(df, path, by)


def _crash(store: _FailingStore, table: str, load) -> None:
    store.failing = table
    try:
        load()
    except RuntimeError as e:
        if "failed" not in str(e):
            raise
    else:
        raise AssertionError("the load did not fail")
    finally:
        store.failing = ""


@register("undated_crash_retry", oracle.mart_sql("busiest_stations"))
def undated_crash_retry(spark, sf_dir):
    """An increment with undated facts fails while it writes the marts; the retry loads all of it."""
    store = _FailingStore(spark, scratch_dir(spark, "crash-store"))
    store.load(adapters.with_order_dates(adapters.full_star(spark, sf_dir), spark, sf_dir))
    later = adapters.with_order_dates(adapters.increment_star(spark, sf_dir), spark, sf_dir)
    _crash(store, "busiest_stations", lambda: store.load(later))
    store.load(later)
    return store.mart("busiest_stations")


@register("full_reload_crash_keeps_old", oracle.mart_sql("busiest_stations", **oracle.FULL))
def full_reload_crash_keeps_old(spark, sf_dir):
    """A full load that fails leaves the marts of the one before (K1)."""
    store = _FailingStore(spark, scratch_dir(spark, "reload-crash"))
    store.replace(adapters.full_star(spark, sf_dir))
    _crash(store, "night_tube_analysis", lambda: store.replace(adapters.test_star(spark, sf_dir)))
    return store.mart("busiest_stations")


@register("incr_pruned_gate", oracle.mart_sql("busiest_stations"))
def incr_pruned_gate(spark, sf_dir):
    """The increment reads a fact of all years, stored by year: only open years' files are read."""
    root = scratch_dir(spark, "periods")
    star = adapters.test_star(spark, sf_dir)
    periods.write_by_period(star, f"{root}/fact")
    store = inc.MartStore(spark, f"{root}/store")
    store.load(adapters.full_star(spark, sf_dir))
    store.load(star.with_fact(periods.read_by_period(spark, f"{root}/fact")))
    return store.mart("busiest_stations")


@register("semi_join_reduced", f"""
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '{adapters.INCREMENT_YEAR}-01-01')""")
def semi_join_reduced(spark, sf_dir):
    """Facts of a key set taken as too large to broadcast: a Bloom filter of the keys goes before the shuffle."""
    orders = adapters.table(spark, sf_dir, "orders").filter(
        F.col("o_orderdate") >= F.lit(f"{adapters.INCREMENT_YEAR}-01-01").cast("timestamp_ntz"))
    facts = adapters.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return joins.join_bounded(facts, orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi", max_rows=0)


_CORRECTED = f"""
corrected AS (
  SELECT entry_exit_id, station_id, date_id, total_entry_exit + CASE WHEN entry_exit_id % 7 = 0 THEN 5 ELSE 0 END AS total_entry_exit
  FROM fact WHERE entry_exit_id % 11 <> 0)"""


@register("incr_corrected_facts", f"""WITH {oracle.star_cte()},{_CORRECTED},
inc_bridge AS (
  SELECT l_suppkey AS station_id, {oracle.LINE} AS line_id FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE l_shipdate >= TIMESTAMP '{adapters.INCREMENT_YEAR}-01-01 00:00:00'
  GROUP BY ALL HAVING count(*) >= {adapters.BRIDGE_SERVICES})
SELECT 'busiest_stations' AS gold_table, station_name AS label, CAST(sum(total_entry_exit) AS BIGINT) AS total_passengers
FROM corrected JOIN stations USING (station_id) GROUP BY ALL
UNION ALL SELECT 'passengers_by_year', CAST(year AS VARCHAR), CAST(sum(total_entry_exit) AS BIGINT)
FROM corrected JOIN dates USING (date_id) GROUP BY ALL
UNION ALL SELECT 'passengers_by_line', line_name, CAST(sum(total_entry_exit) AS BIGINT)
FROM corrected JOIN inc_bridge USING (station_id) JOIN lines USING (line_id) GROUP BY ALL""")
def incr_corrected_facts(spark, sf_dir):
    """Facts corrected and withdrawn after their years were loaded, and a new bridge for all of them, as signed
    deltas: the marts of a recomputation, without a year loaded again (I5, A7)."""
    star = adapters.test_star(spark, sf_dir)
    store = inc.MartStore(spark, scratch_dir(spark, "corrected"))
    store.load(star)
    gone = F.col("entry_exit_id") % 11 == 0
    changed = (F.col("entry_exit_id") % 7 == 0) & ~gone
    old = star.fact.filter(gone | changed).withColumn("sign", F.lit(-1))
    new = star.fact.filter(changed).withColumns({"total_entry_exit": F.col("total_entry_exit") + 5, "sign": F.lit(1)})
    store.correct(star.with_fact(old.unionByName(new)))
    later = adapters.increment_star(spark, sf_dir)
    store.rebridge(later)
    keys = {"busiest_stations": "station_name", "passengers_by_year": "year", "passengers_by_line": "line_name"}
    parts = [store.mart(m).select(F.lit(m).alias("gold_table"), F.col(k).cast("string").alias("label"), "total_passengers")
             for m, k in keys.items()]
    return reduce(DataFrame.unionByName, parts).filter("NOT (gold_table = 'passengers_by_line' AND total_passengers = 0)")


@register("full_reload_replaces", oracle.mart_sql("busiest_stations", **oracle.FULL))
def full_reload_replaces(spark, sf_dir):
    """A full load over a store that held more years leaves only its own rows (K1)."""
    store = inc.MartStore(spark, scratch_dir(spark, "reload-store"))
    store.replace(adapters.test_star(spark, sf_dir))
    store.replace(adapters.full_star(spark, sf_dir))
    return store.mart("busiest_stations")


@register("incr_by_line", oracle.period_union_sql("passengers_by_line", ["line_name"], ["total_passengers"]))
def incr_by_line(spark, sf_dir):
    """As loaded: each period's totals go through that period's station-line bridge."""
    return loaded_store(spark, sf_dir).mart("passengers_by_line")


@register("incr_by_network", oracle.period_union_sql(
    "passengers_by_network", ["network_name", "network_type"], ["total_passengers"]))
def incr_by_network(spark, sf_dir):
    return loaded_store(spark, sf_dir).mart("passengers_by_network")


@register("incr_flag_stats_weighted", oracle.mart_sql(
    "night_tube_analysis"))
def incr_flag_stats_weighted(spark, sf_dir):
    """Merged night-service mart with the exact (count-weighted) average."""
    return loaded_store(spark, sf_dir).mart("night_tube_analysis")


@register("incr_flag_stats_mean_of_means", f"""
SELECT has_night_tube, CAST(SUM(num_records) AS BIGINT) AS num_records,
       CAST(SUM(total_passengers) AS BIGINT) AS total_passengers,
       AVG(avg_passengers_per_record) AS avg_passengers_per_record
FROM (({oracle.mart_sql('night_tube_analysis', **oracle.FULL)})
      UNION ALL ({oracle.mart_sql('night_tube_analysis', **oracle.INC)})) u
GROUP BY has_night_tube""")
def incr_flag_stats_mean_of_means(spark, sf_dir):
    """Compatibility merge: old mart + increment mart, average = mean of the two averages."""
    def night(star):
        return marts.night_tube_analysis(marts.station_totals(star.fact), star.stations)
    return marts.merge_mean_of_means(night(adapters.full_star(spark, sf_dir)),
                                     night(adapters.increment_star(spark, sf_dir)))


@register("incr_bridge_degree_replace", f"""
WITH full_m AS ({oracle.mart_sql('interchange_stations', **oracle.FULL)}),
     inc_m AS ({oracle.mart_sql('interchange_stations', **oracle.INC)})
SELECT station_name, num_lines FROM full_m
WHERE station_name NOT IN (SELECT station_name FROM inc_m)
UNION ALL SELECT station_name, num_lines FROM inc_m""")
def incr_bridge_degree_replace(spark, sf_dir):
    """Stations present in the increment's bridge take its line count; others keep theirs."""
    return loaded_store(spark, sf_dir).mart("interchange_stations")


@register("incr_rerun_is_noop", oracle.period_union_sql(
    "busiest_stations", ["station_name"], ["total_passengers"]))
def incr_rerun_is_noop(spark, sf_dir):
    """Same increment loaded twice: the ledger gate makes the second run change nothing."""
    return loaded_store(spark, sf_dir, rerun=True).mart("busiest_stations")


@register("extract_year_slice", f"""WITH {oracle.star_cte()}
SELECT f.entry_exit_id, f.station_id, f.date_id, f.total_entry_exit
FROM fact f JOIN dates d ON f.date_id = d.date_id WHERE d.year = {adapters.INCREMENT_YEAR}""")
def extract_year_slice(spark, sf_dir):
    """Source-side projection + join + year predicate, as an extract query would push it."""
    from .sources.jdbc import year_slice
    return year_slice(adapters.test_star(spark, sf_dir), adapters.INCREMENT_YEAR)


# ---------------------------------------------------------------- sources, sinks, catalog

_STATIONS_SQL = ("SELECT s_suppkey AS station_id, s_name AS station_name, "
                 "s_nationkey AS network_id, s_acctbal > 0 AS has_night_tube FROM supplier")


def _db_name(prefix: str) -> str:
    import uuid
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@register("csv_null_token_roundtrip", _STATIONS_SQL)
def csv_null_token_roundtrip(spark, sf_dir):
    """Stations written as header-less text with the ``null`` token, read back through an
    external delimited table with the declared schema (S1, S2, K5, C2)."""
    st = adapters.stations_from_supplier(adapters.table(spark, sf_dir, "supplier"))
    path = scratch_dir(spark, "csv") + "/dim_stations"
    delimited.write_delimited(st, path, "extract")
    db = _db_name("csvdb")
    catalog.create_database(spark, db, use=False)
    catalog.register_delimited(spark, f"{db}.dim_stations", st.schema, path, "extract")
    read = spark.table(f"{db}.dim_stations")
    catalog.drop_database(spark, db)  # the frame is resolved; the files stay
    return read


def _inferred_sql() -> str:
    columns = {"fact": {"entry_exit_id": "number", "station_id": "number", "date_id": "number", "total_entry_exit": "number"},
               "dates": {"date_id": "number", "year": "number", "quarter": "number"},
               "stations": {"station_id": "number", "station_name": "string", "network_id": "number", "has_night_tube": "boolean"},
               "networks": {"network_id": "number", "network_name": "string", "network_type": "string"},
               "lines": {"line_id": "string", "line_name": "string"}, "bridge": {"station_id": "number", "line_id": "string"}}
    # a period's last month has no quarter yet
    number = "CASE WHEN max({c}) > 2147483647 THEN 'bigint' ELSE 'int' END"
    parts = [f"SELECT '{t}' AS table_name, '{c}' AS column_name, {number.format(c=c) if k == 'number' else repr(k)} AS type, "
             f"count(*) - count({c}) AS nulls FROM {t if t != 'dates' else 'open_dates'}"
             for t, cs in columns.items() for c, k in cs.items()]
    return (f"WITH {oracle.star_cte()},\nopen_dates AS (SELECT date_id, year, "
            "CASE WHEN date_id // 100 % 100 < 12 THEN quarter END AS quarter FROM dates)\n" + "\nUNION ALL\n".join(parts))


@register("infer_star_types", _inferred_sql())
def infer_star_types(spark, sf_dir):
    """The star written as header-less text with the null token, read back with inferred types: each column's type
    and nulls, a nullable integer (quarter) included (S1, P8)."""
    star = adapters.test_star(spark, sf_dir)
    root, out = scratch_dir(spark, "inferred"), []
    months = F.floor(F.col("date_id") / 100) % 100
    tables = {"fact": star.fact, "stations": star.stations, "networks": star.networks, "lines": star.lines,
              "bridge": star.bridge, "dates": star.dates.select("date_id", "year", F.when(months < 12, F.col("quarter")).alias("quarter"))}
    for name, df in tables.items():
        delimited.write_delimited(df, f"{root}/{name}", "extract")
        read = delimited.read_inferred(spark, f"{root}/{name}", df.columns)
        nulls = read.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        out.append(nulls.select(F.explode(F.array(*[F.struct(
            F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f.name).alias("nulls")) for f in read.schema.fields])).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, out)


@register("csv_rejects", """
WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_suppkey % 10 AS k, s_name, CAST(s_nationkey AS VARCHAR) AS net,
                  CASE WHEN s_acctbal > 0 THEN 'true' ELSE 'false' END AS flag FROM supplier)
SELECT id || ',' || s_name || ',n/a,' || flag AS row_text, 'network_id' AS column_name, 'n/a' AS value,
       'not of type int' AS reason FROM s WHERE k = 3
UNION ALL SELECT id || ',' || s_name || ',' || net || ',maybe', 'has_night_tube', 'maybe', 'not of type boolean' FROM s WHERE k = 7
UNION ALL SELECT id || ',' || s_name || ',' || net || ',' || flag || ',x', NULL, NULL, 'wrong number of fields' FROM s WHERE k = 9""")
def csv_rejects(spark, sf_dir):
    """Text in which some lines do not fit: every bad cell with its column and reason; the good rows load."""
    st = adapters.stations_from_supplier(adapters.table(spark, sf_dir, "supplier"))
    k, path = F.col("station_id") % 10, scratch_dir(spark, "rejects")
    cells = [F.col("station_id").cast("string"), F.col("station_name"),
             F.when(k == 3, F.lit("n/a")).otherwise(F.col("network_id").cast("string")),
             F.when(k == 7, F.lit("maybe")).otherwise(F.col("has_night_tube").cast("string")), F.when(k == 9, F.lit("x"))]
    st.select(F.concat_ws(",", *cells)).write.text(path)
    schema = "station_id int, station_name string, network_id int, has_night_tube boolean"
    good, rejects = delimited.read_with_rejects(spark, path, spark.createDataFrame([], schema).schema)
    good.write.parquet(f"{path}-good")
    return rejects


@register("partitioned_events_pruned", oracle.messages_sql(
    "SELECT lineName, arrival_date, COUNT(*) AS record_count FROM dedup GROUP BY lineName, arrival_date"))
def partitioned_events_pruned(spark, sf_dir):
    """Backlog load written by (lineName, arrival_date), exposed as a partitioned external
    table after partition discovery, counted per partition (K2, C5, V2)."""
    root = scratch_dir(spark, "backlog")
    backlog.load_backlog(_topic(spark, sf_dir), f"{root}/arrivals",
                         quarantine_out=f"{root}/quarantine")
    db = _db_name("feed")
    catalog.create_database(spark, db, use=False)
    catalog.register_parquet(spark, f"{db}.arrivals", f"{root}/arrivals",
                             partitioned_by=backlog.PARTITION_KEYS)
    counted = spark.sql(f"SELECT lineName, arrival_date, COUNT(*) AS record_count "
                        f"FROM {db}.arrivals GROUP BY lineName, arrival_date")
    # the partitions are listed in the catalog when the query runs: it runs before the database goes
    counted.write.parquet(f"{root}/counted")
    catalog.drop_database(spark, db)
    return spark.read.schema(counted.schema).parquet(f"{root}/counted")


@register("backlog_reconciliation", oracle.messages_sql("""
SELECT COUNT(*) AS raw_records, COUNT(*) FILTER (WHERE NOT bad) AS valid_records,
       COUNT(*) FILTER (WHERE bad) AS quarantined_records, COUNT(DISTINCT id) AS deduplicated_records,
       COUNT(DISTINCT id) AS table_rows, COUNT(*) FILTER (WHERE bad) AS quarantine_rows FROM parsed"""))
def backlog_reconciliation(spark, sf_dir):
    """The backlog load's own counts beside the rows of its table and of its quarantine (V1, K2)."""
    root = scratch_dir(spark, "backlog")
    n = backlog.load_backlog(_topic(spark, sf_dir), f"{root}/arrivals", f"{root}/quarantine")
    counted = {"raw_records": n.raw, "valid_records": n.valid, "quarantined_records": n.quarantined,
               "deduplicated_records": n.deduplicated}
    table = spark.read.parquet(f"{root}/arrivals").agg(F.count(F.lit(1)).alias("table_rows"))
    held = spark.read.parquet(f"{root}/quarantine").agg(F.count(F.lit(1)).alias("quarantine_rows"))
    both = table.select("table_rows", F.lit(0).alias("quarantine_rows")).unionByName(
        held.select(F.lit(0).alias("table_rows"), "quarantine_rows"))
    return both.agg(*[F.lit(v).cast("long").alias(k) for k, v in counted.items()],
                    F.sum("table_rows").alias("table_rows"), F.sum("quarantine_rows").alias("quarantine_rows"))


@register("scan_with_fallback", f"SELECT DISTINCT {oracle.LINE} AS line_id, {oracle.LINE} AS line_name FROM part")
def scan_with_fallback(spark, sf_dir):
    """Increment folder absent -> the full-load folder is read."""
    root = scratch_dir(spark, "fallback")
    adapters.lines_from_part(adapters.table(spark, sf_dir, "part")) \
        .write.mode("overwrite").parquet(f"{root}/full/dim_lines")
    _, df = files.read_first(spark, [f"{root}/incremental/dim_lines", f"{root}/full/dim_lines"],
                             spark.read.parquet)
    return df


def _catalog_counts_sql() -> str:
    parts = [f"SELECT '{m}' AS gold_table, COUNT(*) AS row_count FROM ({oracle.MART_SQL[m]}) t"
             for m in marts.MART_NAMES]
    parts.append("SELECT 'incremental_watermark' AS gold_table, COUNT(DISTINCT d.year) AS row_count "
                 "FROM fact f JOIN dates d ON f.date_id = d.date_id")
    return f"WITH {oracle.star_cte()}\n" + "\nUNION ALL\n".join(parts)


@register("catalog_marts_roundtrip", _catalog_counts_sql())
def catalog_marts_roundtrip(spark, sf_dir):
    """Marts written as Parquet, registered as external tables in a database, the
    ledger created and appended positionally, then counted through the catalog
    (S11, K1, K3, C1, C3, C4, C6)."""
    star = adapters.test_star(spark, sf_dir)
    root = scratch_dir(spark, "catalog")
    paths = full_load.write_marts(star, f"{root}/gold")
    db = _db_name("gold")
    catalog.create_database(spark, db, use=False)
    for name, path in paths.items():
        catalog.register_parquet(spark, f"{db}.{name}", path)
    catalog.ensure_ledger_table(spark, f"{db}.incremental_watermark", f"{root}/ledger")
    catalog.append_into(inc.ledger_rows(inc.incoming_years(star)), f"{db}.incremental_watermark")
    tables = [*marts.MART_NAMES, "incremental_watermark"]
    counted = reduce(DataFrame.unionByName, [
        catalog.table_count(spark, f"{db}.{t}")
        .select(F.lit(t).alias("gold_table"), F.col("total_records").alias("row_count"))
        for t in tables])
    catalog.drop_database(spark, db)
    return counted


@register("full_load_totals", f"""WITH {oracle.star_cte()}
SELECT 'busiest_stations' AS gold_table, CAST(SUM(total_entry_exit) AS BIGINT) AS grand_total
FROM fact f JOIN stations s ON f.station_id = s.station_id
UNION ALL SELECT 'passengers_by_year', CAST(SUM(total_entry_exit) AS BIGINT)
FROM fact f JOIN dates d ON f.date_id = d.date_id
UNION ALL SELECT 'night_tube_analysis', CAST(SUM(total_entry_exit) AS BIGINT)
FROM fact f JOIN stations s ON f.station_id = s.station_id""")
def full_load_totals(spark, sf_dir):
    """Full batch with shared, checkpointed aggregates; grand totals of the written marts."""
    paths = full_load.write_marts(adapters.test_star(spark, sf_dir))
    return full_load.total_check(full_load.read_marts(spark, paths))


_MSG_FILES: dict[tuple, str] = {}


def _message_files(spark, sf_dir) -> str:
    """The arrival topic written once as Parquet files in the envelope, by topic partition (no shuffle)."""
    key = (id(spark), sf_dir)
    if key not in _MSG_FILES:
        path = scratch_dir(spark, "topic")
        adapters.arrival_messages(spark, sf_dir).write.partitionBy("partition").parquet(path)
        _MSG_FILES[key] = path
    return _MSG_FILES[key]


#: micro-batches that a topic is read in, about: a batch's fixed cost and the buckets that it rewrites do not grow
#: in number with the topic, and its files go to all cores
TOPIC_BATCHES = 4
#: bytes of the topic that one micro-batch reads at least
TOPIC_BYTES = 256 << 10
#: bytes of the topic for one bucket of a store (a bucket is merged by one task)
BUCKET_BYTES = 8 << 20


def _topic_stream(spark, path) -> DataFrame:
    """A topic folder as a stream of several micro-batches (a file at least)."""
    size = max(TOPIC_BYTES, files.bytes_of(spark, path) // TOPIC_BATCHES)
    return messages.envelope_files(spark, path, streaming=True, max_bytes_per_trigger=size)


def _buckets(spark, path) -> int:
    """Buckets of a store that holds the rows of a topic folder."""
    return max(BUCKETS, files.bytes_of(spark, path) // BUCKET_BYTES)


def _appended(spark, sf_dir) -> str:
    root = scratch_dir(spark, "stream-append")
    q = stream.start_append(_topic_stream(spark, _message_files(spark, sf_dir)), f"{root}/out", f"{root}/checkpoint",
                            trigger={"availableNow": True})
    stream.run_for(q, None)
    return f"{root}/out"


@register("stream_append_events", oracle.messages_sql(f"SELECT {oracle.PARSED_COLS} FROM parsed"))
def stream_append_events(spark, sf_dir):
    """Topic -> parse -> stamped Parquet append with a checkpoint, in micro-batches;
    the output read back equals the batch parse (S7, T1-T5, K4, V5)."""
    return spark.read.parquet(_appended(spark, sf_dir)).select(*_PARSED_OUT)


@register("stream_append_quarantine", oracle.messages_sql(
    "SELECT kafka_partition, kafka_offset, kafka_ingest_time, reason, raw AS raw_value FROM parsed WHERE bad"))
def stream_append_quarantine(spark, sf_dir):
    """Every message the append stream rejected, with its reason and raw text."""
    return stream.rejected(spark.read.parquet(_appended(spark, sf_dir)))


@register("stream_output_table_count", "SELECT COUNT(*) AS total_records FROM events")
def stream_output_table_count(spark, sf_dir):
    """An external table over the append stream's output, counted through the catalog."""
    db = _db_name("appended")
    catalog.create_database(spark, db, use=False)
    catalog.register_parquet(spark, f"{db}.arrivals", _appended(spark, sf_dir))
    counted = catalog.table_count(spark, f"{db}.arrivals")
    catalog.drop_database(spark, db)
    return counted


@register("publish_json_roundtrip", oracle.messages_sql(
    "SELECT id AS message_key, id, vehicleId, stationName, lineName, expectedArrival, timeToStation, arr_timestamp FROM valid"))
def publish_json_roundtrip(spark, sf_dir):
    """Rows published as keyed JSON messages (null fields omitted), read back and parsed."""
    rows = _valid(spark, sf_dir).select("id", "vehicleId", "stationName", "lineName", "expectedArrival",
                                        "timeToStation", "arr_timestamp")
    path = scratch_dir(spark, "published")
    messages.as_json_messages(rows, key="id").write.parquet(path)
    return (spark.read.parquet(path)
            .select(F.col("key").cast("string").alias("message_key"),
                    F.from_json(F.col("value").cast("string"), rows.schema).alias("d"))
            .select("message_key", "d.*"))


_KEYED: dict[tuple, str] = {}


def _upsert(spark, topic: str, root: str, buckets: int | None = None) -> None:
    q = stream.start_keyed_upsert(_topic_stream(spark, topic), f"{root}/store", f"{root}/checkpoint",
                                  trigger={"availableNow": True}, buckets=buckets or _buckets(spark, topic))
    stream.run_for(q, None)


def _keyed_store(spark, sf_dir) -> str:
    """The keyed store after the whole topic, built once."""
    key = (id(spark), sf_dir)
    if key not in _KEYED:
        root = scratch_dir(spark, "stream-upsert")
        _upsert(spark, _message_files(spark, sf_dir), root)
        _KEYED[key] = f"{root}/store"
    return _KEYED[key]


@register("stream_keyed_upsert", oracle.messages_sql(oracle.LATEST_PER_KEY))
def stream_keyed_upsert(spark, sf_dir):
    """Topic -> per-batch enrich + merge of the buckets that a batch touches; the rows read
    back equal the batch keyed store (S12, T6, T7, K6)."""
    return stream.current_rows(spark, _keyed_store(spark, sf_dir))


@register("stream_keyed_restart", oracle.messages_sql(oracle.LATEST_PER_KEY))
def stream_keyed_restart(spark, sf_dir):
    """One store fed by two queries: the first half of the topic, then the other half by a query whose
    checkpoint (same path) was lost.  No key of the first is lost (K6, T7)."""
    root = scratch_dir(spark, "stream-restart")
    sent, buckets = _topic(spark, sf_dir), _buckets(spark, _message_files(spark, sf_dir))
    for name, part in (("first", sent.filter("partition < 2")), ("second", sent.filter("partition >= 2"))):
        part.write.partitionBy("partition").parquet(f"{root}/{name}")
        _upsert(spark, f"{root}/{name}", root, buckets)
        if name == "first":
            files.delete_path(spark, f"{root}/checkpoint")
    return stream.current_rows(spark, f"{root}/store")


@register("topic_message_count", "SELECT COUNT(*) AS total_records FROM events")
def topic_message_count(spark, sf_dir):
    """Messages on the topic (V5): a count over the bounded envelope scan."""
    return _topic(spark, sf_dir).agg(F.count(F.lit(1)).alias("total_records"))


@register("keyed_store_count", oracle.messages_sql(f"""
SELECT COUNT(DISTINCT row_key) AS total_records FROM (SELECT {oracle.ENRICHED_SELECT} FROM valid)"""))
def keyed_store_count(spark, sf_dir):
    """Rows in the keyed store after all messages (V6)."""
    store = stream.current_rows(spark, _keyed_store(spark, sf_dir))
    return store.agg(F.count(F.lit(1)).alias("total_records"))


@register("keyed_store_preview", oracle.messages_sql(oracle.LATEST_PER_KEY + "\nORDER BY row_key LIMIT 5"))
def keyed_store_preview(spark, sf_dir):
    """First five rows of the keyed store by row key (V7, K8)."""
    from .operators.topn import preview
    return preview(stream.current_rows(spark, _keyed_store(spark, sf_dir)), 5, "row_key")


@register("stream_dedup_ids", oracle.messages_sql("SELECT DISTINCT id FROM valid"))
def stream_dedup_ids(spark, sf_dir):
    """Streaming dedup with bounded state (the horizon is the feed's month): every valid id comes out exactly
    once across micro-batches.  The surviving row is the first seen, so only the ids are compared."""
    parsed = ev.parse_arrivals(_topic_stream(spark, _message_files(spark, sf_dir))).filter(ev.is_valid()).drop("raw_value", ev.CORRUPT_COLUMN)
    root = scratch_dir(spark, "stream-dedup")
    q = (stream.dedup_within(parsed, "31 days").writeStream.format("parquet")
         .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).start())
    stream.run_for(q, None)
    return spark.read.parquet(f"{root}/out").select("id")


@register("stream_dedup_latest", oracle.messages_sql(f"SELECT {oracle.PARSED_COLS} FROM dedup"))
def stream_dedup_latest(spark, sf_dir):
    """Latest message per id from the stream, whole rows: a windowed aggregate in update mode whose updates
    are merged into a keyed store (D1, T7)."""
    root = scratch_dir(spark, "stream-latest")
    topic = _message_files(spark, sf_dir)
    q = stream.start_dedup_latest(_topic_stream(spark, topic), f"{root}/store", f"{root}/checkpoint",
                                  "31 days", {"availableNow": True}, _buckets(spark, topic))
    stream.run_for(q, None)
    return stream.latest_store(spark, f"{root}/store").rows().select(*_PARSED_OUT)


@register("stream_timed_run", "SELECT COUNT(*) AS total_records FROM events")
def stream_timed_run(spark, sf_dir):
    """The append stream on a one-second trigger, stopped between batches once it is idle: the messages that
    the listener saw are the topic's (T1, T3, V5)."""
    root = scratch_dir(spark, "stream-timed")
    run = run_timed(spark, lambda: stream.start_append(
        _topic_stream(spark, _message_files(spark, sf_dir)), f"{root}/out", f"{root}/checkpoint",
        {"processingTime": "1 second"}), seconds=600, idle_seconds=2.5)
    return spark.createDataFrame([(run.rows,)], "total_records bigint")


_STAR_ATTR = {"fact_passenger_entry_exit": "fact", "dim_date": "dates", "dim_stations": "stations",
              "dim_networks": "networks", "dim_lines": "lines", "fact_station_lines": "bridge"}


@register("increment_job_from_text", oracle.period_union_sql(
    "busiest_stations", ["station_name"], ["total_passengers"]))
def increment_job_from_text(spark, sf_dir):
    """The text-folder jobs end to end: the full-load star (every table) and the 2001
    facts and dates written as header-less extracts with the null token; the full
    job, then the increment job reading the other tables from the full-load folder
    by fallback (S1, S3, S4, I8, E2)."""
    from .plans import jobs
    root = scratch_dir(spark, "text-jobs")
    full, incr = adapters.full_star(spark, sf_dir), adapters.increment_star(spark, sf_dir)
    schemas = {}
    for table, attr in _STAR_ATTR.items():
        df = getattr(full, attr)
        schemas[table] = df.schema
        delimited.write_delimited(df, f"{root}/full/{table}", "extract")
    # the increment extract carries its facts and its dates; every other table
    # falls back to the full-load folder
    delimited.write_delimited(incr.fact, f"{root}/inc/fact_passenger_entry_exit", "extract")
    delimited.write_delimited(incr.dates, f"{root}/inc/dim_date", "extract")
    jobs.run_full(spark, f"{root}/full", f"{root}/store", schemas=schemas)
    jobs.run_increment(spark, f"{root}/inc", f"{root}/full", f"{root}/store", schemas=schemas)
    return inc.MartStore(spark, f"{root}/store").mart("busiest_stations")


#: queries that read the topic, which is written once before them
FEED = {name for name, sql in ORACLE.items() if oracle.MESSAGES_CTE in sql} | {
    "stream_output_table_count", "stream_timed_run", "topic_message_count"}
