"""The seven aggregate marts as pure DataFrame functions.

Plan shape (the reason these are not one SQL text per mart):

* The fact is aggregated once per station (``station_totals``) and once per
  date (``date_totals``) before any join.  The partial aggregate runs
  map-side, so a station or date holding a third of all rows still sends one
  row per map task to the shuffle.  Every join afterwards sees at most one
  row per station or date on the fact side.
* ``passengers_by_line`` is the eager-aggregation rewrite of
  fact JOIN bridge JOIN lines: the fan-out through the many-to-many bridge is
  stations x lines instead of facts x lines.  Catalyst does not do this rewrite.
* ``passengers_by_network`` and ``interchange_stations`` likewise aggregate to
  the join key before joining the outer dimension.
* No dimension is force-broadcast: dimensions can grow with the data
  (a station table at cluster scale is not small).  AQE turns a join into a
  broadcast join only when the measured shuffle output of a side is below
  ``spark.sql.adaptive.autoBroadcastJoinThreshold``.

Semantics kept from the marts' definitions: inner joins; grouping by station
*name*; the bridge counts a station's total once per line; COUNT of lines is
not distinct; the null quarter is its own group; the night-service count is
COUNT(entry_exit_id) and the average skips null measures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..star import Star

MEASURE = "total_entry_exit"


def _keys(by, *rest):
    return [*by, *rest]


def _totals(fact: DataFrame, key: str, by=()) -> DataFrame:
    return fact.groupBy(*_keys(by, key)).agg(
        F.sum(MEASURE).alias("total_passengers"),
        F.count("entry_exit_id").alias("num_records"),
        F.count(MEASURE).alias("num_measured"),
    )


def station_totals(fact: DataFrame, by=()) -> DataFrame:
    """(by..., station_id, total_passengers, num_records, num_measured)."""
    return _totals(fact, "station_id", by)


def date_totals(fact: DataFrame, by=()) -> DataFrame:
    """(by..., date_id, total_passengers, num_records, num_measured)."""
    return _totals(fact, "date_id", by)


def station_and_date_totals(fact: DataFrame) -> DataFrame:
    """Both pre-aggregates from one scan of the fact (GROUPING SETS (station_id), (date_id)).

    Rows carry ``grain`` = 'station' or 'date'; split them with ``split_totals``.
    The fact is read once, expanded to two rows per fact row inside the
    task, and partially aggregated before the single shuffle.
    """
    return (fact.groupingSets([["station_id"], ["date_id"]], "station_id", "date_id")
            .agg(F.sum(MEASURE).alias("total_passengers"),
                 F.count("entry_exit_id").alias("num_records"),
                 F.count(MEASURE).alias("num_measured"),
                 F.grouping_id().alias("_gid"))
            .select(F.when(F.col("_gid") == 1, F.lit("station")).otherwise(F.lit("date")).alias("grain"),
                    "station_id", "date_id", "total_passengers", "num_records", "num_measured"))


def split_totals(both: DataFrame) -> tuple[DataFrame, DataFrame]:
    cols = ["total_passengers", "num_records", "num_measured"]
    st = both.filter(F.col("grain") == "station").select("station_id", *cols)
    dt = both.filter(F.col("grain") == "date").select("date_id", *cols)
    return st, dt


def _sum(col: str = "total_passengers", alias: str = "total_passengers"):
    return F.sum(col).alias(alias)


# ``by`` carries extra grouping columns through a mart (e.g. the load year of
# an incremental partial); the plain marts use none.

# --- M1 -------------------------------------------------------------------
def busiest_stations(st: DataFrame, stations: DataFrame, by=()) -> DataFrame:
    return (st.select(*by, "station_id", "total_passengers")
            .join(stations.select("station_id", "station_name"), "station_id")
            .groupBy(*_keys(by, "station_name")).agg(_sum()))


# --- M2 / M6 ------------------------------------------------------------------
def _period(dt: DataFrame, dates: DataFrame, keys: list[str], by=(),
            annual: bool | None = None) -> DataFrame:
    # annual=None keeps annual and sub-annual rows together (the marts' definition);
    # True / False restricts the dates to one granularity via is_annual
    if annual is not None:
        dates = dates.filter(F.col("is_annual") == F.lit(annual))
    d = dates.select("date_id", *[F.col(k).cast("int").alias(k) for k in keys])
    return (dt.select(*by, "date_id", "total_passengers").join(d, "date_id")
            .groupBy(*_keys(by, *keys)).agg(_sum()))


def passengers_by_year(dt: DataFrame, dates: DataFrame, by=(), annual: bool | None = None) -> DataFrame:
    return _period(dt, dates, ["year"], by, annual)


def quarterly_trend(dt: DataFrame, dates: DataFrame, by=(), annual: bool | None = None) -> DataFrame:
    return _period(dt, dates, ["year", "quarter"], by, annual)


# --- M3 -------------------------------------------------------------------
def passengers_by_line(st: DataFrame, bridge: DataFrame, lines: DataFrame, by=()) -> DataFrame:
    per_line = (st.select(*by, "station_id", "total_passengers")
                .join(bridge.select("station_id", "line_id"), "station_id")
                .groupBy(*_keys(by, "line_id")).agg(_sum()))
    return (per_line.join(lines.select("line_id", "line_name"), "line_id")
            .groupBy(*_keys(by, "line_name")).agg(_sum()))


# --- M4 -------------------------------------------------------------------
def passengers_by_network(st: DataFrame, stations: DataFrame, networks: DataFrame,
                          by=()) -> DataFrame:
    per_network = (st.select(*by, "station_id", "total_passengers")
                   .join(stations.select("station_id", "network_id"), "station_id")
                   .groupBy(*_keys(by, "network_id")).agg(_sum()))
    return (per_network
            .join(networks.select("network_id", "network_name", "network_type"), "network_id")
            .groupBy(*_keys(by, "network_name", "network_type")).agg(_sum()))


# --- M5 -------------------------------------------------------------------
def interchange_stations(bridge: DataFrame, stations: DataFrame) -> DataFrame:
    per_station = bridge.groupBy("station_id").agg(F.count("line_id").alias("num_lines"))
    return (per_station.join(stations.select("station_id", "station_name"), "station_id")
            .groupBy("station_name").agg(F.sum("num_lines").alias("num_lines")))


# --- M7 -------------------------------------------------------------------
def flag_partials(st: DataFrame, stations: DataFrame, flag: str = "has_night_tube",
                  by=()) -> DataFrame:
    """(by..., flag, num_records, total_passengers, num_measured): additive, mergeable."""
    return (st.join(stations.select("station_id", flag), "station_id")
            .groupBy(*_keys(by, flag)).agg(F.sum("num_records").alias("num_records"),
                                           _sum(),
                                           F.sum("num_measured").alias("num_measured")))


def finish_flag_stats(partials: DataFrame, flag: str = "has_night_tube") -> DataFrame:
    """Sum the additive parts per flag; the average is total / measured count (exact)."""
    agg = partials.groupBy(flag).agg(F.sum("num_records").alias("num_records"),
                                     _sum(),
                                     F.sum("num_measured").alias("num_measured"))
    return agg.select(
        flag, "num_records", "total_passengers",
        F.try_divide(F.col("total_passengers").cast("double"),
                     F.col("num_measured").cast("double")).alias("avg_passengers_per_record"))


def night_tube_analysis(st: DataFrame, stations: DataFrame, flag: str = "has_night_tube") -> DataFrame:
    return finish_flag_stats(flag_partials(st, stations, flag), flag)


def merge_mean_of_means(old: DataFrame, new: DataFrame, flag: str = "has_night_tube") -> DataFrame:
    """Compatibility merge of two night-service marts: counts and totals add up, the
    average is the unweighted mean of the two averages (exact only for equal counts)."""
    cols = [flag, "num_records", "total_passengers", "avg_passengers_per_record"]
    return (old.select(*cols).unionByName(new.select(*cols)).groupBy(flag)
            .agg(F.sum("num_records").alias("num_records"), _sum(),
                 F.avg("avg_passengers_per_record").alias("avg_passengers_per_record")))


# --- ordering as the marts are presented (O1 / O2) ------------------------------
MART_ORDER = {
    "busiest_stations": [("total_passengers", "desc"), ("station_name", "asc")],
    "passengers_by_year": [("year", "asc")],
    "passengers_by_line": [("total_passengers", "desc"), ("line_name", "asc")],
    "passengers_by_network": [("total_passengers", "desc"), ("network_name", "asc"),
                              ("network_type", "asc")],
    "interchange_stations": [("num_lines", "desc"), ("station_name", "asc")],
    "quarterly_trend": [("year", "asc"), ("quarter", "asc")],
    "night_tube_analysis": [],
}

MART_NAMES = list(MART_ORDER)


def ordered(df: DataFrame, mart: str) -> DataFrame:
    order = [F.desc_nulls_last(c) if d == "desc" else F.asc_nulls_first(c)
             for c, d in MART_ORDER[mart]]
    return df.orderBy(*order) if order else df


def all_marts(star: Star, flag: str = "has_night_tube") -> dict[str, DataFrame]:
    """All seven marts over one star (unordered)."""
    st = station_totals(star.fact)
    dt = date_totals(star.fact)
    return {
        "busiest_stations": busiest_stations(st, star.stations),
        "passengers_by_year": passengers_by_year(dt, star.dates),
        "passengers_by_line": passengers_by_line(st, star.bridge, star.lines),
        "passengers_by_network": passengers_by_network(st, star.stations, star.networks),
        "interchange_stations": interchange_stations(star.bridge, star.stations),
        "quarterly_trend": quarterly_trend(dt, star.dates),
        "night_tube_analysis": night_tube_analysis(st, star.stations, flag),
    }


def mart(star: Star, name: str, flag: str = "has_night_tube") -> DataFrame:
    """One mart, ordered as presented."""
    st = lambda: station_totals(star.fact)
    dt = lambda: date_totals(star.fact)
    build = {
        "busiest_stations": lambda: busiest_stations(st(), star.stations),
        "passengers_by_year": lambda: passengers_by_year(dt(), star.dates),
        "passengers_by_line": lambda: passengers_by_line(st(), star.bridge, star.lines),
        "passengers_by_network": lambda: passengers_by_network(st(), star.stations, star.networks),
        "interchange_stations": lambda: interchange_stations(star.bridge, star.stations),
        "quarterly_trend": lambda: quarterly_trend(dt(), star.dates),
        "night_tube_analysis": lambda: night_tube_analysis(st(), star.stations, flag),
    }[name]
    return ordered(build(), name)
