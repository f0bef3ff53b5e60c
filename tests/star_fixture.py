"""A hand-made star with the awkward cases; expected marts are derived by hand below."""

from turnstile.star import Star


def small_star(spark) -> Star:
    stations = spark.createDataFrame(
        [(1, "Angel", 1, True), (2, "Bank", 1, False), (3, "Bank", 2, False), (4, "Oval", 2, None)],
        "station_id int, station_name string, network_id int, has_night_tube boolean")
    networks = spark.createDataFrame([(1, "LU", "Underground"), (2, "DLR", "Light")],
                                     "network_id int, network_name string, network_type string")
    lines = spark.createDataFrame([(10, "Northern"), (11, "Central"), (12, "Circle")],
                                  "line_id int, line_name string")
    bridge = spark.createDataFrame([(1, 10), (2, 11), (2, 12), (3, 11), (4, 10)],
                                   "station_id int, line_id int")
    dates = spark.createDataFrame([(100, 2020, 1), (101, 2020, 2), (200, 2021, None)],
                                  "date_id int, year int, quarter int")
    fact = spark.createDataFrame(
        [(1, 1, 100, 10), (2, 1, 200, 20), (3, 2, 100, 5), (4, 3, 101, 7),
         (5, 4, 200, None),      # null measure: skipped by SUM/AVG, counted by COUNT(id)
         (6, 4, 101, 3),
         (7, 9, 100, 100),       # station 9 unknown: dropped by the station marts
         (8, 1, 999, 1)],        # date 999 unknown: dropped by the period marts
        "entry_exit_id bigint, station_id int, date_id int, total_entry_exit bigint")
    return Star(fact=fact, dates=dates, stations=stations, networks=networks, lines=lines,
                bridge=bridge)


EXPECTED = {
    "busiest_stations": {("Angel", 31), ("Bank", 12), ("Oval", 3)},
    "passengers_by_year": {(2020, 125), (2021, 20)},
    "passengers_by_line": {("Northern", 34), ("Central", 12), ("Circle", 5)},
    "passengers_by_network": {("LU", "Underground", 36), ("DLR", "Light", 10)},
    "interchange_stations": {("Angel", 1), ("Bank", 3), ("Oval", 1)},
    "quarterly_trend": {(2020, 1, 115), (2020, 2, 10), (2021, None, 20)},
    "night_tube_analysis": {(True, 3, 31, 31 / 3), (False, 2, 12, 6.0), (None, 2, 3, 3.0)},
}


def as_set(df):
    return {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()}
