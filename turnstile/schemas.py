"""Declared schemas.  Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
_DT, _TS = T.DateType(), T.TimestampType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- star tables (column lists as declared for the six external tables) ---
DIM_DATE = _struct(("date_id", _I), ("year", _I), ("quarter", _I), ("month", _I),
                   ("is_annual", _B), ("period_label", _S), ("period_start", _DT),
                   ("period_end", _DT), ("created_at", _TS))
DIM_LINES = _struct(("line_id", _I), ("line_name", _S), ("line_color", _S),
                    ("is_night_service", _B), ("created_at", _TS), ("updated_at", _TS))
DIM_NETWORKS = _struct(("network_id", _I), ("network_name", _S), ("network_type", _S),
                       ("created_at", _TS), ("updated_at", _TS))
DIM_STATIONS = _struct(("station_id", _I), ("nlc_code", _D), ("station_name", _S),
                       ("network_id", _I), ("has_london_underground", _B),
                       ("has_elizabeth_line", _B), ("has_overground", _B), ("has_dlr", _B),
                       ("has_night_tube", _B), ("is_active", _B), ("created_at", _TS),
                       ("updated_at", _TS))
FACT_STATION_LINES = _struct(("station_line_id", _I), ("station_id", _I), ("line_id", _I),
                             ("is_interchange", _B), ("effective_from", _DT),
                             ("effective_to", _DT), ("created_at", _TS))
FACT_PASSENGER_ENTRY_EXIT = _struct(("entry_exit_id", _L), ("station_id", _I), ("date_id", _I),
                                    ("total_entry_exit", _L), ("estimated_entries", _L),
                                    ("estimated_exits", _L), ("record_type", _S),
                                    ("data_source", _S), ("created_at", _TS))

STAR_TABLES = {
    "dim_date": DIM_DATE,
    "dim_lines": DIM_LINES,
    "dim_networks": DIM_NETWORKS,
    "dim_stations": DIM_STATIONS,
    "fact_station_lines": FACT_STATION_LINES,
    "fact_passenger_entry_exit": FACT_PASSENGER_ENTRY_EXIT,
}

# --- processed-period ledger ---
LEDGER = T.StructType([
    T.StructField("source_table", _S, False),
    T.StructField("processed_year", _I, False),
    T.StructField("processed_at", _TS, True),
])

# --- arrival message (JSON value of a topic record) ---
# The eleven fields read from each message, in message order.
ARRIVAL_FIELDS = [
    ("id", _S), ("vehicleId", _S), ("stationName", _S), ("lineName", _S),
    ("platformName", _S), ("expectedArrival", _S), ("timeToStation", _I),
    ("currentLocation", _S), ("direction", _S), ("destinationName", _S),
    ("timestamp", _S),
]
# Fields that messages to the keyed store may carry besides: their own event and ingestion time.
KEYED_FIELDS = [("arr_timestamp", _S), ("ingested_at", _S)]
CORRUPT_COLUMN = "_corrupt_record"
ARRIVAL_JSON = _struct(*ARRIVAL_FIELDS)
ARRIVAL_JSON_WITH_CORRUPT = _struct(*ARRIVAL_FIELDS, *KEYED_FIELDS, (CORRUPT_COLUMN, _S))

# Topic record envelope as the message sources deliver it.
MESSAGE_ENVELOPE = _struct(("value", T.BinaryType()), ("partition", _I), ("offset", _L),
                           ("timestamp", _TS))
