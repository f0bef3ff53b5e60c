"""The star-schema bundle the mart functions take.

Every frame uses the canonical column names of the declared tables, so the
same mart code runs on the delimited sample files, on a JDBC extract and on
the driver's test tables (see ``adapters``).  Only the columns the marts
read are required:

  fact      entry_exit_id, station_id, date_id, total_entry_exit
  dates     date_id, year, quarter
  stations  station_id, station_name, network_id, has_night_tube
  networks  network_id, network_name, network_type
  lines     line_id, line_name
  bridge    station_id, line_id
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dates: DataFrame
    stations: DataFrame
    networks: DataFrame
    lines: DataFrame
    bridge: DataFrame

    def with_fact(self, fact: DataFrame) -> "Star":
        return replace(self, fact=fact)

    @property
    def spark(self) -> SparkSession:
        return self.fact.sparkSession


def star_from_frames(tables: dict[str, DataFrame]) -> Star:
    """Build a Star from frames named like the six declared tables."""
    return Star(
        fact=tables["fact_passenger_entry_exit"],
        dates=tables["dim_date"],
        stations=tables["dim_stations"],
        networks=tables["dim_networks"],
        lines=tables["dim_lines"],
        bridge=tables["fact_station_lines"],
    )
