"""Relational extracts over JDBC (S8, S9, S10) and their DataFrame twin.

``read_table`` reads a whole table in parallel ranges of a numeric column;
``read_query`` pushes a projection/join/filter to the database as a
subquery; ``refresh_tables`` re-extracts a list of reference tables.
``extract_reads`` lists the reads of one extract: with a fact year, its slice is
read in the given ranges and the (small) reference tables whole; without one,
the ranges apply to the tables.  The extract is written as delimited text or
Parquet by the caller.

Connection settings are arguments (or environment variables the caller
reads); nothing is hard-coded.  No database driver ships with this
environment, so the JDBC path is exercised only for its options; the same
slice logic runs on DataFrames in ``year_slice``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..star import Star


@dataclass(frozen=True)
class Connection:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, **self.extra}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver is not None:
            opts["driver"] = self.driver
        return opts


@dataclass(frozen=True)
class Bounds:
    column: str
    lower: int
    upper: int
    partitions: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": str(self.lower),
                "upperBound": str(self.upper), "numPartitions": str(self.partitions)}


def table_options(conn: Connection, table: str, bounds: Bounds | None = None,
                  fetch_size: int = 10_000) -> dict[str, str]:
    opts = {**conn.options(), "dbtable": table, "fetchsize": str(fetch_size)}
    if bounds is not None:
        opts.update(bounds.options())
    return opts


def read_table(spark: SparkSession, conn: Connection, table: str,
               bounds: Bounds | None = None) -> DataFrame:
    """Whole table; with ``bounds`` it is read by ``partitions`` parallel range queries."""
    return spark.read.format("jdbc").options(**table_options(conn, table, bounds)).load()


def year_slice_sql(year: int, fact: str = "fact_passenger_entry_exit",
                   dates: str = "dim_date") -> str:
    """Extract query for one year of facts (projection + join + predicate at the source)."""
    if not isinstance(year, int):
        raise TypeError("year must be an int")
    return (f"(SELECT f.entry_exit_id, f.station_id, f.date_id, f.total_entry_exit, "
            f"f.estimated_entries, f.estimated_exits, f.record_type, f.data_source, f.created_at "
            f"FROM {fact} f JOIN {dates} d ON f.date_id = d.date_id "
            f"WHERE d.year = {year}) q")


def read_query(spark: SparkSession, conn: Connection, subquery: str,
               bounds: Bounds | None = None) -> DataFrame:
    """A pushed-down subquery (aliased), partitioned like ``read_table`` when bounds are given."""
    return read_table(spark, conn, subquery, bounds)


def refresh_tables(spark: SparkSession, conn: Connection, tables: list[str],
                   writer, bounds: dict[str, Bounds] | None = None) -> dict[str, str]:
    """Re-extract each reference table whole and hand it to ``writer(name, df) -> path``."""
    bounds = bounds or {}
    return {t: writer(t, read_table(spark, conn, t, bounds.get(t))) for t in tables}


def extract_reads(conn: Connection, tables: list[str], fact_year: int | None = None,
                  bounds: Bounds | None = None, fact: str = "fact_passenger_entry_exit") -> dict[str, dict[str, str]]:
    """Reader options by output name; the fact slice is never one connection's work."""
    if fact_year is None:
        return {t: table_options(conn, t, bounds) for t in tables}
    if bounds is None:
        raise ValueError("the fact slice needs ranges")
    reads = {t: table_options(conn, t) for t in tables}
    reads[fact] = table_options(conn, year_slice_sql(fact_year, fact), bounds)
    return reads


def year_slice(star: Star, year: int) -> DataFrame:
    """The same slice on DataFrames: facts of one year, fact columns only."""
    from ..operators.joins import join_bounded
    days = star.dates.filter(F.col("year").cast("int") == year).select("date_id")
    return join_bounded(star.fact, days, "date_id", "left_semi") \
        .select("entry_exit_id", "station_id", "date_id", "total_entry_exit")
