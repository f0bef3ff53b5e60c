"""Facts stored by period, and the gate that opens only the periods still to be loaded.

``write_by_period`` lays a fact out as ``period=Y/`` folders (the year of its date; the null period holds facts
without one).  ``open_facts`` joins such a fact with the open years: Spark turns the join into a dynamic pruning
filter on the partition column, so files of processed years are not opened.  The layout trusts the calendar at
the time of writing; dates do not change their year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins
from ..sinks import write_partitioned
from ..star import Star

PERIOD = "period"


def write_by_period(star: Star, path: str) -> None:
    """The star's fact in folders by the year of its date."""
    years = star.dates.groupBy("date_id").agg(F.min(F.col("year").cast("int")).alias(PERIOD))
    write_partitioned(joins.join_bounded(star.fact, years, "date_id", "left"), path, [PERIOD])


def read_by_period(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn(PERIOD, F.col(PERIOD).cast("int"))


def open_facts(fact: DataFrame, years: DataFrame, max_rows: int = joins.DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Facts of the open ``years`` (column year) and those without a period; a fact without that column stays whole."""
    if PERIOD not in fact.columns:
        return fact
    wanted = years.select(F.col("year").alias(PERIOD)).distinct()
    dated = joins.join_bounded(fact, wanted, PERIOD, "left_semi", max_rows)
    return dated.unionByName(fact.filter(F.col(PERIOD).isNull())).drop(PERIOD)
