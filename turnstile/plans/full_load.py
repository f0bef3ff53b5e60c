"""Full batch: build the seven marts and publish them as Parquet tables.

Two ways, same numbers:

* ``write_marts`` computes each mart straight from the star and writes it to
  ``out/<mart>`` (a folder nothing in the job reads).  All marts come from a
  single grouping-sets aggregate of the fact when the shared aggregates are
  written first (``share_aggregates=True``): the fact is then scanned once in
  total instead of once per mart.
* ``incremental.MartStore.load`` on the full star: the same marts, plus the
  ledger rows that let later increments skip what is already loaded.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import marts
from ..session import scratch_dir
from ..star import Star


def shared_aggregates(star: Star, share: bool = True) -> tuple[DataFrame, DataFrame]:
    """Station and date aggregates of the fact.

    With ``share`` both come from one grouping-sets aggregate (one fact scan),
    written once as Parquet under the shared checkpoint folder and read back:
    lineage cut, and the files survive executor loss.  (A reliable
    ``checkpoint()`` would compute them twice: once for its count and once
    more to write the checkpoint.)
    """
    if not share:
        return marts.station_totals(star.fact), marts.date_totals(star.fact)
    path = scratch_dir(star.spark, "shared-aggregates")
    marts.station_and_date_totals(star.fact).write.parquet(path)
    return marts.split_totals(star.spark.read.parquet(path))


def build_marts(star: Star, share_aggregates: bool = True,
                flag: str = "has_night_tube") -> dict[str, DataFrame]:
    st, dt = shared_aggregates(star, share_aggregates)
    return {
        "busiest_stations": marts.busiest_stations(st, star.stations),
        "passengers_by_year": marts.passengers_by_year(dt, star.dates),
        "passengers_by_line": marts.passengers_by_line(st, star.bridge, star.lines),
        "passengers_by_network": marts.passengers_by_network(st, star.stations, star.networks),
        "interchange_stations": marts.interchange_stations(star.bridge, star.stations),
        "quarterly_trend": marts.quarterly_trend(dt, star.dates),
        "night_tube_analysis": marts.night_tube_analysis(st, star.stations, flag),
    }


def write_marts(star: Star, out: str | None = None, share_aggregates: bool = True) -> dict[str, str]:
    """Write the seven marts; the writes are independent jobs and are submitted together."""
    out = (out or scratch_dir(star.spark, "marts")).rstrip("/")
    # two marts read the bridge: it is written once
    bridge = scratch_dir(star.spark, "bridge")
    star.bridge.select("station_id", "line_id").write.parquet(bridge)
    built = build_marts(replace(star, bridge=star.spark.read.parquet(bridge)), share_aggregates)
    paths = {name: f"{out}/{name}" for name in built}
    with ThreadPoolExecutor(max_workers=len(built)) as pool:
        for f in [pool.submit(df.write.mode("overwrite").parquet, paths[name])
                  for name, df in built.items()]:
            f.result()
    return paths


def read_marts(spark, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: marts.ordered(spark.read.parquet(p), name) for name, p in paths.items()}


def total_check(frames: dict[str, DataFrame]) -> DataFrame:
    """(gold_table, grand_total) of the marts that each partition the whole fact once;
    the totals are equal when no fact row is orphaned."""
    parts = [frames[name].agg(F.sum("total_passengers").alias("grand_total"))
             .select(F.lit(name).alias("gold_table"), "grand_total")
             for name in ("busiest_stations", "passengers_by_year", "night_tube_analysis")]
    return reduce(DataFrame.unionByName, parts)
