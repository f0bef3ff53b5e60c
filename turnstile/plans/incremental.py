"""Incremental loading of the marts through a processed-period ledger, with atomic commits.

Store layout under ``root`` (Parquet; every folder is written once):

  manifests/v=N.json                      what the store holds (``commits.Manifests``)
  ledger/load=L/processed_year=Y/         source_table, processed_at
  partials/base/load=L/load_year=Y/       grain ('station' | 'quarter'), station_id, quarter,
                                          total_passengers, num_records, num_measured
  partials/<mart>/load=L/load_year=Y/     the station-derived marts at their own keys, per year
  interchange/load=L/                     station_name, num_lines: the whole mart after the load
  bridge/load=L/                          the station-line bridge in force for the load
  dates/load=L/                           the dates of a running load

Facts without a year are in the null year's folder of their load.  A manifest names, per table, the loads that
hold each year (the load itself, then corrections of it) and each batch of facts without a year, the ledger's
folders, and the newest interchange mart.

How a load runs (the fact is scanned once):

1. The date dimension, one row per date id, with a mark for years already in the ledger (``reload=True`` marks
   none), is written and left-joined to the facts, broadcast after a check of its size, so the raw fact is
   never shuffled.  Facts of marked years stop here; facts without a year (no date row, null date, null
   year) go on.  A fact stored by period (``periods``) is first pruned to the periods that are open.
2. One grouping-sets aggregate computes both partials of the remaining rows: per (year, station) and per
   (year, quarter).  If nothing is left the load ends here.
3. The station-derived marts (busiest stations, by line, by network, night service) are computed from this load's
   station partial with the dimensions of this load ("as loaded").
4. The interchange mart is written anew: the stations of this load's bridge replace their rows, others stay.
5. The manifest is published.  Years of this load replace older ones of the same number, facts without a year
   replace the same batch's (the caller's ``batch``, or a fingerprint), another batch adds.  ``clear_years``
   drops years whose corrected facts are empty.

Before step 5 the store is what it was; a crash at any write leaves only folders that nothing names, and a retry
loads afresh.  If another loader published first, years and batches that it processed are left out (unless
reloaded) and the interchange mart is merged anew, so no fact counts twice.  ``replace`` publishes a full
load in place of everything, in the same single step.

Corrections (``correct``, ``rebridge``) are signed deltas: withdrawn rows count -1, new ones +1.  They go through the
same aggregates and joins and are appended beside the year's partials, so a corrected year is not read or loaded
again.  A change of facts meets the bridge in force; a change of the bridge meets the stored totals of all facts.

A mart is read by summing its partials over all years (sum, counts and the measured count are additive, so the
average stays exact).  The last two manifests stay readable; what only older ones name is removed.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import joins, keysets, marts
from ..schemas import LEDGER
from ..sources.files import delete_path, subfolders
from ..star import Star
from . import periods
from .commits import Conflict, Manifests, new_id

SOURCE = "fact_passenger_entry_exit"
LOAD_KEY = "load_year"

# mart name -> key columns of its partial (besides load_year)
ADDITIVE = {
    "busiest_stations": ["station_name"],
    "passengers_by_line": ["line_name"],
    "passengers_by_network": ["network_name", "network_type"],
    "night_tube_analysis": ["has_night_tube"],
}


@dataclass
class LoadResult:
    years: DataFrame          # years loaded by this run (from its own partial rows)
    version: int              # the store's version after it
    undated: int = 0          # facts without a year that this run loaded

    @property
    def loaded(self) -> bool:
        """False when every incoming year was already processed and nothing else came."""
        return self.undated > 0 or not self.years.isEmpty()


def incoming_years(star: Star) -> DataFrame:
    """Distinct years present in the fact batch."""
    dt = marts.date_totals(star.fact)  # one row per date before the join
    return keysets.distinct_keys(
        dt.join(star.dates.select("date_id", F.col("year").cast("int").alias("year")), "date_id"),
        "year")


def ledger_rows(years: DataFrame, source: str = SOURCE) -> DataFrame:
    """Ledger rows for a key set, built from the DataFrame itself."""
    return years.select(F.lit(source).alias("source_table"),
                        F.col("year").cast("int").alias("processed_year"),
                        F.current_timestamp().alias("processed_at"))


def processed_years(ledger: DataFrame, source: str = SOURCE) -> DataFrame:
    return (ledger.filter(F.col("source_table") == source)
            .select(F.col("processed_year").alias("year")).distinct())


def years_to_process(incoming: DataFrame, ledger: DataFrame, source: str = SOURCE) -> DataFrame:
    """Incoming years not yet in the ledger for ``source``."""
    return keysets.key_difference(incoming, processed_years(ledger, source), "year")


NO_YEAR = "__HIVE_DEFAULT_PARTITION__"


def _folders(content: dict):
    """The folders that a manifest names."""
    for load, year in content.get("ledger", []):
        yield f"ledger/load={load}/processed_year={year}"
    for table, years in content.get("years", {}).items():
        yield from (f"partials/{table}/load={load}/{LOAD_KEY}={year}" for year, loads in years.items() for load in loads)
    for table, batches in content.get("undated", {}).items():
        yield from (f"partials/{table}/load={load}/{LOAD_KEY}={NO_YEAR}" for load in batches.values())
    for table in ("interchange", "bridge"):
        if content.get(table):
            yield f"{table}/load={content[table]}"


class MartStore:
    TABLES = ("base", *ADDITIVE)

    def __init__(self, spark: SparkSession, root: str, source: str = SOURCE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.source = source
        self.manifests = Manifests(spark, self.root, _folders)

    # -- paths and writes ------------------------------------------------------
    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _write(self, df: DataFrame, path: str, by: str | None = None) -> None:
        """Every write of a load goes through here, into a folder of its own."""
        (df.write.partitionBy(by) if by else df.write).parquet(path)

    def _read(self, table: str, folders: list[str]) -> DataFrame | None:
        if not folders:
            return None
        return (self.spark.read.option("basePath", self.path(table)).parquet(*[self.path(f) for f in folders]))

    # -- ledger ----------------------------------------------------------------
    def ledger(self, held: dict | None = None) -> DataFrame:
        held = self.manifests.newest()[1] if held is None else held
        df = self._read("ledger", [f for f in _folders(held) if f.startswith("ledger/")])
        return self.spark.createDataFrame([], LEDGER) if df is None else df.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER.fields])

    def processed_years(self, held: dict | None = None) -> DataFrame:
        return processed_years(self.ledger(held), self.source)

    # -- load ------------------------------------------------------------------
    def gated_facts(self, star: Star, load: str, reload: bool = False,
                    max_broadcast_rows: int = joins.DEFAULT_MAX_BROADCAST_ROWS, held: dict | None = None) -> DataFrame:
        """Facts this load processes, with load_year, quarter and whether a date row exists.

        The gate is applied to the date dimension, not to the facts: dates of years already in the ledger are
        marked, the dates are written for this run, and the facts meet them in one left join.  That join is
        map-side when the written date table is proven small (one row per day), so the raw fact is never
        shuffled before it is aggregated.  A date id listed twice keeps its earliest (year, quarter).
        """
        dates = star.dates.filter("date_id IS NOT NULL").groupBy("date_id").agg(
            F.min(F.struct(F.col("year").cast("int").alias(LOAD_KEY),
                           F.col("quarter").cast("int").alias("quarter"))).alias("d")).select("date_id", "d.*")
        if reload:
            dates = dates.withColumn("_done", F.lit(0))
        else:
            done = self.processed_years(held).select(F.col("year").alias("_year"), F.lit(1).alias("_done"))
            dates = dates.join(done, F.col(LOAD_KEY) == F.col("_year"), "left").drop("_year").fillna(0, ["_done"])
        dates_path = self.path("dates", f"load={load}")
        self._write(dates, dates_path)
        dates = self.spark.read.schema(dates.schema).parquet(dates_path)
        fact = periods.open_facts(star.fact, dates.filter("_done = 0").select(F.col(LOAD_KEY).alias("year")), max_broadcast_rows)
        facts = joins.join_bounded(fact, dates.withColumn("_dated", F.lit(True)), "date_id", "left", max_broadcast_rows)
        return facts.filter(F.coalesce("_done", F.lit(0)) == 0)

    def load(self, star: Star, reload: bool = False, flag: str = "has_night_tube",
             max_broadcast_rows: int = joins.DEFAULT_MAX_BROADCAST_ROWS,
             clear_years=(), batch: str | None = None) -> LoadResult:
        """Add what is new in ``star`` (``reload``: replace its years) in one commit."""
        return self._load(star, False, reload, flag, max_broadcast_rows, clear_years, batch)

    def replace(self, star: Star) -> LoadResult:
        """A full load: the store holds this star and nothing else, from one commit to the next."""
        return self._load(star, True)

    def _base(self, dated: DataFrame, load: str) -> DataFrame:
        """Both partials of gated facts, written and read back; ``sign`` says how often a fact counts."""
        dated = dated if "sign" in dated.columns else dated.withColumn("sign", F.lit(1))
        sign = F.col("sign").cast("long")
        base = (dated.groupingSets([[LOAD_KEY, "station_id"], [LOAD_KEY, "quarter", "_dated"]],
                                   LOAD_KEY, "station_id", "quarter", "_dated")
                .agg(F.sum(F.col(marts.MEASURE) * sign).cast("long").alias("total_passengers"),
                     F.coalesce(F.sum(F.when(F.col("entry_exit_id").isNotNull(), sign)), F.lit(0)).alias("num_records"),
                     F.coalesce(F.sum(F.when(F.col(marts.MEASURE).isNotNull(), sign)), F.lit(0)).alias("num_measured"),
                     # order-free hash of the undated facts; decimal, as sums of it pass a long
                     F.sum(F.when(F.col(LOAD_KEY).isNull(), F.xxhash64("entry_exit_id", "station_id", marts.MEASURE)
                                  .cast("decimal(20,0)"))).alias("fact_hash"),
                     F.grouping("station_id").alias("_gid"))
                # period marts count facts with a date row, station marts all facts
                .filter((F.col("_gid") == 0) | F.col("_dated"))
                .select(F.when(F.col("_gid") == 0, F.lit("station")).otherwise(F.lit("quarter")).alias("grain"),
                        "station_id", "quarter", "total_passengers", "num_records",
                        "num_measured", "fact_hash", LOAD_KEY))
        path = self.path("partials", "base", f"load={load}")
        self._write(base, path, LOAD_KEY)
        return self.spark.read.schema(base.schema).parquet(path)

    def _load(self, star: Star, whole: bool, reload: bool = False, flag: str = "has_night_tube",
              max_broadcast_rows: int = joins.DEFAULT_MAX_BROADCAST_ROWS, clear_years=(),
              batch: str | None = None) -> LoadResult:
        load = new_id()
        seen = {} if whole else self.manifests.newest()[1]
        this = self._base(self.gated_facts(star, load, reload, max_broadcast_rows, seen), load)
        totals = this.filter(F.col(LOAD_KEY).isNull()).agg(
            F.sum(F.when(F.col("grain") == "station", F.col("num_records"))).alias("n"),
            F.sum(F.pmod(F.xxhash64("grain", "station_id", "quarter", "total_passengers", "num_records", "num_measured",
                                    "fact_hash"), F.lit(1 << 40))).alias("mark")).first()
        n_undated = int(totals["n"] or 0)
        key = batch or f"{totals['mark']}"
        has_years = not this.filter(F.col(LOAD_KEY).isNotNull()).isEmpty()
        if n_undated and not batch and key in seen.get("undated", {}).get("base", {}):
            n_undated = 0  # this very batch is in the store
        # facts of processed years only: nothing to do (a load without facts refreshes the interchange)
        if not n_undated and not has_years and not clear_years and not star.fact.isEmpty():
            for part in ("dates", "partials/base"):
                delete_path(self.spark, self.path(part, f"load={load}"))
            return LoadResult(self.spark.createDataFrame([], "year int"), self.manifests.version())
        # the bridge in force for this load, written once: both the line mart and
        # the interchange mart read it (and it records the "as loaded" mapping)
        bridge_path = self.path("bridge", f"load={load}")
        self._write(star.bridge.select("station_id", "line_id"), bridge_path)
        bridge = self.spark.read.parquet(bridge_path)
        station_marts = self._station_marts(this, star, bridge, flag)
        years = this.filter(F.col(LOAD_KEY).isNotNull()).select(F.col(LOAD_KEY).cast("int").alias("year")).distinct()
        degrees = marts.interchange_stations(bridge, star.stations)
        jobs = [lambda df=df, name=name: self._write(df, self.path("partials", name, f"load={load}"), LOAD_KEY)
                for name, df in station_marts.items()]
        jobs += [lambda: self._write(ledger_rows(years, self.source), self.path("ledger", f"load={load}"), "processed_year"),
                 lambda: self._write_interchange(degrees, seen, load)]
        # independent small jobs: submitted together, Spark schedules them side by side
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for f in [pool.submit(job) for job in jobs]:
                f.result()
        written = {name: self._years_of("partials", name, load) for name in self.TABLES}
        version, content = self.manifests.commit(
            lambda held: self._content(held, seen, written, load, degrees, whole, reload, clear_years, key, bool(batch)))
        delete_path(self.spark, self.path("dates", f"load={load}"))
        mine = [int(y) for at, y in content["ledger"] if at == load]
        taken = n_undated if content["undated"].get("base", {}).get(key) == load else 0
        return LoadResult(years.filter(F.col("year").isin(mine)), version, taken)

    @staticmethod
    def _station_marts(base: DataFrame, star: Star, bridge: DataFrame, flag: str) -> dict[str, DataFrame]:
        """The station-derived marts of base partials, per year."""
        by = (LOAD_KEY,)
        st = base.filter(F.col("grain") == "station").select(*by, "station_id", "total_passengers", "num_records", "num_measured")
        return {"busiest_stations": marts.busiest_stations(st, star.stations, by),
                "passengers_by_line": marts.passengers_by_line(st, bridge, star.lines, by),
                "passengers_by_network": marts.passengers_by_network(st, star.stations, star.networks, by),
                "night_tube_analysis": marts.flag_partials(st, star.stations, flag, by)}

    # -- corrections -------------------------------------------------------------
    def correct(self, star: Star, flag: str = "has_night_tube") -> int:
        """Apply the signed facts of ``star`` (column sign: -1 withdrawn, 1 added) to processed years.

        A corrected fact is its old row with -1 and its new row with 1.  Facts of years that the store has not
        processed are left out, as the load to come will bring them.  Lines count by the bridge in force.
        """
        load = new_id()
        _, seen = self.manifests.newest()
        if not seen.get("bridge"):
            raise ValueError(f"{self.root} holds no load to correct")
        done = self.processed_years(seen).select(F.col("year").alias(LOAD_KEY))
        dates = star.dates.filter("date_id IS NOT NULL").groupBy("date_id").agg(
            F.min(F.struct(F.col("year").cast("int").alias(LOAD_KEY), F.col("quarter").cast("int").alias("quarter"))).alias("d"))
        known = dates.select("date_id", "d.*", F.lit(True).alias("_dated"))
        dated = joins.join_bounded(star.fact, known, "date_id", "left")
        dated = dated.join(done.withColumn("_in", F.lit(True)), LOAD_KEY, "left").filter(
            F.col(LOAD_KEY).isNull() | F.col("_in")).drop("_in")
        base = self._base(dated, load)
        bridge = self.spark.read.parquet(self.path("bridge", f"load={seen['bridge']}"))
        for name, df in self._station_marts(base, star, bridge, flag).items():
            self._write(df, self.path("partials", name, f"load={load}"), LOAD_KEY)
        return self._append(load, seen, self.TABLES)

    def rebridge(self, star: Star) -> int:
        """Make ``star.bridge`` the bridge in force: its signed change from the old one meets the totals of all facts."""
        load = new_id()
        _, seen = self.manifests.newest()
        base = self.partial("base", seen)
        if base is None:
            raise ValueError(f"{self.root} holds no load to correct")
        path = self.path("bridge", f"load={load}")
        self._write(star.bridge.select("station_id", "line_id"), path)
        old = self.spark.read.parquet(self.path("bridge", f"load={seen['bridge']}"))
        change = (self.spark.read.parquet(path).withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1)))
                  .groupBy("station_id", "line_id").agg(F.sum("sign").alias("sign")).filter("sign <> 0"))
        totals = base.filter(F.col("grain") == "station").groupBy(LOAD_KEY, "station_id").agg(
            F.sum("total_passengers").alias("total_passengers"))
        delta = (totals.join(change, "station_id").groupBy(LOAD_KEY, "line_id")
                 .agg(F.sum(F.col("total_passengers") * F.col("sign")).alias("total_passengers"))
                 .join(star.lines.select("line_id", "line_name"), "line_id").groupBy(LOAD_KEY, "line_name")
                 .agg(F.sum("total_passengers").alias("total_passengers")))
        self._write(delta, self.path("partials", "passengers_by_line", f"load={load}"), LOAD_KEY)
        return self._append(load, seen, ["passengers_by_line"], load)

    def _append(self, load: str, seen: dict, tables, bridge: str | None = None) -> int:
        """Publish signed partials beside those they correct."""
        written = {t: self._years_of("partials", t, load) for t in tables}

        def change(held: dict) -> dict:
            if held != seen:
                raise Conflict(f"{self.root} was loaded meanwhile; correct it again")
            out = {**held, "years": {t: {y: list(loads) for y, loads in v.items()} for t, v in held["years"].items()},
                   "undated": {t: dict(v) for t, v in held["undated"].items()}, "bridge": bridge or held["bridge"]}
            for table, found in written.items():
                for year in found:
                    if year == NO_YEAR:
                        out["undated"].setdefault(table, {})[f"correction-{load}"] = load
                    else:
                        out["years"].setdefault(table, {}).setdefault(year, []).append(load)
            return out

        return self.manifests.commit(change)[0]

    def _years_of(self, *parts: str) -> list[str]:
        """The partitions that a load wrote of a table, by name."""
        *table, load = parts
        return [f.rsplit("=", 1)[1] for f in subfolders(self.spark, self.path(*table, f"load={load}"))]

    def _content(self, held: dict, seen: dict, written: dict, load: str, degrees: DataFrame, whole: bool, reload: bool,
                 clear_years, key: str, replaces: bool) -> dict:
        """The manifest after this load, on top of ``held`` (``seen``: what the load was computed against)."""
        held = {} if whole else held
        out = {"years": {t: {y: list(loads) for y, loads in v.items()} for t, v in held.get("years", {}).items()},
               "undated": {t: dict(v) for t, v in held.get("undated", {}).items()},
               "ledger": list(held.get("ledger", [])), "bridge": load}
        for years in out["years"].values():
            for year in clear_years:
                years.pop(str(int(year)), None)
        # years that another loader has processed since this one looked
        known = {y for _, y in seen.get("ledger", [])}
        late = set() if reload or whole else {y for _, y in out["ledger"]} - known
        mine = [y for y in written["base"] if y != NO_YEAR and y not in late]
        batches = out["undated"].get("base", {})
        undated = NO_YEAR in written["base"] and (replaces or key not in batches)
        for table, found in written.items():
            for year in mine:
                out["years"].setdefault(table, {}).pop(year, None)
                if year in found:
                    out["years"][table][year] = [load]
            if undated:
                out["undated"].setdefault(table, {}).pop(key, None)
                if NO_YEAR in found:
                    out["undated"][table][key] = load
        out["ledger"] += [[load, y] for y in mine]
        out["interchange"] = load
        if held.get("interchange") != seen.get("interchange") and not whole:
            # merged with an older mart than the newest: once more
            out["interchange"] = self._write_interchange(degrees, held, new_id())
        return out

    def _write_interchange(self, degrees: DataFrame, held: dict, load: str) -> str:
        """The interchange mart with the stations of ``degrees`` replaced."""
        new = degrees.select("station_name", "num_lines", F.lit(1).alias("_age"))
        old = self._interchange(held)
        if old is not None:
            new = old.withColumn("_age", F.lit(0)).unionByName(new)
        rows = keysets.latest_version(new, ["station_name"], "_age").drop("_age")
        self._write(rows, self.path("interchange", f"load={load}"))
        return load

    def _interchange(self, held: dict) -> DataFrame | None:
        load = held.get("interchange")
        return self.spark.read.parquet(self.path("interchange", f"load={load}")) if load else None

    def vacuum(self, older_than_seconds: float = 86_400) -> list[str]:
        """Remove what crashed loads left behind."""
        return self.manifests.vacuum(["ledger", "interchange", "bridge", "dates", *[f"partials/{t}" for t in self.TABLES]],
                                     older_than_seconds)

    # -- read ------------------------------------------------------------------
    def partial(self, name: str, held: dict | None = None) -> DataFrame | None:
        """The partial of all years and of the facts without one; None when there is neither."""
        held = self.manifests.newest()[1] if held is None else held
        df = self._read(f"partials/{name}", [f for f in _folders(held) if f.startswith(f"partials/{name}/")])
        return None if df is None else df.drop("load", "fact_hash").withColumn(LOAD_KEY, F.col(LOAD_KEY).cast("int"))

    def mart(self, name: str, flag: str = "has_night_tube") -> DataFrame:
        """The current mart (unordered); None-safe: an empty store gives no rows."""
        if name == "interchange_stations":
            rows = self._interchange(self.manifests.newest()[1])
            return self.spark.createDataFrame([], "station_name string, num_lines bigint") if rows is None else rows
        if name in ("passengers_by_year", "quarterly_trend"):
            keys = ["year"] if name == "passengers_by_year" else ["year", "quarter"]
            base = self.partial("base")
            if base is None:
                return self.spark.createDataFrame(
                    [], ", ".join(f"{k} int" for k in keys) + ", total_passengers bigint")
            q = base.filter(F.col("grain") == "quarter").select(
                F.col(LOAD_KEY).cast("int").alias("year"), F.col("quarter").cast("int").alias("quarter"),
                "total_passengers")
            return q.groupBy(*keys).agg(F.sum("total_passengers").alias("total_passengers"))
        p = self.partial(name)
        if name == "night_tube_analysis":
            if p is None:
                return self.spark.createDataFrame(
                    [], f"{flag} boolean, num_records bigint, total_passengers bigint, "
                        "avg_passengers_per_record double")
            return marts.finish_flag_stats(p, flag)
        keys = ADDITIVE[name]
        if p is None:
            return self.spark.createDataFrame([], T.StructType(
                [T.StructField(k, T.StringType()) for k in keys]
                + [T.StructField("total_passengers", T.LongType())]))
        cast = [F.col(k).cast("int").alias(k) if k in ("year", "quarter") else F.col(k) for k in keys]
        return p.groupBy(*cast).agg(F.sum("total_passengers").alias("total_passengers"))

    def restated(self, name: str, star: Star, flag: str = "has_night_tube") -> DataFrame:
        """A station-derived mart recomputed from the stored per-station partials
        with the dimensions and bridge of ``star`` (e.g. after a station was
        renamed), instead of the dimensions in force when each year was loaded."""
        base = self.partial("base")
        if base is None:
            return self.mart(name, flag)
        st = base.filter(F.col("grain") == "station").groupBy("station_id").agg(
            F.sum("total_passengers").alias("total_passengers"),
            F.sum("num_records").alias("num_records"),
            F.sum("num_measured").alias("num_measured"))
        build = {
            "busiest_stations": lambda: marts.busiest_stations(st, star.stations),
            "passengers_by_line": lambda: marts.passengers_by_line(st, star.bridge, star.lines),
            "passengers_by_network": lambda: marts.passengers_by_network(st, star.stations,
                                                                         star.networks),
            "night_tube_analysis": lambda: marts.night_tube_analysis(st, star.stations, flag),
        }
        return build[name]() if name in build else self.mart(name, flag)

    def marts(self) -> dict[str, DataFrame]:
        return {m: self.mart(m) for m in marts.MART_NAMES}

    def snapshot(self, out: str) -> dict[str, str]:
        """Write every current mart to ``out/<mart>`` (a folder this store never reads)."""
        paths = {}
        for name, df in self.marts().items():
            paths[name] = f"{out.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(paths[name])
        return paths
