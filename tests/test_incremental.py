"""Ledger-gated incremental loads: invariants from the survey's test strategy."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from star_fixture import as_set, small_star
from turnstile import adapters
from turnstile.operators import keysets, marts
from turnstile.plans import commits
from turnstile.plans import incremental as inc
from turnstile.sources import files
from turnstile.star import Star

SF = "/root/testdata/sf0.001"


def split_star(spark):
    """Whole-table dims and bridge, fact split at the year boundary (unchanged dims)."""
    whole = adapters.test_star(spark, SF)
    full = whole.with_fact(adapters.fact_from_lineitem(adapters.period_lineitem(spark, SF, last_year=2000)))
    incr = whole.with_fact(adapters.fact_from_lineitem(adapters.period_lineitem(spark, SF, first_year=2001)))
    return whole, full, incr


def store_marts(store):
    return {m: as_set(store.mart(m)) for m in marts.MART_NAMES}


def recompute(star):
    return {m: as_set(marts.mart(star, m)) for m in marts.MART_NAMES}


def test_full_plus_increment_equals_recompute(spark, tmp_root):
    whole, full, incr = split_star(spark)
    store = inc.MartStore(spark, tmp_root)
    r1 = store.load(full)
    assert r1.loaded and sorted(r[0] for r in r1.years.collect()) == list(range(1995, 2001))
    r2 = store.load(incr)
    assert [r[0] for r in r2.years.collect()] == [2001]
    assert store_marts(store) == recompute(whole)
    ledger = sorted(r["processed_year"] for r in store.ledger().collect())
    assert ledger == list(range(1995, 2002))


def test_rerun_changes_nothing(spark, tmp_root):
    whole, full, incr = split_star(spark)
    store = inc.MartStore(spark, tmp_root)
    store.load(full)
    store.load(incr)
    before = store_marts(store)
    again = store.load(incr)
    assert not again.loaded
    assert store_marts(store) == before
    assert store.ledger().count() == 7


def test_reload_replaces_not_adds(spark, tmp_root):
    whole, full, incr = split_star(spark)
    store = inc.MartStore(spark, tmp_root)
    store.load(full)
    store.load(incr)
    store.load(incr, reload=True)
    assert store_marts(store) == recompute(whole)


def test_loads_commute(spark, tmp_root):
    whole, full, incr = split_star(spark)
    a = inc.MartStore(spark, tmp_root + "/a")
    a.load(full)
    a.load(incr)
    b = inc.MartStore(spark, tmp_root + "/b")
    b.load(incr)
    b.load(full)
    assert store_marts(a) == store_marts(b)


def test_crash_before_ledger_then_rerun(spark, tmp_root, monkeypatch):
    whole, full, incr = split_star(spark)
    store = inc.MartStore(spark, tmp_root)
    store.load(full)

    def boom(*a, **k):
        raise RuntimeError("crash between mart write and ledger append")

    monkeypatch.setattr(inc, "ledger_rows", boom)
    with pytest.raises(RuntimeError):
        store.load(incr)
    monkeypatch.undo()
    store.load(incr)
    assert store_marts(store) == recompute(whole)


def test_interchange_replace_by_key(spark, tmp_root):
    st = spark.createDataFrame([(1, "A", 1, True), (2, "B", 1, True), (3, None, 1, True)],
                               "station_id int, station_name string, network_id int, has_night_tube boolean")
    empty_fact = spark.createDataFrame([], "entry_exit_id bigint, station_id int, date_id int, total_entry_exit bigint")
    base = dict(fact=empty_fact, dates=spark.createDataFrame([], "date_id int, year int, quarter int"),
                stations=st, networks=spark.createDataFrame([], "network_id int, network_name string, network_type string"),
                lines=spark.createDataFrame([], "line_id int, line_name string"))
    b1 = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "station_id int, line_id int")
    b2 = spark.createDataFrame([(1, 1)], "station_id int, line_id int")
    store = inc.MartStore(spark, tmp_root)
    store.load(Star(bridge=b1, **base))
    store.load(Star(bridge=b2, **base))
    # A replaced by the newer batch; B and the null-named station kept
    assert as_set(store.mart("interchange_stations")) == {("A", 1), ("B", 1), (None, 1)}


def test_key_set_operators_keep_null_keys(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(2,)], "k int")
    assert sorted(as_set(keysets.drop_keys_in(rows, keys, "k")), key=str) == sorted({(1,), (None,)}, key=str)
    assert as_set(keysets.only_keys_in(rows, keys, "k")) == {(2,)}
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert as_set(keysets.replace_by_key(old, new, "k")) == {("a", 1), ("b", 3), ("c", 4)}


def test_years_to_process_is_a_dataframe_difference(spark):
    whole, full, incr = split_star(spark)
    ledger = inc.ledger_rows(inc.incoming_years(full))
    todo = inc.years_to_process(inc.incoming_years(whole), ledger)
    assert [r[0] for r in todo.collect()] == [2001]
    assert F is not None


def test_restate_with_current_dimensions(spark, tmp_root):
    whole, full, incr = split_star(spark)
    store = inc.MartStore(spark, tmp_root)
    store.load(full)
    store.load(incr)
    # same dimensions: restated == as loaded
    assert as_set(store.restated("busiest_stations", whole)) == as_set(store.mart("busiest_stations"))
    # a renamed station: restated marts use the new name for every year
    renamed = whole.stations.withColumn(
        "station_name", F.when(F.col("station_id") == 1, F.lit("Renamed")).otherwise(F.col("station_name")))
    new = Star(fact=whole.fact, dates=whole.dates, stations=renamed, networks=whole.networks,
               lines=whole.lines, bridge=whole.bridge)
    names = {r[0] for r in store.restated("busiest_stations", new).collect()}
    assert "Renamed" in names and "Renamed" not in {r[0] for r in store.mart("busiest_stations").collect()}


def test_reload_of_an_emptied_year_removes_it(spark, tmp_root):
    whole, full, incr = split_star(spark)
    store = inc.MartStore(spark, tmp_root)
    store.load(full)
    store.load(incr)
    # corrected 2001 feed: the dates are there, the facts are gone
    emptied = incr.with_fact(incr.fact.limit(0))
    store.load(emptied, reload=True)          # nothing incoming: 2001 stays as it was
    assert 2001 in {r["year"] for r in store.mart("passengers_by_year").collect()}
    store.load(emptied, reload=True, clear_years=[2001])
    years = {r["year"] for r in store.mart("passengers_by_year").collect()}
    assert 2001 not in years and years == set(range(1995, 2001))
    assert as_set(store.mart("busiest_stations")) == as_set(marts.mart(full, "busiest_stations"))


def test_facts_without_a_year_add_up(spark, tmp_root):
    star = small_star(spark)
    fact = "entry_exit_id bigint, station_id int, date_id int, total_entry_exit bigint"
    first = star.with_fact(spark.createDataFrame([(1, 1, 100, 100), (2, 1, 999, 50), (3, 2, 100, 7), (4, 2, None, 5)], fact))
    second = star.with_fact(spark.createDataFrame([(5, 1, 200, 1), (6, 1, 999, 30)], fact))
    store = inc.MartStore(spark, tmp_root)
    assert store.load(first).undated == 2
    assert as_set(store.mart("busiest_stations")) == {("Angel", 150), ("Bank", 12)}
    assert store.load(second).undated == 1
    assert as_set(store.mart("busiest_stations")) == {("Angel", 181), ("Bank", 12)}
    assert not store.load(second).loaded
    assert as_set(store.mart("busiest_stations")) == {("Angel", 181), ("Bank", 12)}
    assert as_set(store.mart("passengers_by_year")) == {(2020, 107), (2021, 1)}
    assert None not in {r["processed_year"] for r in store.ledger().collect()}


def test_undated_batches_of_equal_totals_both_count(spark, tmp_root):
    star = small_star(spark)
    fact = "entry_exit_id bigint, station_id int, date_id int, total_entry_exit bigint"
    monday = star.with_fact(spark.createDataFrame([(1, 1, 999, 50)], fact))
    tuesday = star.with_fact(spark.createDataFrame([(2, 1, 998, 50)], fact))
    store = inc.MartStore(spark, tmp_root)
    assert store.load(monday).undated == store.load(tuesday).undated == 1
    assert as_set(store.mart("busiest_stations")) == {("Angel", 100)}
    assert not store.load(monday).loaded and not store.load(tuesday).loaded
    # with a dated fact beside it the batch is neither dropped nor written over an equal one
    mixed = star.with_fact(spark.createDataFrame([(3, 1, 997, 50), (4, 2, 100, 7)], fact))
    assert store.load(mixed).undated == 1
    assert as_set(store.mart("busiest_stations")) == {("Angel", 150), ("Bank", 7)}


WRITES = ["base", "busiest_stations", "passengers_by_line", "passengers_by_network", "night_tube_analysis",
          "ledger", "interchange", "bridge", "dates", "manifests"]


class FailingStore(inc.MartStore):
    """A store whose write of one folder fails."""

    failing = ""

    def _write(self, df, path, by=None):
        super()._write(df, path, by)  # the folder is there, its load is not
        if f"/{self.failing}/" in path:
            raise RuntimeError("crash")


@pytest.mark.parametrize("table", WRITES)
def test_a_crash_at_any_write_changes_nothing(spark, tmp_root, monkeypatch, table):
    star = small_star(spark)
    fact = "entry_exit_id bigint, station_id int, date_id int, total_entry_exit bigint"
    first = star.with_fact(spark.createDataFrame([(1, 1, 100, 100), (2, 1, 999, 50)], fact))
    second = star.with_fact(spark.createDataFrame([(5, 1, 200, 1), (6, 1, 998, 30)], fact))
    store = FailingStore(spark, tmp_root)
    store.load(first)
    before, version = store_marts(store), store.manifests.version()
    for attempt in (lambda: store.load(second), lambda: store.replace(second)):
        if table == "manifests":
            monkeypatch.setattr(store.manifests, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        store.failing = table
        with pytest.raises(RuntimeError, match="crash"):
            attempt()
        store.failing = ""
        monkeypatch.undo()
        assert store.manifests.version() == version and store_marts(store) == before
    assert store.load(second).undated == 1  # the retry loads all of it
    assert as_set(store.mart("busiest_stations")) == {("Angel", 181)}
    assert store.vacuum(0) and as_set(store.mart("busiest_stations")) == {("Angel", 181)}
    assert not store.vacuum(0)


def test_two_loaders_cannot_share_a_version(spark, tmp_root, monkeypatch):
    star = small_star(spark)
    fact = "entry_exit_id bigint, station_id int, date_id int, total_entry_exit bigint"
    one, both = ([(1, 1, 100, 10), (2, 1, 999, 5)], [(1, 1, 100, 10), (2, 1, 999, 5), (3, 2, 200, 7)])
    a, b = inc.MartStore(spark, tmp_root), inc.MartStore(spark, tmp_root)
    publish, raced = a.manifests.publish, []

    def overtaken(version, content):
        if not raced:
            raced.append(b.load(replace(star, fact=spark.createDataFrame(one, fact), bridge=spark.createDataFrame(
                [(1, 10), (1, 11)], "station_id int, line_id int"))))
        publish(version, content)

    monkeypatch.setattr(a.manifests, "publish", overtaken)
    mine = a.load(star.with_fact(spark.createDataFrame(both, fact)))
    assert raced[0].version == 1 and mine.version == 2
    # 2020 and the undated fact came with the other load; they count once
    assert [r[0] for r in mine.years.collect()] == [2021]
    assert as_set(a.mart("busiest_stations")) == {("Angel", 15), ("Bank", 7)}
    assert as_set(a.mart("passengers_by_year")) == {(2020, 10), (2021, 7)}
    # the interchange mart was merged on top of the other load's
    assert as_set(a.mart("interchange_stations")) == {("Angel", 1), ("Bank", 3), ("Oval", 1)}
    with pytest.raises(commits.Conflict):
        publish(2, {})


def test_old_versions_are_folded(spark, tmp_root):
    star = small_star(spark)
    fact = "entry_exit_id bigint, station_id int, date_id int, total_entry_exit bigint"
    store = inc.MartStore(spark, tmp_root)
    for n in range(5):
        store.load(star.with_fact(spark.createDataFrame([(n, 1, 100, n)], fact)), reload=True)
        assert as_set(store.mart("busiest_stations")) == {("Angel", n)}
    assert store.manifests.version() == 5
    for table in ("manifests", "interchange", "bridge", "partials/base", "partials/busiest_stations"):
        held = [f for f in files.subfolders(spark, f"{tmp_root}/{table}") if files.has_data_files(spark, f)]
        assert len(held) <= 2, table
    assert not files.path_exists(spark, f"{tmp_root}/manifests/v=3.json")
    # readers of the version before still find their files
    assert store.partial("base", store.manifests.read(4)).agg(F.sum("total_passengers")).first()[0] == 6


def test_signed_corrections_equal_a_recomputation(spark, tmp_root):
    star = small_star(spark)
    fact = "entry_exit_id bigint, station_id int, date_id int, total_entry_exit bigint"
    store = inc.MartStore(spark, tmp_root)
    with pytest.raises(ValueError):
        store.correct(star.with_fact(star.fact.withColumn("sign", F.lit(1))))
    store.load(star)
    # 1 corrected, 3 withdrawn, 5 measured at last, 8 (undated) moved to a date, 9 new; 10 belongs to a year to come
    rows = [(1, 1, 100, 10, -1), (1, 1, 100, 15, 1), (3, 2, 100, 5, -1), (5, 4, 200, None, -1), (5, 4, 200, 6, 1),
            (8, 1, 999, 1, -1), (8, 1, 101, 1, 1), (9, 2, 200, 50, 1), (10, 1, 300, 99, 1)]
    dates = star.dates.unionByName(spark.createDataFrame([(300, 2022, 1)], "date_id int, year int, quarter int"))
    store.correct(replace(star, fact=spark.createDataFrame(rows, fact + ", sign int"), dates=dates))
    now = [(1, 1, 100, 15), (2, 1, 200, 20), (4, 3, 101, 7), (5, 4, 200, 6), (6, 4, 101, 3), (7, 9, 100, 100), (8, 1, 101, 1),
           (9, 2, 200, 50)]
    corrected = star.with_fact(spark.createDataFrame(now, fact))
    assert store_marts(store) == recompute(corrected)
    # a station leaves a line and joins another: all facts count by the new bridge
    bridge = spark.createDataFrame([(1, 11), (2, 11), (2, 12), (3, 11), (4, 10)], "station_id int, line_id int")
    store.rebridge(replace(star, bridge=bridge))
    assert as_set(store.mart("passengers_by_line")) == as_set(marts.mart(replace(corrected, bridge=bridge), "passengers_by_line"))
    assert as_set(store.mart("busiest_stations")) == as_set(marts.mart(corrected, "busiest_stations"))
    # a year loaded again replaces its partials and their corrections
    store.load(star, reload=True)
    assert {r["year"]: r["total_passengers"] for r in store.mart("passengers_by_year").collect()} == {2020: 125, 2021: 20}
