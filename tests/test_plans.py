"""Plan shape: the raw fact is never shuffled before it is aggregated."""

import pytest
from pyspark.sql import functions as F

from turnstile import adapters
from turnstile import queries as registry
from turnstile.operators import marts
from turnstile.plans import incremental as inc

SF = "/root/testdata/sf0.001"
AGGREGATES = ("HashAggregate", "SortAggregate", "ObjectHashAggregate")
FACT_QUERIES = ["mart_entity_totals", "mart_by_year", "mart_by_line_bridge", "mart_by_network",
                "mart_bridge_degree", "mart_by_year_quarter", "mart_flag_stats", "top10_entities",
                "mart_row_counts", "incoming_years", "years_to_process", "extract_year_slice",
                "incr_flag_stats_mean_of_means"]


def _lines(df):
    # the initial physical plan, before AQE may rewrite joins from runtime sizes
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def _depth(line):
    return next((i for i, ch in enumerate(line) if ch.isalpha() or ch == "*"), len(line))


def raw_fact_shuffles(df, table="lineitem.parquet"):
    """Exchanges reached from a fact scan without passing an aggregate."""
    lines = _lines(df)
    bad = []
    for i, line in enumerate(lines):
        if "Scan parquet" not in line or table not in line:
            continue
        d, j = _depth(line), i
        while j > 0:
            j -= 1
            if _depth(lines[j]) < d:
                d = _depth(lines[j])
                if any(a in lines[j] for a in AGGREGATES):
                    break
                if "Exchange" in lines[j]:
                    bad.append(lines[j].strip())
                    break
    return bad


@pytest.mark.parametrize("name", FACT_QUERIES)
def test_registered_query_aggregates_fact_before_shuffle(spark, name):
    assert raw_fact_shuffles(registry.QUERIES[name](spark, SF)) == []


def test_load_aggregates_fact_before_shuffle(spark, tmp_root):
    star = adapters.test_star(spark, SF)
    store = inc.MartStore(spark, tmp_root)
    dated = store.gated_facts(star, "c-test")
    agg = dated.groupingSets([[inc.LOAD_KEY, "station_id"], [inc.LOAD_KEY, "quarter"]],
                             inc.LOAD_KEY, "station_id", "quarter").agg(F.sum("total_entry_exit"))
    assert raw_fact_shuffles(agg) == []
    assert raw_fact_shuffles(marts.station_and_date_totals(star.fact)) == []


def test_checker_sees_a_raw_shuffle(spark):
    li = adapters.table(spark, SF, "lineitem")
    assert raw_fact_shuffles(li.repartition(4, "l_suppkey"))


def test_bounded_join_falls_back_above_the_bound(spark):
    from turnstile.operators import joins
    star = adapters.test_star(spark, SF)
    days = star.dates.select("date_id", "year")
    small = joins.join_bounded(star.fact, days, "date_id", max_rows=10_000)
    big = joins.join_bounded(star.fact, days, "date_id", max_rows=10)   # bound fails: no broadcast
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()
    outer = joins.join_bounded(star.fact, days, "date_id", "left", max_rows=10)
    assert "broadcast" not in outer._jdf.queryExecution().analyzed().toString().lower()
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    assert joins.bound_holds(days, 10_000) and not joins.bound_holds(days, 10)
    # few rows, many bytes: not broadcast either
    wide = days.withColumn("note", F.repeat(F.lit("x"), 1000))
    assert joins.bound_holds(wide, 10_000) and not joins.bound_holds(wide, 10_000, max_bytes=500_000)
    fat = joins.join_bounded(star.fact, wide, "date_id", max_bytes=500_000)
    assert fat.drop("note").count() == small.count()


def _exchanged_rows(df):
    """Rows that the shuffles of an executed frame wrote, by what they were read from."""
    df.collect()
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.length()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_bloom_filter_goes_before_the_shuffle(spark):
    """A key set above the bound: the fact is reduced map-side, the rows are those of the broadcast form."""
    from turnstile.operators import joins
    li = adapters.table(spark, "/root/testdata/sf0.01", "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    keys = (adapters.table(spark, "/root/testdata/sf0.01", "orders").filter("o_custkey % 50 = 0")
            .select(F.col("o_orderkey").alias("l_orderkey")))
    plain = li.join(keys.hint("merge"), "l_orderkey", "left_semi")
    for how in ("left_semi", "inner"):
        reduced = joins.join_bounded(li, keys.hint("merge"), "l_orderkey", how, max_rows=10)
        small = joins.join_bounded(li, keys, "l_orderkey", how)
        assert sorted(map(tuple, reduced.collect())) == sorted(map(tuple, small.collect()))
    n, want = li.count(), plain.count()
    before, after = max(_exchanged_rows(plain)), max(_exchanged_rows(joins.join_bounded(
        li, keys.hint("merge"), "l_orderkey", "left_semi", max_rows=10)))
    assert before == n and after < want + 0.03 * n  # one false key in a hundred
    assert joins.join_bounded(li, keys.limit(0), "l_orderkey", "inner", max_rows=-1).count() == 0


def test_gate_prunes_periods(spark, tmp_root):
    """The increment joins a fact stored by period with the open years: other periods' files are not opened."""
    from turnstile.plans import periods
    from turnstile.sources.files import delete_path
    star = adapters.test_star(spark, SF)
    periods.write_by_period(star, tmp_root + "/fact")
    store = inc.MartStore(spark, tmp_root + "/store")
    store.load(adapters.full_star(spark, SF))
    stored = star.with_fact(periods.read_by_period(spark, tmp_root + "/fact"))
    gated = store.gated_facts(stored, "c-plan", held=store.manifests.newest()[1])
    assert "dynamicpruning" in gated._jdf.queryExecution().executedPlan().toString().lower()
    for year in range(1995, 2001):  # the frame lists these files; opening one would fail
        assert delete_path(spark, f"{tmp_root}/fact/period={year}")
    assert [r[0] for r in store.load(stored).years.collect()] == [2001]
    whole = marts.mart(star, "busiest_stations")
    assert sorted(map(tuple, store.mart("busiest_stations").collect())) == sorted(map(tuple, whole.collect()))
