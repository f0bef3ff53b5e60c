"""The benchmark times whole queries: nothing that an earlier run stored is read."""

import bench

SF = "/root/testdata/sf0.001"


def test_stores_of_earlier_runs_are_not_read(spark, monkeypatch):
    key, old = (id(spark), SF), object()
    built = {}
    monkeypatch.setitem(bench.registry._UNDATED, key, old)
    monkeypatch.setitem(bench.registry._KEYED, key, old)
    monkeypatch.setitem(bench.registry.QUERIES, "incr_undated_flag_stats", lambda s, d: built.setdefault(
        "undated", bench.registry._undated_store(s, d)).mart("night_tube_analysis"))
    read, whole = bench.run(spark, SF, "incr_undated_flag_stats")
    assert built["undated"] is not old and read == whole
    read, whole = bench.run(spark, SF, "keyed_store_count")
    assert bench.registry._KEYED[key] is not old and read < whole
