"""Streaming == batch, restart adds nothing, keyed upsert replay is idempotent."""

import datetime as dt
import pathlib

import pytest

from turnstile import adapters
from turnstile.operators import events as ev
from turnstile.sources import messages
from turnstile.streaming import arrivals as stream
from turnstile.streaming import keyed
from turnstile.streaming.timed import run_timed

SF = "/root/testdata/sf0.001"


def _topic(spark, root):
    adapters.arrival_messages(spark, SF).repartitionByRange(4, "offset") \
        .write.mode("overwrite").parquet(root + "/topic")
    return root + "/topic"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_append_equals_batch_and_restart_adds_nothing(spark, tmp_root):
    topic = _topic(spark, tmp_root)
    for _ in range(2):  # second run resumes from the checkpoint: no new files, no new rows
        src = messages.envelope_files(spark, topic, streaming=True, max_files_per_trigger=1)
        q = stream.start_append(src, tmp_root + "/out", tmp_root + "/ckpt", {"availableNow": True})
        stream.run_for(q, None)
    got = spark.read.parquet(tmp_root + "/out").drop("ingested_at")
    assert _rows(stream.rejected(got)) == _rows(ev.quarantine_rows(ev.parse_arrivals(messages.envelope_files(spark, topic))))
    want = ev.parse_arrivals(messages.envelope_files(spark, topic)).drop("raw_value", ev.CORRUPT_COLUMN)
    assert _rows(got.select(*want.columns)) == _rows(want)


def test_keyed_upsert_replay_is_idempotent(spark, tmp_root):
    topic = _topic(spark, tmp_root)
    for _ in range(2):
        src = messages.envelope_files(spark, topic, streaming=True, max_files_per_trigger=1)
        q = stream.start_keyed_upsert(src, tmp_root + "/store", tmp_root + "/ckpt", {"availableNow": True})
        stream.run_for(q, None)
    cur = stream.current_rows(spark, tmp_root + "/store")
    batch = ev.keyed_latest(ev.enrich(ev.valid_rows(ev.parse_arrivals(messages.envelope_files(spark, topic)))))
    assert _rows(cur) == _rows(batch.select(*cur.columns))
    quarantined = spark.read.parquet(tmp_root + "/store/quarantine").count()
    assert quarantined == ev.quarantine_rows(ev.parse_arrivals(messages.envelope_files(spark, topic))).count()


KEYED = "row_key string, v int, ingest_time timestamp, kafka_partition int, kafka_offset bigint"


def _writes(spark, rows):
    return spark.createDataFrame([(k, v, dt.datetime(2020, 1, 1, 0, 0, t), 0, t) for k, v, t in rows], KEYED)


def test_a_batch_rewrites_its_buckets_only(spark, tmp_root):
    store = stream.keyed_store(spark, tmp_root, buckets=8)
    keys = [f"k{i}" for i in range(400)]
    assert store.rows() is None
    assert store.apply(_writes(spark, [(k, 1, 10) for k in keys]), "r", 0) == 8
    version, first = store.manifests.newest()
    size = {f: sum(p.stat().st_size for p in pathlib.Path(tmp_root, f).glob("part-*")) for f in keyed._folders(first)}
    # one key, written twice in the batch and once late: its bucket alone is written, the latest row wins
    assert store.apply(_writes(spark, [("k7", 2, 11), ("k7", 3, 12), ("k7", 9, 3)]), "r", 1) == 1
    _, second = store.manifests.newest()
    changed = set(keyed._folders(second)) - set(keyed._folders(first))
    assert len(changed) == 1 and len(set(keyed._folders(second)) & set(size)) == 7
    written = sum(p.stat().st_size for p in pathlib.Path(tmp_root, *changed).glob("part-*"))
    assert written < sum(size.values()) / 4
    rows = {r["row_key"]: r["v"] for r in store.rows().collect()}
    assert len(rows) == 400 and rows.pop("k7") == 3 and set(rows.values()) == {1}
    # a replayed batch changes nothing; a batch without rows is remembered
    assert store.apply(_writes(spark, [("k7", 5, 59)]), "r", 1) == 0
    assert store.apply(_writes(spark, []), "r", 2) == 0 and store.manifests.newest()[1]["runs"] == {"r": 2}
    plan = store.rows().groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert store.rows()._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0 and plan.count("Exchange") == 1
    # a key without a value is a key; keys of a store keep their number of buckets
    stream.keyed_store(spark, tmp_root, buckets=3).apply(_writes(spark, [(None, 4, 13)]), "s", 0)
    assert store.rows().filter("row_key IS NULL").count() == 1 and store.rows().count() == 401


def test_two_queries_feed_one_store(spark, tmp_root, monkeypatch):
    a, b = (stream.keyed_store(spark, tmp_root, buckets=2) for _ in range(2))
    publish, raced = a.manifests.publish, []

    def overtaken(version, content):
        if not raced:
            raced.append(b.apply(_writes(spark, [("x", 1, 1), ("y", 2, 9)]), "b", 0))
        publish(version, content)

    monkeypatch.setattr(a.manifests, "publish", overtaken)
    a.apply(_writes(spark, [("x", 3, 5), ("y", 4, 5), ("z", 5, 5)]), "a", 0)
    assert {(r["row_key"], r["v"]) for r in a.rows().collect()} == {("x", 3), ("y", 2), ("z", 5)}
    assert a.manifests.newest()[1]["runs"] == {"a": 0, "b": 0} and a.manifests.version() == 2


def test_crashed_batch_leaves_the_old_rows(spark, tmp_root, monkeypatch):
    store = stream.keyed_store(spark, tmp_root, buckets=2)
    store.apply(_writes(spark, [("x", 1, 1)]), "r", 0)
    monkeypatch.setattr(store.manifests, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        store.apply(_writes(spark, [("x", 2, 2)]), "r", 1)
    monkeypatch.undo()
    assert [r["v"] for r in store.rows().collect()] == [1]
    store.apply(_writes(spark, [("x", 2, 2)]), "r", 1)
    assert [r["v"] for r in store.rows().collect()] == [2] and store.vacuum(0)


def test_stream_keeps_the_latest_row_per_id(spark, tmp_root):
    topic = _topic(spark, tmp_root)
    src = messages.envelope_files(spark, topic, streaming=True, max_files_per_trigger=1)
    q = stream.start_dedup_latest(src, tmp_root + "/latest", tmp_root + "/ckpt", "2 days", {"availableNow": True})
    q.awaitTermination()
    state = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    q.stop()
    got = stream.latest_store(spark, tmp_root + "/latest").rows()
    want = ev.dedup_arrivals(ev.valid_rows(ev.parse_arrivals(messages.envelope_files(spark, topic))))
    assert _rows(got.select(*want.columns)) == _rows(want) and len(state) >= 4
    # the files are in time order: windows that the watermark passed are dropped from the state
    assert state[-1]["numRowsTotal"] < sum(s["numRowsUpdated"] for s in state) / 2


def test_timed_run_ends_after_a_whole_batch(spark, tmp_root):
    topic = _topic(spark, tmp_root)
    total = messages.envelope_files(spark, topic).count()

    def start():
        src = messages.envelope_files(spark, topic, streaming=True, max_files_per_trigger=1)
        return stream.start_append(src, tmp_root + "/out", tmp_root + "/ckpt", {"processingTime": "1 second"})

    first = run_timed(spark, start, seconds=1.5)
    assert first.ended == "deadline" and sum(first.batches.values()) == first.rows
    # what was counted is what was written: no batch was cut
    assert spark.read.parquet(tmp_root + "/out").count() == first.rows if first.rows else True
    second = run_timed(spark, start, seconds=120, idle_seconds=2.5)
    assert second.ended == "idle" and first.rows + second.rows == total
    assert spark.read.parquet(tmp_root + "/out").count() == total
    assert not set(first.batches) & set(second.batches)


def test_stream_dedup_within_horizon(spark, tmp_root):
    topic = _topic(spark, tmp_root)
    src = messages.envelope_files(spark, topic, streaming=True, max_files_per_trigger=1)
    parsed = ev.parse_arrivals(src).filter(ev.is_valid()).drop("raw_value", ev.CORRUPT_COLUMN)
    q = (stream.dedup_within(parsed, "365 days").writeStream.format("parquet")
         .option("path", tmp_root + "/dedup").option("checkpointLocation", tmp_root + "/dckpt")
         .trigger(availableNow=True).start())
    stream.run_for(q, None)
    out = spark.read.parquet(tmp_root + "/dedup")
    n_ids = ev.valid_rows(ev.parse_arrivals(messages.envelope_files(spark, topic))).select("id").distinct().count()
    assert out.count() == n_ids == out.select("id").distinct().count()


def test_stream_reports_counts_per_batch(spark, tmp_root):
    topic = _topic(spark, tmp_root)
    src = messages.envelope_files(spark, topic, streaming=True, max_files_per_trigger=2)
    q = stream.start_append(src, tmp_root + "/out", tmp_root + "/ckpt", {"availableNow": True})
    q.awaitTermination()
    counts = stream.batch_counts(q)
    q.stop()
    assert len(counts) == 2
    assert sum(c["raw"] for c in counts) == messages.envelope_files(spark, topic).count()
    assert all(c["raw"] == c["valid"] + c["quarantined"] for c in counts)


def test_the_batches_of_a_topic_do_not_grow_in_number_with_it(spark, tmp_root):
    from turnstile import queries

    raw = spark.range(60_000).selectExpr("to_json(struct(uuid() AS id, uuid() AS vehicleId, id AS timeToStation)) AS v", "id")
    rows = raw.selectExpr("CAST(v AS binary) AS value", "CAST(id % 4 AS int) AS partition", "id AS offset",
                          "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS timestamp")
    rows.repartition(32).write.parquet(f"{tmp_root}/topic")
    size = sum(p.stat().st_size for p in pathlib.Path(tmp_root, "topic").glob("part-*"))
    assert size > 12 * queries.TOPIC_BYTES  # so many batches of the least size
    queries._upsert(spark, f"{tmp_root}/topic", tmp_root)
    store = stream.keyed_store(spark, f"{tmp_root}/store")
    held = store.manifests.newest()[1]
    batches = max(held["runs"].values()) + 1
    assert 2 <= batches <= 2 * queries.TOPIC_BATCHES
    assert store.rows().count() == 60_000


def test_a_task_merges_one_bucket(spark, tmp_root, monkeypatch):
    store, seen = stream.keyed_store(spark, tmp_root, buckets=16), []
    write = keyed.latest_by

    def watched(rows, keys, order):
        from pyspark.sql import functions as F
        if "bucket" in keys:
            seen.append(rows.groupBy(F.spark_partition_id()).agg(F.countDistinct("bucket").alias("n")).agg(F.max("n")).first()[0])
        return write(rows, keys, order)

    monkeypatch.setattr(keyed, "latest_by", watched)
    store.apply(_writes(spark, [(f"k{i}", 1, 10) for i in range(400)]), "r", 0)
    store.apply(_writes(spark, [(f"k{i}", 2, 11) for i in range(400)]), "r", 1)
    assert seen == [1, 1] and {r["v"] for r in store.rows().collect()} == {2}
