"""Structured Streaming jobs over an arrival topic (or files in the same envelope).

* ``start_append``: stateless parse + ingestion stamp, appended as Parquet
  with a checkpoint (exactly-once files).  Every message is kept; rejected ones carry
  their ``reject_reason`` and raw text (``rejected`` reads them), valid ones nulls there.
* ``start_keyed_upsert``: each micro-batch is parsed, enriched and merged into a ``KeyedStore`` by row key,
  which replaces the hash buckets it touches in one commit.  A replayed batch changes nothing: the store
  remembers the last batch of every run, and ``run`` is the query's own id, which a checkpoint keeps and
  a fresh one renews (so batch 0 of a fresh checkpoint, even on the same path, is another batch).  Write
  errors fail the batch (the checkpoint replays it); malformed messages go to ``quarantine/`` instead of
  blocking the stream.
* ``current_rows``: the store's rows, one per row key.
* ``start_dedup_latest``: the latest message per id.  A windowed aggregate keeps the best row of each id
  (combined per task, so a hot id is no hot partition), its state ends with the watermark, and every
  update is merged into a keyed store.
* ``dedup_within``: drops repeated ids inside an event-time horizon (bounded state) and keeps the first seen;
  for consumers that need no later update of a message.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import events as ev
from .keyed import BUCKETS, KeyedStore

INGESTED = "ingested_at"


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"}))


METRICS = "arrival_counts"


def stamped(raw_stream: DataFrame) -> DataFrame:
    # per micro-batch raw / valid / quarantined counts, reported in the query's
    # progress (``lastProgress["observedMetrics"]["arrival_counts"]``), no extra pass
    parsed = ev.parse_arrivals(raw_stream).observe(
        METRICS, F.count(F.lit(1)).alias("raw"), F.count_if(ev.is_valid()).alias("valid"),
        F.count_if(~ev.is_valid()).alias("quarantined"))
    reason = F.when(~ev.is_valid(), ev.reject_reason())
    return (parsed.withColumns({"reject_reason": reason, "raw_value": F.when(~ev.is_valid(), F.col("raw_value"))})
            .drop(ev.CORRUPT_COLUMN).withColumn(INGESTED, F.current_timestamp()))


def rejected(out: DataFrame) -> DataFrame:
    """The rejected messages of an append stream's output, with reason and raw text."""
    return out.filter(F.col("reject_reason").isNotNull()).select(
        *ev.META, F.col("reject_reason").alias("reason"), "raw_value")


def start_append(raw_stream: DataFrame, path: str, checkpoint: str,
                 trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    writer = (stamped(raw_stream).writeStream.format("parquet")
              .outputMode("append").option("path", path)
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()


def batch_counts(query: StreamingQuery) -> list[dict]:
    """Observed counts of each micro-batch still in the query's recent progress."""
    out = []
    for p in query.recentProgress:
        metrics = p.get("observedMetrics") if isinstance(p, dict) else getattr(p, "observedMetrics", None)
        m = (metrics or {}).get(METRICS)
        if m is not None:
            out.append({k: m[k] for k in ("raw", "valid", "quarantined")})
    return out


def run_for(query: StreamingQuery, seconds: float | None) -> None:
    """Bounded run: wait up to ``seconds`` (None = until the trigger finishes), then stop."""
    if seconds is None:
        query.awaitTermination()
    else:
        query.awaitTermination(seconds)
    query.stop()


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query a micro-batch belongs to: kept in its checkpoint, new with a new one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


KEYED_ORDER = ["ingest_time", "kafka_partition", "kafka_offset"]


def keyed_store(spark: SparkSession, root: str, buckets: int = BUCKETS) -> KeyedStore:
    """The store of enriched rows by row key."""
    return KeyedStore(spark, root, "row_key", KEYED_ORDER, buckets)


def keyed_batch_writer(root: str, run_id: str | None = None, buckets: int = BUCKETS):
    root = root.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_id or query_id(batch)
        # two writes read the same micro-batch: keep it (bounded by the trigger's
        # max offsets/bytes) so the source is fetched once per batch
        parsed = ev.parse_arrivals(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (ev.quarantine_rows(parsed).write.mode("overwrite")
             .parquet(f"{root}/quarantine/run={run}/batch_id={batch_id}"))
            keyed_store(batch.sparkSession, root, buckets).apply(ev.enrich(ev.valid_rows(parsed)), run, batch_id)
        finally:
            parsed.unpersist()

    return write


def start_keyed_upsert(raw_stream: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
                       run_id: str | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    writer = (raw_stream.writeStream
              .foreachBatch(keyed_batch_writer(root, run_id, buckets))
              .option("checkpointLocation", checkpoint))
    return _trigger(writer, trigger).start()


def current_rows(spark: SparkSession, root: str) -> DataFrame | None:
    return keyed_store(spark, root).rows()


def latest_store(spark: SparkSession, root: str, buckets: int = BUCKETS) -> KeyedStore:
    """The store of parsed messages by id."""
    return KeyedStore(spark, root, "id", ev.DEDUP_ORDER, buckets)


def start_dedup_latest(raw_stream: DataFrame, root: str, checkpoint: str, horizon: str = "1 hour",
                       trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Latest valid message per id by (ingest time, partition, offset), kept in ``latest_store(root)``.

    Messages later than ``horizon`` behind the newest one are left out, and state older than that is dropped.
    """
    valid = ev.valid_rows(ev.parse_arrivals(raw_stream)).withWatermark("kafka_ingest_time", horizon)
    rest = [c for c in valid.columns if c != "id"]
    best = F.max_by(F.struct(*rest), F.struct(*ev.DEDUP_ORDER))
    found = valid.groupBy(F.window("kafka_ingest_time", horizon), "id").agg(best.alias("b")).select("id", "b.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_store(batch.sparkSession, root, buckets).apply(batch, query_id(batch), batch_id)

    writer = found.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def dedup_within(parsed_stream: DataFrame, horizon: str = "1 hour",
                 event_time: str = "kafka_ingest_time") -> DataFrame:
    return (parsed_stream.withWatermark(event_time, horizon)
            .dropDuplicatesWithinWatermark(["id"]))
