"""Message topics as bounded or unbounded sources, and JSON publishing.

The topic connector jar is not part of this environment, so ``topic_reader``
only assembles options; everything downstream takes any frame with the
envelope ``value, partition, offset, timestamp`` -- e.g. ``envelope_files``
over Parquet files holding that envelope, which is how the tests and the
registered queries drive the same code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import MESSAGE_ENVELOPE


def topic_options(servers: str, topic: str, bounded: bool, starting: str | None = None,
                  fail_on_data_loss: bool = True, max_offsets_per_trigger: int | None = None
                  ) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting or ("earliest" if bounded else "latest"),
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if bounded:
        opts["endingOffsets"] = "latest"
    elif max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def topic_reader(spark: SparkSession, servers: str, topic: str, bounded: bool, **kw) -> DataFrame:
    """Bounded (batch, earliest..latest) or unbounded (stream, from latest) topic scan."""
    opts = topic_options(servers, topic, bounded, **kw)
    src = spark.read if bounded else spark.readStream
    return src.format("kafka").options(**opts).load()


def envelope_files(spark: SparkSession, path: str, streaming: bool = False,
                   max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Parquet files in the topic envelope, read as a batch or as a stream in micro-batches of bounded size."""
    if not streaming:
        return spark.read.schema(MESSAGE_ENVELOPE).parquet(path)
    reader = spark.readStream.schema(MESSAGE_ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)


def as_json_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows -> JSON message values (null fields omitted), optionally keyed."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    cols = [value.cast("binary").alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").cast("binary").alias("key"))
    return df.select(*cols)


def publish(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    (as_json_messages(df, key).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
