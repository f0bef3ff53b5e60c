"""Session defaults and the shared scratch location.

Jobs never write to a machine-local temporary folder: scratch output lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent and Spark runs in one process (unit tests, a laptop) do
we create one; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE re-plans joins from
# runtime sizes, coalesces small shuffle partitions and splits skewed join
# partitions.  Broadcasts: the planner's static choice works from file-size
# estimates (compressed bytes on disk, not a bound on the rows), so it is
# off; a join side is broadcast only after AQE has measured its shuffle
# output below the adaptive threshold.  Every fact side reaching a join is
# already hash-partitioned on the join key by its pre-aggregate, so the
# sort-merge fallback shuffles only the dimension.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "turnstile",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set one only if unset."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="turnstile-ckpt-")  # one machine, one process
    sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/turnstile-work/{name}-{uuid.uuid4().hex[:12]}"
