"""A keyed store: one row per key, the latest write wins, in hash buckets that are replaced one by one.

Layout under ``root``:

  manifests/v=N.json                which commit holds each bucket, the last batch of every run
  data/commit=C/bucket=B/           the rows of a bucket, one per key, sorted by key
  staged/commit=C/bucket=B/         what a batch brings, while it is merged

A batch is reduced to the latest row per key, staged by bucket, merged with the old rows of the buckets it touches,
and only those buckets are written anew; others stay where they are.  The manifest is published last
(``plans.commits``), so readers see whole batches, a crash leaves the old rows, and a replayed batch changes
nothing.  Two queries may feed one store: the one that publishes second merges again.  Reading needs no exchange:
a key is in one bucket, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.events import latest_by
from ..plans.commits import Conflict, Manifests, new_id
from ..sources.files import delete_path, subfolders

BUCKETS = 16


def _folders(content: dict):
    return [f"data/commit={commit}/bucket={bucket}" for bucket, commit in content.get("buckets", {}).items()]


class KeyedStore:
    def __init__(self, spark: SparkSession, root: str, key: str, order: list[str], buckets: int = BUCKETS):
        """``order``: greatest wins; ``buckets`` holds for a new store, an old one keeps its number."""
        self.spark, self.root, self.key, self.order, self.buckets = spark, root.rstrip("/"), key, order, buckets
        self.manifests = Manifests(spark, self.root, _folders)

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(n)).cast("int")

    def _read(self, content: dict, buckets=None) -> DataFrame | None:
        folders = [f for f, b in zip(_folders(content), content.get("buckets", {})) if buckets is None or b in buckets]
        if not folders:
            return None
        return (self.spark.read.option("basePath", f"{self.root}/data")
                .parquet(*[f"{self.root}/{f}" for f in folders]).drop("commit"))

    def rows(self) -> DataFrame | None:
        """The current rows; None before the first batch."""
        found = self._read(self.manifests.newest()[1])
        return None if found is None else found.drop("bucket")

    def apply(self, batch: DataFrame, run: str, batch_id: int) -> int:
        """Merge a batch; returns how many buckets were written (0: this batch is in the store)."""
        _, held = self.manifests.newest()
        if held.get("runs", {}).get(run, -1) >= batch_id:
            return 0
        n = held.get("n_buckets", self.buckets)
        staged = f"{self.root}/staged/commit={new_id()}"
        latest = latest_by(batch, [self.key], self.order).withColumn("bucket", self._bucket(n))
        # a task per bucket: its rows meet before they are written
        latest.repartitionById(n, "bucket").write.partitionBy("bucket").parquet(staged)
        touched = [f.rsplit("=", 1)[1] for f in subfolders(self.spark, staged)]
        new = self.spark.read.schema(latest.schema).parquet(staged) if touched else None
        while True:
            version, held = self.manifests.newest()
            if held.get("n_buckets", n) != n:
                raise RuntimeError(f"{self.root} has {held['n_buckets']} buckets; this batch was dealt to {n}")
            commit, content = new_id(), {"buckets": {}, "runs": {}, **held, "n_buckets": n}
            content["runs"] = {**content["runs"], run: batch_id}
            content["buckets"] = {**content["buckets"], **dict.fromkeys(touched, commit)}
            if touched:
                self._merge(new, self._read(held, set(touched)), commit, n)
            try:
                self.manifests.publish(version + 1, content)
            except Conflict:
                delete_path(self.spark, f"{self.root}/data/commit={commit}")
                continue
            self.manifests.retire(version + 1, content, held)
            delete_path(self.spark, staged)
            return len(touched)

    def _merge(self, new: DataFrame, old: DataFrame | None, commit: str, n: int) -> None:
        rows = new if old is None else old.select(*new.columns).unionByName(new)
        # one exchange, by bucket; the aggregate and the sort stay within it
        merged = latest_by(rows.repartitionById(n, "bucket"), ["bucket", self.key], self.order)
        (merged.sortWithinPartitions("bucket", self.key).write.partitionBy("bucket")
         .parquet(f"{self.root}/data/commit={commit}"))

    def vacuum(self, older_than_seconds: float = 86_400) -> list[str]:
        """Remove what crashed batches left behind."""
        return self.manifests.vacuum(["data", "staged"], older_than_seconds)
