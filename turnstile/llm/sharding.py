"""Hierarchical weighted hash tree: place rows by descending region, rack and shard.

At each level every child of the node reached so far draws ``-ln(u) / weight``
with ``u`` hashed from (row key, child name), and the row goes to the child with
the smallest draw.  A child's draw does not depend on its siblings, so changing
weights moves rows only into or out of the subtrees whose weights change.  A new
shard that opens its own region changes no other draw: rows move only into it.

Defined results: a null key is drawn like the text ``null``; equal keys land
together; a null text has size 16 and the checksum of no bytes; an empty table
gives no rows.  Input columns are read by name and extra ones are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, digest_number, gapless

SEED = "tree-1"
HEADER_BYTES = 16


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def uniform_tree(n_shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> list[Leaf]:
    """Shards 0..n-1 filled region by region; racks are numbered within the whole tree."""
    return [Leaf(s // (racks_per_region * shards_per_rack), s // shards_per_rack, s) for s in range(n_shards)]


def with_new_region(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard in a region and rack of its own."""
    return [*tree, Leaf(max(x.region for x in tree) + 1, max(x.rack for x in tree) + 1,
                        max(x.shard for x in tree) + 1, weight)]


def _children(tree: list[Leaf], parent: str, child: str) -> dict[int, dict[int, float]]:
    out: dict[int, dict[int, float]] = defaultdict(lambda: defaultdict(float))
    for leaf in tree:
        out[getattr(leaf, parent) if parent else 0][getattr(leaf, child)] += leaf.weight
    return out


def _draw(key: Column, level: str, node: Column, weight: Column) -> Column:
    unit = (digest_number(F.lit(SEED), key, F.lit(level), node) + 1) / F.lit(float(2 ** 52))
    return -F.log(unit) / weight


def _descend(key: Column, level: str, children: dict[int, dict[int, float]], parent: Column | None) -> Column:
    """The child with the smallest draw among the children of ``parent`` (ties: smaller number)."""
    def options(nodes: dict[int, float]) -> Column:
        return F.array(*[F.struct(F.lit(n).alias("node"), F.lit(w).alias("weight"))
                         for n, w in sorted(nodes.items()) if w > 0])

    if parent is None:
        choice = options(children[0])
    else:
        choice = F.element_at(F.map_from_arrays(F.array(*[F.lit(p) for p in sorted(children)]),
                                                F.array(*[options(children[p]) for p in sorted(children)])), parent)
    drawn = F.transform(choice, lambda c: F.struct(_draw(key, level, c["node"], c["weight"]).alias("draw"),
                                                   c["node"].alias("node")))
    return F.array_min(drawn)["node"]


def place(df: DataFrame, key: str, tree: list[Leaf], prefix: str = "") -> DataFrame:
    """Add ``{prefix}region``, ``{prefix}rack`` and ``{prefix}shard``; tree size is a parameter, not data."""
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    region, rack, shard = f"{prefix}region", f"{prefix}rack", f"{prefix}shard"
    df = df.withColumn(region, _descend(name, "region", _children(tree, "", "region"), None))
    df = df.withColumn(rack, _descend(name, "rack", _children(tree, "region", "rack"), F.col(region)))
    return df.withColumn(shard, _descend(name, "shard", _children(tree, "rack", "shard"), F.col(rack)))


def shard_documents(docs: DataFrame, n_shards: int = 40, tree: list[Leaf] | None = None) -> DataFrame:
    """Place documents in the shards of ``tree``; slots number each shard's rows from 0.

    Keeps the texts: write the result partitioned by ``shard``.  ``grown_shard`` is
    the shard after one more has opened a region of its own.
    """
    tree = tree or uniform_tree(n_shards)
    grown = with_new_region(tree)
    rows = docs.select("doc_id", "text")
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = (rows.withColumn("size", F.octet_length(body).cast("long") + HEADER_BYTES)
            .withColumn("text_crc32", F.crc32(body)))
    placed = place(rows, "doc_id", tree)
    # only the region level of the grown tree differs: a row moves iff the new region wins
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    top = _descend(name, "region", _children(grown, "", "region"), None)
    placed = placed.withColumn("grown_shard", F.when(top == grown[-1].region, F.lit(grown[-1].shard))
                               .otherwise(F.col("shard")))
    return gapless(placed, "shard", "doc_id", "slot", buckets_for(docs.count()), ["text_crc32"])


def op1_hash_tree_sharding(docs: DataFrame) -> DataFrame:
    out = shard_documents(docs, 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
                      "region", "rack")


def oracle_sql(n_shards: int = 40, bucket_rows: int = 4096) -> str:
    """The same placement as plain joins against the list of nodes."""
    def nodes(rows) -> str:
        return "(VALUES " + ", ".join(str(tuple(r)) for r in rows) + ")"

    tree = with_new_region(uniform_tree(n_shards))
    regions = _children(tree, "", "region")[0]
    racks = [(p, c, w) for p, cs in _children(tree, "region", "rack").items() for c, w in cs.items()]
    shards = [(p, c, w) for p, cs in _children(tree, "rack", "shard").items() for c, w in cs.items()]
    new = tree[-1]

    def draw(level: str) -> str:
        return (f"-ln((('0x' || substr(md5(concat_ws(':', '{SEED}', d.name, '{level}', n.node)), 1, 13))::BIGINT + 1)"
                f" / 4503599627370496.0) / n.weight")

    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS name, coalesce(text, '') AS body FROM documents),
bytes AS (
  SELECT doc_id, name, strlen(body) + {HEADER_BYTES} AS size,
         list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS b FROM docs),
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
     lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))),
rows AS (
  SELECT doc_id, name, size,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
             lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc_table),
region_draws AS (
  SELECT d.name, n.node, {draw('region')} AS x
  FROM (SELECT DISTINCT name FROM rows) d, {nodes(regions.items())} n(node, weight)),
tops AS (
  SELECT name, arg_min(node, x) FILTER (node <> {new.region}) AS region, arg_min(node, x) AS grown_region
  FROM region_draws GROUP BY name),
rack_draws AS (
  SELECT d.name, n.node, {draw('rack')} AS x
  FROM tops d JOIN {nodes(racks)} n(parent, node, weight) ON n.parent = d.region),
racks AS (SELECT name, arg_min(node, x) AS rack FROM rack_draws GROUP BY name),
shard_draws AS (
  SELECT d.name, n.node, {draw('shard')} AS x
  FROM racks d JOIN {nodes(shards)} n(parent, node, weight) ON n.parent = d.rack),
shards AS (SELECT name, arg_min(node, x) AS shard FROM shard_draws GROUP BY name),
placed AS (
  SELECT r.*, t.region, k.rack, s.shard,
         CASE WHEN t.grown_region = {new.region} THEN {new.shard} ELSE s.shard END AS grown_shard,
         coalesce(('0x' || substr(md5('bucket:' || r.doc_id), 1, 13))::BIGINT
                  % CAST(greatest(1, ceil((SELECT count(*) FROM documents) / {bucket_rows}.0)) AS BIGINT), 0) AS bucket
  FROM rows r JOIN tops t USING (name) JOIN racks k USING (name) JOIN shards s USING (name))
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard, region, rack,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32) - 1 AS slot
FROM placed"""
