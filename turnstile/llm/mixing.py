"""Mixing sources to target weights with fixed-length blocks and index permutations.

1. A source's documents, in a hashed order, are one stream of words cut into
   blocks of ``block_words`` (the last one may be shorter).
2. Targets: sources share the total by weight; a source is never used more than
   ``max_epochs`` times, and what it cannot take is shared among the others.
3. The output is a row of slots, ``shard_slots`` to a shard.  Each slot draws its
   source with the quotas as weights, so a shard's counts per source are multinomial, and
   so are the totals: a source's words spread around its target by about the square root
   of its slots.  Only slots beyond a source's last epoch are moved, to the sources that
   drew fewest of their quota's slots in the order of their numbers.
4. The i-th slot of a source takes block perm(i mod blocks) of epoch i div blocks.
   The permutation is a swap-or-not shuffle keyed by source and epoch: a bijection on
   any number of blocks, computed per slot without sorting the source.
5. Slots and blocks meet in a join on (source, block).

Everything is DataFrame functions.  Windows run over buckets, shards or groups of shards,
never over a whole source's documents; those over the table of sources hold one row per
source, so the sources must be few enough to sort in one task.

Defined results: a null text has no words; a null source is a source of its own
and sorts last; documents without words are taken 0 times; repeated rows are
separate documents; an empty table gives no rows; extra columns are carried by
``mixed_documents`` and ignored elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_offsets, buckets_for, digest_number, let, stored, words

SEED = "mix-1"
ROUNDS = 12
#: short blocks keep a source's words near its target: the spread falls with the root of the slots
BLOCK_WORDS = 32
SHARD_SLOTS = 4096
#: shards whose starts are summed in one window
GROUP_SHARDS = 4096
#: cells that the row of quotas is cut into, so that a draw finds its source by an equi-join
DRAW_CELLS = 4096


@dataclass
class Mix:
    """rows: the stable input with ``rid``, ``size`` and ``sid``; sources: one row each;
    pieces: what of a document lies in which block; slots: (slot, shard, sid, i, epoch, block)."""

    rows: DataFrame
    sources: DataFrame
    pieces: DataFrame
    slots: DataFrame


def source_targets(sizes: DataFrame, weights: tuple[float, ...], max_epochs: int, block_words: int) -> DataFrame:
    """sid, source, source_size, target, blocks, quota: one row per source.

    The capped shares have a closed form: ordered by cap/weight, a source is capped
    while its cap is below the level that the uncapped ones share.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = totals.withColumn("sid", F.row_number().over(by_name) - 1)
    ranked = (ranked.withColumn("weight", F.element_at(cycle, F.col("sid") % len(weights) + 1))
              .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    earlier, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum("weight").over(rest)
    ranked = ranked.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") > F.col("cap"))
    # the level at the first source that is not capped holds for it and all later ones
    found = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "sid", "level"))) \
        .over(Window.partitionBy())["level"]
    ranked = ranked.withColumn("target", F.least(F.col("cap"), F.coalesce(found, F.lit(float("inf"))) * F.col("weight")))
    ranked = ranked.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block_words)).cast("long"))
    quota = F.least(F.round(F.col("target") / F.col("source_size") * F.col("blocks")).cast("long"),
                    F.col("blocks") * max_epochs)
    return ranked.select("sid", "source", "source_size", "weight", "target", "blocks",
                         F.when(F.col("source_size") > 0, quota).otherwise(F.lit(0)).cast("long").alias("quota"))


def _running(column: str, order: str) -> Column:
    return F.coalesce(F.sum(column).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _shard_starts(counts: DataFrame) -> DataFrame:
    """sid, shard, start: a source's slots in earlier shards, summed by groups of shards and inside them."""
    grouped = counts.withColumn("group", F.floor(F.col("shard") / F.lit(GROUP_SHARDS)))
    before = bucket_offsets(grouped.groupBy("sid", "group").agg(F.sum("n").alias("n")), ["sid"], "group", "n", "before")
    inside = bucket_offsets(grouped, ["sid", "group"], "shard", "n", "inside")
    return inside.join(before, ["sid", "group"]).select("sid", "shard", (F.col("before") + F.col("inside")).alias("start"))


def draw_slots(sources: DataFrame, total_slots: int, shard_slots: int, max_epochs: int) -> DataFrame:
    """slot, shard, sid, i: every slot with its source and its index within that source.

    A draw is a place in the row of all quotas.  Slots past a source's cap are moved; sources
    short of their quota have room for all of them, as draws and quotas have the same total.
    """
    width = max(1, -(-total_slots // DRAW_CELLS))
    share = sources.filter("quota > 0").withColumn("lo", _running("quota", "sid")) \
        .withColumn("hi", F.col("lo") + F.col("quota"))
    cells = share.select("sid", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / F.lit(width)), F.floor((F.col("hi") - 1) / F.lit(width)))).alias("cell"))
    draws = (sources.sparkSession.range(total_slots).withColumnRenamed("id", "slot")
             .withColumn("place", digest_number(F.lit(SEED), F.lit("draw"), F.col("slot")) % F.lit(max(1, total_slots)))
             .withColumn("cell", F.floor(F.col("place") / F.lit(width)))
             .withColumn("shard", F.floor(F.col("slot") / F.lit(shard_slots))))
    drawn = draws.join(cells, "cell").filter("place >= lo AND place < hi").select("slot", "shard", "sid")
    # multinomial counts per shard and source, and where each shard's run of a source starts
    starts = _shard_starts(drawn.groupBy("sid", "shard").agg(F.count(F.lit(1)).alias("n")))
    inside = Window.partitionBy("sid", "shard").orderBy("slot")
    placed = (drawn.join(starts, ["sid", "shard"])
              .withColumn("i", F.col("start") + F.row_number().over(inside) - 1).drop("start"))
    placed = stored(placed, "mix-slots")
    took = placed.groupBy("sid").agg(F.count(F.lit(1)).alias("drawn"))
    balance = (sources.filter("quota > 0").withColumn("cap", F.col("blocks") * max_epochs)
               .select("sid", "quota", "cap").join(took, "sid", "left")
               .withColumn("drawn", F.coalesce("drawn", F.lit(0)))
               .withColumn("over", F.greatest(F.col("drawn") - F.col("cap"), F.lit(0)))
               .withColumn("short", F.greatest(F.col("quota") - F.col("drawn"), F.lit(0))))
    balance = (balance.withColumn("over_at", _running("over", "sid"))
               .withColumn("short_at", _running("short", "sid"))
               .withColumn("moves", F.sum("over").over(Window.partitionBy())))
    known = placed.join(balance.select("sid", "cap", "over_at"), "sid")
    moved = known.filter("i >= cap").select("slot", "shard", (F.col("over_at") + F.col("i") - F.col("cap")).alias("o"))
    gaps = (balance.filter("short > 0 AND short_at < moves")
            .withColumn("k", F.explode(F.sequence(
                F.lit(0).cast("long"), F.least(F.col("short"), F.col("moves") - F.col("short_at")) - 1)))
            .select("sid", (F.col("short_at") + F.col("k")).alias("o"), (F.col("drawn") + F.col("k")).alias("i")))
    kept = known.filter("i < cap").select("slot", "shard", "sid", "i")
    return kept.unionByName(moved.join(gaps, "o").select("slot", "shard", "sid", "i"))


def permuted(slots: DataFrame, sources: DataFrame, max_epochs: int) -> DataFrame:
    """Add epoch and block: block = shuffle of (i mod blocks) keyed by source and epoch."""
    keys = sources.filter("blocks > 0").select("sid", "blocks", F.explode(F.sequence(
        F.lit(0).cast("long"), F.lit(max_epochs - 1).cast("long"))).alias("epoch"))
    keys = keys.select("sid", "epoch", F.array(*[
        digest_number(F.lit(SEED), F.lit("key"), F.col("sid"), F.col("epoch"), F.lit(r)) % F.col("blocks")
        for r in range(ROUNDS)]).alias("keys"))
    out = slots.join(sources.select("sid", "blocks"), "sid")
    out = (out.withColumn("epoch", F.floor(F.col("i") / F.col("blocks")))
           .withColumn("block", F.col("i") % F.col("blocks"))).join(keys, ["sid", "epoch"])
    for r in range(ROUNDS):
        out = out.withColumn("_other", (F.col("keys")[r] + F.col("blocks") - F.col("block")) % F.col("blocks"))
        bit = F.substring(F.md5(F.concat_ws(":", F.lit(SEED), F.lit("bit"), F.col("sid"), F.col("epoch"), F.lit(r),
                                            F.greatest("block", "_other"))), 1, 1) >= "8"
        out = out.withColumn("block", F.when(bit, F.col("_other")).otherwise(F.col("block"))).drop("_other")
    return out.select("slot", "shard", "sid", "i", "epoch", "block")


def word_pieces(rows: DataFrame, block_words: int) -> DataFrame:
    """sid, block, rid, piece_start, piece_words: streams cut into blocks.

    A document's place in its source's stream comes from its bucket's start and a running
    sum inside the bucket.  Buckets follow doc_id and size, so rows without an id spread too.
    """
    n = rows.count()
    cut = rows.select("rid", "doc_id", "sid", "size").filter("size > 0") \
        .withColumn("bucket", digest_number(F.lit("bucket"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                            F.col("size")) % F.lit(buckets_for(n)))
    starts = bucket_offsets(cut.groupBy("sid", "bucket").agg(F.sum("size").alias("n")), ["sid"], "bucket", "n", "start")
    inside = Window.partitionBy("sid", "bucket").orderBy("doc_id", "size", "rid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.join(starts, ["sid", "bucket"]).withColumn(
        "at", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    blocks = placed.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("at") / F.lit(block_words)), F.floor((F.col("at") + F.col("size") - 1) / F.lit(block_words)))))
    first = F.greatest(F.col("at"), F.col("block") * block_words)
    last = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block_words)
    return blocks.select("sid", "block", "rid", (first - F.col("at")).alias("piece_start"),
                         (last - first).alias("piece_words"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3,
        block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, columns: list[str] | None = None) -> Mix:
    """Plan and draw the mix of ``docs``; ``columns`` are carried along in ``Mix.rows``."""
    keep = [c for c in columns or [] if c not in ("doc_id", "source")]
    sized = docs.select("doc_id", "source", *[F.col(c).alias(f"in_{c}") for c in keep],
                        F.size(words(F.col("text"))).cast("long").alias("size"),
                        F.monotonically_increasing_id().alias("rid"))
    sized = stored(sized, "mix-rows")
    sources = stored(source_targets(sized, weights, max_epochs, block_words), "mix-sources")
    ids = sources.select(F.col("source").alias("_source"), "sid")
    rows = sized.join(ids, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    total = sources.agg(F.sum("quota")).first()[0] or 0
    slots = stored(permuted(draw_slots(sources, int(total), shard_slots, max_epochs), sources, max_epochs), "mix-drawn")
    return Mix(rows, sources, word_pieces(rows, block_words), slots)


def taken_words(plan: Mix) -> DataFrame:
    """rid, taken: the words the mix takes of each document, repeats counted."""
    times = plan.slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
    return (plan.pieces.join(times, ["sid", "block"]).groupBy("rid")
            .agg(F.sum(F.col("piece_words") * F.col("times")).alias("taken")))


def op9_mix_to_weights(docs: DataFrame) -> DataFrame:
    plan = mix(docs)
    rows = plan.rows.select("rid", "doc_id", "sid", "size")
    return (rows.join(taken_words(plan), "rid", "left")
            .join(plan.sources.select("sid", "source_size", "target"), "sid")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents with the words the mix takes: one row per document taken at all.

    A document's text becomes its taken words in order of (epoch, position), joined by one
    space, repeats included; the other columns stay, ``n_chars`` follows the text.
    """
    plan = mix(docs, columns=docs.columns, **options)
    takes = (plan.slots.join(plan.pieces, ["sid", "block"])
             .groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("epoch", "piece_start", "piece_words"))).alias("takes")))
    merged = plan.rows.join(takes, "rid")
    # a column of words would be put into the lambda by the planner, which splits the text for every take
    text = let(words(F.col("in_text")), lambda split: F.array_join(F.flatten(F.transform(
        "takes", lambda t: F.slice(split, (t["piece_start"] + 1).cast("int"), t["piece_words"].cast("int")))), " "))
    merged = merged.withColumn("_mixed", text)
    values = {"text": F.col("_mixed"), "n_chars": F.char_length("_mixed").cast("long"),
              "doc_id": F.col("doc_id"), "source": F.col("source")}
    return merged.select(*[values.get(c, F.col(f"in_{c}")).alias(c) for c in docs.columns])


def oracle_sql() -> str:
    """The same draw, moves and permutation; a source's slots are numbered in one window here."""
    steps, last = [], "start_round"
    for r in range(ROUNDS):
        steps.append(f"""
r{r}a AS (SELECT sid, epoch, blocks, block,
  (('0x' || substr(md5('{SEED}:key:' || sid || ':' || epoch || ':{r}'), 1, 13))::BIGINT % blocks + blocks - block) % blocks AS other
  FROM {last}),
r{r} AS (SELECT sid, epoch, blocks,
  CASE WHEN substr(md5('{SEED}:bit:' || sid || ':' || epoch || ':{r}:' || greatest(block, other)), 1, 1) >= '8'
       THEN other ELSE block END AS block FROM r{r}a),""")
        last = f"r{r}"
    return f"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         row_number() OVER () AS rid FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM sizes GROUP BY source),
weighted AS (
  SELECT *, ([5.0, 2.0, 1.0])[CAST(sid % 3 AS INTEGER) + 1]::DOUBLE AS weight, 3.0 * source_size AS cap FROM named),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, sid
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
chosen AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE level * weight <= cap),
sources AS (
  SELECT l.sid, l.source, l.source_size, least(l.cap, coalesce(c.level, 'infinity'::DOUBLE) * l.weight)::DOUBLE AS target,
         CAST(ceil(l.source_size / {BLOCK_WORDS}.0) AS BIGINT) AS blocks
  FROM levels l, chosen c),
quotas AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(CAST(round(target / source_size * blocks) AS BIGINT), 3 * blocks)
            ELSE 0 END AS quota FROM sources),
places AS (
  SELECT *, CAST(coalesce(sum(quota) OVER (ORDER BY sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS lo
  FROM quotas WHERE quota > 0),
slots AS (SELECT unnest(range(CAST((SELECT coalesce(sum(quota), 0) FROM quotas) AS BIGINT))) AS slot),
draws AS (
  SELECT slot, ('0x' || substr(md5('{SEED}:draw:' || slot), 1, 13))::BIGINT
               % CAST((SELECT sum(quota) FROM quotas) AS BIGINT) AS place FROM slots),
drawn AS (
  SELECT p.sid, p.blocks, row_number() OVER (PARTITION BY p.sid ORDER BY d.slot) - 1 AS i
  FROM draws d JOIN places p ON d.place >= p.lo AND d.place < p.lo + p.quota),
balance AS (
  SELECT p.sid, p.blocks, count(d.i) AS drawn, greatest(count(d.i) - 3 * p.blocks, 0) AS over,
         greatest(p.quota - count(d.i), 0) AS short
  FROM places p LEFT JOIN drawn d ON d.sid = p.sid GROUP BY p.sid, p.blocks, p.quota),
gaps AS (SELECT sid, blocks, drawn + unnest(range(short)) AS i FROM balance),
moved AS (
  SELECT sid, blocks, i FROM gaps QUALIFY row_number() OVER (ORDER BY sid, i) <= (SELECT sum(over) FROM balance)),
indices AS (SELECT sid, blocks, i FROM drawn WHERE i < 3 * blocks UNION ALL SELECT sid, blocks, i FROM moved),
start_round AS (SELECT sid, blocks, i // blocks AS epoch, i % blocks AS block FROM indices),{''.join(steps)}
times AS (SELECT sid, block, count(*) AS times FROM {last} GROUP BY sid, block),
placed AS (
  SELECT s.rid, s.doc_id, s.size, q.sid, q.source_size, q.target,
         coalesce(sum(s.size) OVER (PARTITION BY q.sid ORDER BY
             ('0x' || substr(md5('bucket:' || coalesce(s.doc_id::VARCHAR, '') || ':' || s.size), 1, 13))::BIGINT
               % CAST(greatest(1, ceil((SELECT count(*) FROM documents) / 4096.0)) AS BIGINT),
             s.doc_id, s.size, s.rid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM sizes s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
pieces AS (
  SELECT rid, sid, pos, size, unnest(range(CAST(pos AS BIGINT) // {BLOCK_WORDS},
         (CAST(pos AS BIGINT) + size - 1) // {BLOCK_WORDS} + 1)) AS block FROM placed WHERE size > 0),
taken AS (
  SELECT p.rid, sum((least(p.pos + p.size, (p.block + 1) * {BLOCK_WORDS}) - greatest(p.pos, p.block * {BLOCK_WORDS})) * t.times) AS taken
  FROM pieces p JOIN times t ON t.sid = p.sid AND t.block = p.block GROUP BY p.rid)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM placed LEFT JOIN taken USING (rid)"""
