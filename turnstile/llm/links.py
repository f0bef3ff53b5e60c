"""Groups of similar sets from candidate buckets, without comparing all pairs of a bucket.

Two sets are linked when their Jaccard similarity reaches the threshold; only sets that share
a bucket are looked at.  ``attach`` and ``connect`` return verified links that connect whatever the
links between bucket mates connect:

1. Pivots.  Every set is compared with a few sets of each of its buckets, by sketches, and with the
   ``PIVOTS`` most alike exactly; where one is linked, the set is attached to it.  A group of near copies
   thus shrinks to a few hubs, by as many comparisons per member as its size has digits.
2. Hubs.  From here on a member stands behind its hub, and sets on the same hub are never
   compared.  Hubs that share a bucket are linked where they are similar themselves.
3. Members.  Jaccard distance is a metric, so members of two hubs can only be linked where the hubs'
   distance is at most the threshold's distance and both radii.  For such hubs that are not
   connected by then, the members of the smaller one are compared with those of the larger, until one
   link is found.

Sketches choose pivots by an estimate; a pair of hubs or members is left out only where sizes and counts of tokens
per bin rule its link out, and exact similarities decide on the rest.  Rows grow with the number of (set, bucket)
entries.  Only sets that are no near copies of each other and yet share a bucket of more
than ``small`` hubs are dealt out in pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, tasks_for
from .components import connected_components
from .wordhash import SECOND_BASE, Prefix, U, mixed, owners, slices

BINS = 256
#: a count of tokens that says no more than so many or more
FULL = 255
#: rows that one cell compares with each other
SMALL = 2000
#: pivots that each set is compared with exactly, the likeliest by their sketches
PIVOTS = 2
#: parts that the partners of one set are dealt to when sets are fetched for them
SALTS = 256
#: keys up to this number are broadcast
BROADCAST_KEYS = 1 << 20
#: pivots up to this number are broadcast with their sketches (8 MB)
BROADCAST_PIVOTS = 1 << 15
#: tokens that the hosts of one cell hold
CELL_TOKENS = 1 << 21
#: pairs that a task compares at a time
CHUNK = 1 << 14

_CELLS = ["cell", "rep", "n", "sketch", "radius", "group", "block", "lone", "place", "marks"]


# ---- sets and sketches
def shingle_sets(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(token, text) of the distinct shingles of every text, sorted by (text, token).

    A text of fewer words than ``width`` is one shingle, one without words none.
    """
    n = np.diff(offsets)
    text = owners(offsets)
    at = np.arange(len(hashes))
    stop = np.minimum(at + width, offsets[1:][text]) if len(hashes) else at
    full = (stop - at == width) | ((n[text] < width) & (at == offsets[:-1][text]))
    at, stop, text = at[full], stop[full], text[full]
    token = Prefix(hashes).hashes(at, stop)
    order = np.lexsort((token, text))
    token, text = token[order], text[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (text[1:] != text[:-1])
    return token[new], text[new]


def starts_of(text: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` texts starts in sorted owners, and the end."""
    return np.searchsorted(text, np.arange(n + 1))


def set_ids(token: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit numbers per text that depend on its set of tokens only."""
    sums = [np.concatenate(([U(0)], np.cumsum(mixed(token ^ c), dtype=U))) for c in (U(0), SECOND_BASE)]
    return [(s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums]


def token_rows(shingles: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]):
    """mapInArrow function: (rep, text) -> (rep, tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                token, text = shingles(part.column("text"))
                at = starts_of(text, part.num_rows)
                yield pa.record_batch([part.column("rep"), pa.ListArray.from_arrays(
                    pa.array(at, pa.int32()), pa.array(token.view(np.int64)))], names=["rep", "tokens"])
    return run


def text_fetcher(texts: DataFrame, classes: DataFrame, shingles: Callable) -> Callable[[DataFrame], DataFrame]:
    """``fetch`` for ``attach`` and ``connect``: ``classes`` names a row (doc_id, text_hash) of ``texts`` for each rep."""
    def fetch(ids: DataFrame) -> DataFrame:
        few = ids.count() <= BROADCAST_KEYS
        wanted = (F.broadcast(ids) if few else ids).join(classes.select("rep", "doc_id", "text_hash"), "rep")
        rows = texts.join(F.broadcast(wanted) if few else wanted, ["doc_id", "text_hash"]).select("rep", "text")
        return rows.dropDuplicates(["rep"]).mapInArrow(token_rows(shingles), "rep long, tokens array<long>")
    return fetch


def bin_sketches(token: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Two bytes per bin (top bits) and text: first the smallest token of each bin, 0 where there is none, then how
    many tokens fall into each bin, ``FULL`` for so many or more.

    ``token`` is sorted within each text.
    """
    where = (token >> U(56)).astype(np.int64)
    first = np.ones(len(token), bool)
    first[1:] = (where[1:] != where[:-1]) | (text[1:] != text[:-1])
    out = np.zeros((n_texts, 2 * BINS), np.uint8)
    out[text[first], where[first]] = (token[first] % U(255) + U(1)).astype(np.uint8)
    at = np.flatnonzero(first)
    held = np.diff(np.append(at, len(token)))
    out[text[at], BINS + where[at]] = np.minimum(held, FULL).astype(np.uint8)
    return out


def _near(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether sketches may belong to sets of that similarity: four deviations below it at most.

    The filled bins are a sample without replacement of the union, whose deviation shrinks as it covers it.
    """
    filled_a, filled_b = a != 0, b != 0
    equal = ((a == b) & filled_a).sum(axis=1)
    either = np.maximum((filled_a | filled_b).sum(axis=1), 1)
    union = np.maximum((n_a + n_b) / (1 + np.clip(least, 0, 1)), 1)
    left_out = np.clip(1 - either / union, 0.1, 1)
    return equal >= (least - 2.0 * np.sqrt(left_out / either)) * either


def _may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether sets of these sketches can have that similarity; no pair that has it is ruled out.

    A bin's common tokens are at most the smaller count, one less where counts are equal and the smallest tokens differ.
    """
    held_a, held_b = a[:, BINS:], b[:, BINS:]
    low = np.minimum(held_a, held_b)
    less = (held_a == held_b) & (a[:, :BINS] != b[:, :BINS])
    most = low.sum(axis=1, dtype=np.int64) - less.sum(axis=1)
    most = np.where((low == FULL).any(axis=1), np.minimum(n_a, n_b), np.minimum(most, np.minimum(n_a, n_b)))
    return most >= least * (n_a + n_b - most) - 1e-6


def _matrix(column: pa.Array, width: int = 2 * BINS) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _sizes_allow(n_a: np.ndarray, n_b: np.ndarray, least: np.ndarray) -> np.ndarray:
    return np.minimum(n_a, n_b) >= least * np.maximum(n_a, n_b) - 1e-9


def _plausible(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            a, b = (_matrix(batch.column(c), BINS) for c in ("sketch_a", "sketch_b"))
            least = np.full(len(n_a), threshold)
            keep = pa.array(_sizes_allow(n_a, n_b, least) & _near(a, b, n_a, n_b, least))
            alike = ((a == b) & (a != 0)).sum(axis=1) / np.maximum(((a != 0) | (b != 0)).sum(axis=1), 1)
            yield pa.record_batch([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(alike).filter(keep)],
                                  names=["a", "b", "alike"])
    return run


def plausible(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """a, b, alike: the pairs (stored) whose sizes and sketches allow the threshold, and what the sketches have in common.

    A pivot (b) has many partners; where pivots are few, their sketches go to the pairs instead of the pairs to them.
    """
    def side(s):
        smallest = F.substring("sketch", 1, BINS)  # the counts of tokens are not looked at here
        return reps.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), smallest.alias(f"sketch_{s}"))

    pivots = pairs.select("b").distinct()
    hosts = F.broadcast(side("b").join(F.broadcast(pivots), "b")) if pivots.count() <= BROADCAST_PIVOTS else side("b")
    return pairs.join(side("a"), "a").join(hosts, "b").mapInArrow(_plausible(threshold), "a long, b long, alike double")


# ---- cells
def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by ``key``; a batch and the group that it cuts are held at once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        last = int(np.searchsorted(values, values[-1]))  # where the batch's last group starts
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        elif held and held[-1].column(key)[-1].as_py() != values[0]:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _marks(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of marks as the rows of a matrix, filled up with 0."""
    rows = column.to_pylist()
    width = max(map(len, rows), default=0)
    return np.array([r + [0] * (width - len(r)) for r in rows], np.int64).reshape(len(rows), width)


def _near_pairs(rows: pa.Table, threshold: float, meeting) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of rows of one cell and of different groups that may be linked, or whose hubs' members may."""
    cell, n, radius, group, block, lone, place = (
        rows.column(c).to_numpy() for c in ("cell", "n", "radius", "group", "block", "lone", "place"))
    sketch, marks = _matrix(rows.column("sketch")), _marks(rows.column("marks"))
    # partners of a row: those after it in its cell
    later = np.searchsorted(cell, cell, side="right") - np.arange(len(cell)) - 1
    ends = np.cumsum(later)
    lo = 0
    while lo < len(cell):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
        i = np.repeat(np.arange(lo, hi), later[lo:hi])
        j = i + 1 + np.arange(len(i)) - np.repeat(ends[lo:hi] - later[lo:hi] - before, later[lo:hi])
        lo = hi
        least = threshold - radius[i] - radius[j]
        keep = (group[i] != group[j]) & (lone[i] | (block[i] != block[j])) & _sizes_allow(n[i], n[j], least)
        i, j, least = i[keep], j[keep], least[keep]
        near = _may_link(sketch[i], sketch[j], n[i], n[j], least)
        i, j = i[near], j[near]
        if meeting is not None and len(i):
            # a pair that meets in several buckets counts in the first
            first = meeting(marks[i], marks[j])
            here = (first == 0) | (first == place[i])
            i, j = i[here], j[here]
        if len(i):
            yield i, j


def _candidates(threshold: float, meeting):
    """(a, b) of the near pairs of cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "cell"):
            rep = rows.column("rep").to_numpy()
            for i, j in _near_pairs(rows, threshold, meeting):
                yield pa.record_batch([pa.array(np.minimum(rep[i], rep[j])), pa.array(np.maximum(rep[i], rep[j]))], names=["a", "b"])
    return run


def _promising(threshold: float):
    """cell, rep, group, block of the rows that have a near partner in their cell."""
    names = ["cell", "rep", "group", "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "cell"):
            wanted = np.zeros(rows.num_rows, bool)
            for i, j in _near_pairs(rows, threshold, None):
                wanted[i] = wanted[j] = True
            yield from rows.select(names).filter(pa.array(wanted)).combine_chunks().to_batches()
    return run


def _first_links(num: int, den: int):
    """a, b, common, total: for every group of guests of a cell (block 1) one link to a host (block 0), if there is one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "cell"):
            cell = rows.column("cell").to_numpy()
            cuts = [*np.flatnonzero(np.append(True, cell[1:] != cell[:-1])).tolist(), len(cell)]
            out: list[tuple] = []
            for lo, hi in zip(cuts, cuts[1:]):
                part = rows.slice(lo, hi - lo)
                rep, group, block = (part.column(c).to_numpy() for c in ("rep", "group", "block"))
                sets = [np.asarray(x, np.int64) for x in part.column("tokens").to_pylist()]
                n = np.array([len(x) for x in sets])
                hosts = np.flatnonzero(block == 0)
                if not len(hosts):
                    continue
                # inverted lists of the hosts' tokens
                names, number = np.unique(np.concatenate([sets[h] for h in hosts]), return_inverse=True)
                order = np.argsort(number, kind="stable")
                member = np.repeat(np.arange(len(hosts)), n[hosts])[order]
                starts = np.searchsorted(number[order], np.arange(len(names) + 1))
                found = set()
                for g in np.flatnonzero(block == 1).tolist():
                    if group[g] in found:
                        continue
                    at = np.searchsorted(names, sets[g])
                    at = at[names[np.minimum(at, len(names) - 1)] == sets[g]]
                    lists = [member[starts[t]:starts[t + 1]] for t in at.tolist()]
                    common = np.bincount(np.concatenate(lists), minlength=len(hosts)) if lists else np.zeros(len(hosts), int)
                    total = n[g] + n[hosts] - common
                    hit = np.flatnonzero(common * den >= total * num)
                    if len(hit):
                        found.add(group[g])
                        out.append((int(rep[g]), int(rep[hosts[hit[0]]]), int(common[hit[0]]), int(total[hit[0]])))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "common", "total"])
    return run


def smallest_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row the smallest mark that both lists hold, 0 if there is none (lists are filled up with 0)."""
    best = np.zeros(len(a), np.int64)
    for column in a.T:
        hit = (b == column[:, None]).any(axis=1) & (column != 0)
        best = np.where(hit & ((best == 0) | (column < best)), column, best)
    return best


def _dealt(rows: DataFrame, columns: list[str]) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(*columns).repartition(parts, "cell").sortWithinPartitions("cell")


def _compared(cells: DataFrame, threshold: float, meeting) -> DataFrame:
    """Distinct candidate pairs of cells."""
    return _dealt(cells, _CELLS).mapInArrow(_candidates(threshold, meeting), "a long, b long").distinct()


# ---- exact similarities
def keyed(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``keys`` (distinct); the keys are broadcast if few."""
    few = keys.count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, key, "left_semi")


def exact(pairs: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """a, b, common, total (sizes of intersection and union); ``fetch(rep)`` gives rep, tokens.

    Of a pair the set with fewer partners (guest) is sent to the other one (host).  A host is sent to parts of its
    guests, so no join key holds them all.
    """
    pairs = stored(pairs, "pairs")
    n_pairs = pairs.count()
    tasks = tasks_for(pairs.sparkSession, n_pairs)
    ids = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))
    ids = stored(ids.groupBy("rep").agg(F.count(F.lit(1)).alias("partners")), "pair-sets", tasks)
    sets = stored(fetch(ids.select("rep")), "sets", tasks)
    for side in ("a", "b"):
        pairs = pairs.join(ids.select(F.col("rep").alias(side), F.col("partners").alias(f"partners_{side}")), side)
    host = F.when(F.col("partners_a") > F.col("partners_b"), F.col("a")).otherwise(F.col("b"))
    guest = F.when(F.col("partners_a") > F.col("partners_b"), F.col("b")).otherwise(F.col("a"))
    part = F.pmod(F.xxhash64(guest), F.lit(SALTS)).cast("int")
    dealt = stored(pairs.select("a", "b", host.alias("host"), guest.alias("guest"), part.alias("part")), "hosted", tasks)

    def sent(role, rows):
        rows = F.broadcast(rows) if n_pairs <= BROADCAST_KEYS else rows
        return sets.select(F.col("rep").alias(role), F.col("tokens").alias(f"set_{role}")).join(rows, role)

    out = sent("guest", dealt).join(sent("host", dealt.select("host", "part").distinct()), ["host", "part"])
    common = F.size(F.array_intersect("set_host", "set_guest")).cast("long")
    both = (F.size("set_host") + F.size("set_guest")).cast("long")
    return stored(out.select("a", "b", common.alias("common"), both.alias("both"))
                  .select("a", "b", "common", (F.col("both") - F.col("common")).alias("total")), "similarities", tasks)


def pivots_of(entries: DataFrame, tasks: int | None = None) -> DataFrame:
    """a, b: every set (a) with the pivots of its buckets.  ``entries``: rep, bucket; ``tasks`` as in ``stored``.

    A bucket has about half as many pivots as its size has binary digits.  They are the smallest ids of their
    slots, so groups that share many buckets have the same pivots in all of them.
    """
    sizes = entries.groupBy("bucket").agg(F.greatest(F.floor(F.log2(F.count(F.lit(1))) / 2), F.lit(1)).alias("slots"),
                                          F.count(F.lit(1)).alias("size")).filter("size > 1").drop("size")
    met = stored(entries.join(sizes, "bucket"), "met", tasks)
    pivots = (met.groupBy("bucket", F.pmod("rep", "slots").alias("slot")).agg(F.min("rep").alias("b"))
              .groupBy("bucket").agg(F.sort_array(F.collect_list("b")).alias("pivots")))  # half the digits of its size: few
    # a set meets the pivots of equal buckets once
    several = met.join(pivots, "bucket").select(F.col("rep").alias("a"), "pivots").distinct()
    return several.select("a", F.explode("pivots").alias("b")).filter("a <> b").distinct()


def shared_entries(entries: DataFrame, key: str, name: str, tasks: int) -> DataFrame:
    """Those entries whose key several sets (rep) have."""
    several = stored(entries.groupBy(key).agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"))
                     .filter("lo <> hi").select(key), name, tasks)
    return keyed(entries, several, key)


def unlike_buckets(shared: DataFrame, tasks: int) -> DataFrame:
    """rep, bucket, place: of the buckets that hold the same sets the entries of the one of the smallest place.

    ``shared``: rep, bucket, place, own (whether the bucket is the set's own, not a member's).  Two sets that share
    own buckets count in the first of them; what is left out has an equal one before it, in which they are own too.
    """
    one, two = (F.bit_xor(F.xxhash64("rep", "own", F.lit(i))) for i in (1, 2))
    held = shared.groupBy("bucket").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("sets"), F.min("rep").alias("lo"),
                                        F.max("rep").alias("hi"), one.alias("one"), two.alias("two"))
    first = held.groupBy("sets", "lo", "hi", "one", "two").agg(F.min_by("bucket", "place").alias("bucket")).select("bucket")
    return keyed(shared.drop("own"), stored(first, "first-buckets", tasks), "bucket")


def _blocked(entries: DataFrame, small: int) -> DataFrame:
    """Cells of (rep, bucket, place): a bucket, or the pairs of its blocks if it is larger than ``small``."""
    sizes = entries.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(small)).cast("int").alias("blocks"))
    dealt = (entries.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return dealt.select(F.xxhash64("bucket", low, high).alias("cell"), "rep", "place", "block", (low == high).alias("lone"))


def attach(reps: DataFrame, stars: Column, fetch: Callable[[DataFrame], DataFrame], num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(links, hung): verified links of sets with pivots, and rep, hub, distance of the sets that are no pivots.

    ``reps``: one stored row per set with rep (id), n (size) and sketch; ``stars``: array over its columns of
    the buckets in which pivots are looked for.  ``fetch``: rep -> rep, tokens (distinct).  Linked:
    ``common * den >= num * total``.
    """
    tasks = tasks_for(reps.sparkSession, reps.count())
    several = stored(pivots_of(reps.select("rep", F.explode(stars).alias("bucket")), tasks), "pivots", tasks)
    met = several.select(F.col("a").alias("rep")).unionByName(several.select(F.col("b").alias("rep"))).distinct()
    near = plausible(several, keyed(reps, met, "rep"), num / den)
    best = F.sort_array(F.collect_list(F.struct("alike", "b")), asc=False)  # a few per bucket of the set: bounded
    pairs = near.groupBy("a").agg(F.slice(best, 1, PIVOTS).alias("p")).select("a", F.explode("p").alias("p")).select("a", "p.b")
    star = stored(exact(pairs.coalesce(tasks), fetch).filter(F.col("common") * den >= F.col("total") * num), "star", tasks)
    pivots = star.select(F.col("b").alias("a")).distinct()
    closest = F.min(F.struct((1 - F.col("common") / F.col("total")).alias("distance"), "b"))
    hung = star.join(pivots, "a", "left_anti").groupBy("a").agg(closest.alias("p")).select(
        F.col("a").alias("rep"), F.col("p.b").alias("hub"), F.col("p.distance").alias("distance"))
    return star, stored(hung, "hung", tasks)


def connect(reps: DataFrame, buckets: Callable[[DataFrame, int], DataFrame], star: DataFrame, hung: DataFrame,
            fetch: Callable[[DataFrame], DataFrame], meeting: Callable[[np.ndarray, np.ndarray], np.ndarray], num: int, den: int, small: int = SMALL) -> DataFrame:
    """a, b, common, total: ``star`` and the links that it leaves out, as the module says.

    ``reps`` as in ``attach``, with marks (array of long, none 0).  ``buckets(held, tasks)``: the entries (rep, own, bucket,
    place) of rows of rep, own and marks, which repeat a rep; those of a bucket of one rep may be left out.
    ``meeting(marks, marks)``: the place of the first bucket that two sets share, 0 if none.
    """
    threshold = num / den
    tasks = tasks_for(reps.sparkSession, reps.count())
    radii = hung.join(reps.select("rep", "n"), "rep").groupBy("hub").agg(
        F.max("distance").alias("radius"), F.count(F.lit(1)).alias("members"), F.sum("n").alias("mass"))
    # 2. hubs that share a bucket
    held = reps.select("rep", "marks").join(hung.select("rep", "hub"), "rep", "left").select(
        F.coalesce("hub", "rep").alias("rep"), F.col("hub").isNull().alias("own"), "marks")
    shared = stored(shared_entries(buckets(held, tasks), "bucket", "mixed", tasks)
                    .groupBy("rep", "bucket", "place").agg(F.max("own").alias("own")), "shared", tasks)
    known = (keyed(reps.select("rep", "n", "sketch", "marks"), shared.select("rep").distinct(), "rep")
             .join(radii, F.col("rep") == F.col("hub"), "left").select(
        "rep", "n", "sketch", "marks", F.coalesce("radius", F.lit(0.0)).alias("radius"),
        (F.coalesce("members", F.lit(0)) + 1).alias("members"), (F.coalesce("mass", F.lit(0)) + F.col("n")).alias("mass")))
    rows = stored(_blocked(stored(unlike_buckets(shared, tasks), "buckets", tasks), small).join(known, "rep"), "cells", tasks)
    alike = rows.drop("radius").withColumns({"radius": F.lit(0.0), "group": F.col("rep")})
    same = exact(_compared(alike, threshold, meeting).coalesce(tasks), fetch).filter(F.col("common") * den >= F.col("total") * num)
    links = stored(star.unionByName(same), "hub-links", tasks)
    # 3. members of hubs within reach that are not connected yet
    groups = connected_components(links, "a", "b")
    reach = rows.join(groups, F.col("rep") == F.col("node"), "left").withColumn("group", F.coalesce("component", "rep"))
    wide = reach.where("radius > 0").select("cell").distinct()
    open_pairs = stored(_compared(keyed(reach, wide, "cell"), threshold, meeting), "open-pairs", tasks)
    if open_pairs.isEmpty():
        return links
    sizes = known.select("rep", "members", "mass")
    for side in ("a", "b"):
        open_pairs = open_pairs.join(sizes.select(F.col("rep").alias(side), F.col("members").alias(f"members_{side}"),
                                                  F.col("mass").alias(f"mass_{side}")), side)
    first = F.col("mass_a") >= F.col("mass_b")
    blocks = F.ceil(F.greatest(F.greatest("members_a", "members_b") / F.lit(small),
                               F.greatest("mass_a", "mass_b") / F.lit(CELL_TOKENS))).cast("int")
    sized = stored(open_pairs.filter("members_a + members_b > 2").select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("host"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("guest"), blocks.alias("blocks")), "hosts", tasks)
    behind = hung.select("hub", "rep").unionByName(known.select(F.col("rep").alias("hub"), "rep"))
    of_host = sized.groupBy("host").agg(F.max("blocks").alias("blocks"))
    hosts = (of_host.join(behind, F.col("host") == F.col("hub"))
             .select(F.xxhash64("host", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).alias("cell"), "rep",
                     F.col("hub").alias("group"), F.lit(0).alias("block")))
    guests = (sized.drop("blocks").join(of_host, "host").join(behind, F.col("guest") == F.col("hub"))
              .withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select(F.xxhash64("host", "at").alias("cell"), "rep", F.col("hub").alias("group"), F.lit(1).alias("block")))
    members = stored(hosts.unionByName(guests), "members-met", tasks)
    rows = (members.join(keyed(reps.select("rep", "n", "sketch"), members.select("rep").distinct(), "rep"), "rep")
            .withColumns({"radius": F.lit(0.0), "lone": F.lit(False), "place": F.lit(0).cast("long"),
                          "marks": F.array().cast("array<long>")}))
    near = stored(_dealt(rows, _CELLS).mapInArrow(_promising(threshold), "cell long, rep long, group long, block int"), "promising")
    sets = stored(fetch(stored(near.select("rep").distinct(), "member-sets", tasks)), "sets", tasks)
    found = _dealt(near.join(sets, "rep"), ["cell", "rep", "group", "block", "tokens"]).mapInArrow(
        _first_links(num, den), "a long, b long, common long, total long")
    return links.unionByName(stored(found, "member-links"))
