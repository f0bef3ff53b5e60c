"""Ranked lexical search by range-maximum queries over posting lists.

Documents are indexed in shards of a few MB of text, inside the task that reads them: per shard the
sorted term hashes and, per term, the documents that hold it and how often.  One row per shard is
written; nothing is shuffled but the document counts of the terms.

A search task takes the shards one after the other.  Over every posting list stands a sparse
table, which answers in two look-ups where a range of documents has its largest impact
(``RangeMaxima``).  A query starts with the interval of all the shard's documents, bounded by
the sum of its terms' weighted maxima.  Best bounds go first: an interval is split at the document
of its largest weighted impact; that document is scored, and the intervals on both sides get bounds
of their own.  Intervals that cannot enter the best ``k`` any more are left; the best of earlier
shards of the task count from the start.  Rows of all tasks are cut to the best ``k`` in two steps.

Scores are whole numbers as the ranking formula of ``weights`` and ``impacts`` gives them, so equal
scores are equal exactly and go by ascending doc_id (null last).

Defined results: null and empty texts hold no term and are never found; every row of ``documents``
is a document, also where doc_ids repeat or lack; rows of ``items`` that share an item_id are one
query with the terms of all; items without a term in the corpus and empty tables give no rows.
Terms are compared by 64-bit hashes.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .wordhash import U, hashed_texts, owners, slices

TOP = 10
#: the length norm: B percent of it follows the document's length
K1, B = 8, 75
#: ASCII bytes other than 0-9, A-Z, a-z separate terms
SEPARATOR = np.zeros(256, bool)
SEPARATOR[0x00:0x30] = SEPARATOR[0x3A:0x41] = SEPARATOR[0x5B:0x61] = SEPARATOR[0x7B:0x80] = True
#: queries (and their distinct terms) that one search pass takes; more are searched in further passes
BLOCK_ITEMS, BLOCK_TERMS = 4096, 1 << 20
#: intervals of a query that are split together, at most
BATCH = 128
#: groups that the best rows of an item are cut in first
SALTS = 64


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(term hashes, term offsets of the texts)."""
    return hashed_texts(column, SEPARATOR, lower=True)


# ---- index
_INDEX = ("doc_ids array<long>, lengths binary, terms array<long>, counts array<int>, docs binary, freqs binary, "
          "n_docs long, n_terms long")


def postings(column: pa.Array, vocabulary: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(lengths, terms, counts, docs, freqs) of the texts; ``vocabulary`` (sorted) restricts the terms kept."""
    term, at = term_hashes(column)
    doc = owners(at)
    if vocabulary is not None:
        if len(vocabulary):
            kept = vocabulary[np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)] == term
        else:
            kept = np.zeros(len(term), bool)
        term, doc = term[kept], doc[kept]
    order = np.argsort(term, kind="stable")  # documents stay in order within a term
    term, doc = term[order], doc[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(new)
    freq = np.diff(np.append(starts, len(term)))
    term, doc = term[starts], doc[starts]
    first = np.ones(len(term), bool)
    first[1:] = term[1:] != term[:-1]
    heads = np.flatnonzero(first)
    return np.diff(at), term[heads], np.diff(np.append(heads, len(term))), doc, freq


def _index_rows(vocabulary: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                # documents in order of doc_id (null last), so that ties are settled by place
                part = part.take(pc.sort_indices(part, [("doc_id", "ascending")]))
                length, term, count, doc, freq = postings(part.column("text"), vocabulary)
                yield pa.record_batch(
                    [pa.array([part.column("doc_id")], pa.list_(pa.int64())), pa.array([length.astype("<i4").tobytes()]),
                     pa.array([term.view(np.int64)], pa.list_(pa.int64())), pa.array([count], pa.list_(pa.int32())),
                     pa.array([doc.astype("<i4").tobytes()]), pa.array([freq.astype("<i4").tobytes()]),
                     pa.array([int((length > 0).sum())]), pa.array([int(length.sum())])],
                    names=["doc_ids", "lengths", "terms", "counts", "docs", "freqs", "n_docs", "n_terms"])
    return run


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None) -> DataFrame:
    """One stored row per shard.  ``vocabulary``: sorted hashes of the terms to keep (None: all)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(_index_rows(vocabulary), _INDEX), "postings")


# ---- scoring
def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000.0 * np.log((2.0 * n_docs + 2.0) / (2.0 * df + 1.0))).astype(np.int64)


def impacts(freq: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term gives a document, before the term's weight."""
    norm = 100 - B + (B * length * n_docs) // n_terms
    return (1_000_000_000 * freq) // (1000 * freq + K1 * norm)


class RangeMaxima:
    """Sparse tables over lists of numbers that stand one after the other."""

    def __init__(self, values: np.ndarray, longest: int):
        self.values = values
        at = np.arange(len(values), dtype=np.int32)
        self.table = [at]
        half = 1
        while 2 * half <= longest:
            a, b = self.table[-1], self.table[-1][half:]
            a = a[:len(b)]
            self.table.append(np.where(values[b] > values[a], b, a))
            half *= 2
        width = len(values)
        self.flat = np.concatenate([np.pad(t, (0, width - len(t))) for t in self.table]) if width else at
        self.width = width

    def argmax(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Where each range start..stop-1 (not empty, inside one list) has its first largest value."""
        level = np.frexp(stop - start)[1] - 1  # floor of the binary logarithm
        a = self.flat[level * self.width + start]
        b = self.flat[level * self.width + stop - (1 << level)]
        return np.where(self.values[b] > self.values[a], b, a)


class Shard:
    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.null = row["doc_ids"].is_null().to_numpy(zero_copy_only=False)
        self.ids = row["doc_ids"].fill_null(0).to_numpy(zero_copy_only=False)
        self.terms = row["terms"].view(U)
        self.doc = np.frombuffer(row["docs"], "<i4").astype(np.int64)
        length = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
        counts = row["counts"].astype(np.int64)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        freq = np.frombuffer(row["freqs"], "<i4").astype(np.int64)
        self.impact = impacts(freq, length[self.doc], n_docs, n_terms)
        self.maxima = RangeMaxima(self.impact, int(counts.max(initial=0)))
        # (list, document) of every posting as one sorted number
        self.place = np.repeat(np.arange(len(counts)), counts) * (len(length) + 1) + self.doc
        self.size = len(length)

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """The list number of each term, -1 where the shard does not hold it."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)


class Best:
    """The best ``k`` documents of a query so far: falling scores, equal ones by ascending doc_id, null last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        good = self.beaten_by(score, ids, null)
        if good.any():
            score, ids, null = (np.concatenate([old, new[good]]) for old, new in
                                ((self.score, score), (self.id, ids), (self.null, null)))
            order = np.lexsort((ids, null, -score))[:self.k]
            self.score, self.id, self.null = score[order], ids[order], null[order]

    def beaten_by(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> np.ndarray:
        """Whether a document of that score (or one in an interval of that bound and first doc_id) can still enter."""
        if len(self.score) < self.k:
            return score > 0
        floor, last, last_null = self.score[-1], self.id[-1], self.null[-1]
        earlier = (null < last_null) | ((null == last_null) & (ids < last))
        return (score > floor) | ((score == floor) & earlier)


def search_shard(shard: Shard, lists: np.ndarray, weight: np.ndarray, best: Best) -> int:
    """Best-first search of one query; returns how many intervals were split.

    Pending intervals keep, per term, the range of postings that falls into them.
    """
    ids, null = shard.ids, shard.null
    step = shard.size + 1
    base = lists * step

    def bounds(start, stop):
        """(bound, place of the largest weighted impact) of intervals given by posting ranges."""
        held = stop > start
        top = shard.maxima.argmax(start, np.where(held, stop, start + 1))
        value = np.where(held, shard.impact[top] * weight, 0)
        lead = value.argmax(axis=1)
        return value.sum(axis=1), shard.doc[top[np.arange(len(top)), lead]]

    lo, start, stop = np.zeros(1, np.int64), shard.starts[lists][None, :], shard.ends[lists][None, :]
    bound, split = bounds(start, stop)
    width, splits = 1, 0
    while True:
        alive = best.beaten_by(bound, ids[lo], null[lo])
        if not alive.all():
            lo, start, stop, bound, split = lo[alive], start[alive], stop[alive], bound[alive], split[alive]
        if not len(bound):
            return splits
        take = np.arange(len(bound)) if len(bound) <= width else np.argpartition(-bound, width - 1)[:width]
        width = min(2 * width, BATCH)
        splits += len(take)
        at = split[take]
        place = base + at[:, None]
        # a document's postings: within the interval's ranges, where the list holds the document
        left = np.searchsorted(shard.place, place)
        hit = shard.place[np.minimum(left, len(shard.place) - 1)] == place
        right = left + hit
        score = np.where(hit, shard.impact[np.minimum(left, len(shard.place) - 1)] * weight, 0).sum(axis=1)
        best.add(score, ids[at], null[at])
        # the two sides, of which those without postings bound to 0 and are left
        sides = [(lo[take], start[take], left), (at + 1, right, stop[take])]
        keep = np.ones(len(bound), bool)
        keep[take] = False
        parts = [(lo[keep], start[keep], stop[keep], bound[keep], split[keep])]
        for first, a, b in sides:
            some = (b > a).any(axis=1)
            if some.any():
                parts.append((first[some], a[some], b[some], *bounds(a[some], b[some])))
        lo, start, stop, bound, split = (np.concatenate(x) for x in zip(*parts))


@dataclass(frozen=True)
class Block:
    """Queries of one pass: item_id, its terms (sorted hashes) and their weights times repeats."""
    items: list
    terms: list
    weights: list


def _search(block: Block, n_docs: int, n_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in block.items]
        cuts = np.cumsum([0, *map(len, block.terms)])
        terms = np.concatenate(block.terms)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("lengths", "docs", "freqs")}
                row |= {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("terms", "counts")}
                row["doc_ids"] = batch.column("doc_ids")[i].values
                shard = Shard(row, n_docs, n_terms)
                found = shard.lists(terms)
                for q in range(len(block.items)):
                    mine = found[cuts[q]:cuts[q + 1]]
                    held = (mine >= 0) & (block.weights[q] > 0)
                    if held.any():
                        search_shard(shard, mine[held], block.weights[q][held], best[q])
        out = [(item, None if null else d, s) for item, b in zip(block.items, best)
               for s, d, null in zip(b.score.tolist(), b.id.tolist(), b.null.tolist())]
        cols = list(zip(*out)) if out else [[]] * 3
        yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["item_id", "doc_id", "score"])
    return run


# ---- queries
def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            term, at = term_hashes(part.column("text"))
            yield pa.record_batch([part.column("item_id").take(pa.array(owners(at))), pa.array(term.view(np.int64))],
                                  names=["item_id", "term"])


def query_terms(items: DataFrame) -> DataFrame:
    """item_id, term, repeats."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return (rows.mapInArrow(_query_terms, "item_id long, term long").groupBy("item_id", "term")
            .agg(F.count(F.lit(1)).alias("repeats")))


def _blocks(weighted: DataFrame) -> Iterator[list]:
    """The queries in blocks of bounded size, read one partition after the other."""
    rows = weighted.groupBy("item_id").agg(F.collect_list(F.struct("term", "df", "repeats")).alias("terms"))
    items, held = [], 0
    for row in rows.toLocalIterator():
        items.append(row)
        held += len(row["terms"])
        if len(items) >= BLOCK_ITEMS or held >= BLOCK_TERMS:
            yield items
            items, held = [], 0
    if items:
        yield items


def best_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    asked = stored(query_terms(items), "query-terms")
    terms = asked.select("term").distinct()
    # a small vocabulary goes to the indexing tasks, which then keep only its postings
    vocabulary = None
    if terms.count() <= BLOCK_TERMS:
        vocabulary = np.sort(np.array([r["term"] for r in terms.collect()], np.int64).view(U))
    index = build_index(docs, vocabulary)
    size = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = size["n"] or 0, size["l"] or 0
    df = (index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p"))
          .groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.counts").cast("long").alias("df")))
    weighted = stored(asked.join(df, "term"), "query-weights")
    found = None
    for rows in _blocks(weighted):
        block = Block([r["item_id"] for r in rows],
                      [np.array([t["term"] for t in r["terms"]], np.int64).view(U) for r in rows],
                      [weights(n_docs, np.array([t["df"] for t in r["terms"]], float))
                       * np.array([t["repeats"] for t in r["terms"]], np.int64) for r in rows])
        part = stored(index.select("doc_ids", "lengths", "terms", "counts", "docs", "freqs").mapInArrow(
            _search(block, n_docs, n_terms, k), "item_id long, doc_id long, score long")
            .withColumn("salt", F.spark_partition_id() % SALTS), "search-best")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for group in (["item_id", "salt"], ["item_id"]):  # no item's rows of all tasks meet uncut
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")


def op11_rmq_ranked_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    return best_documents(docs, items)


def oracle_sql(k: int = TOP) -> str:
    """DuckDB SQL of ``best_documents`` that scores every document."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = (f"regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rid, {found} AS terms FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT rid, doc_id, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
postings AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM docs) GROUP BY rid, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term, n_docs),
asked AS (
  SELECT item_id, term, count(*) AS repeats
  FROM (SELECT item_id, unnest({found}) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY item_id, term),
norms AS (SELECT rid, doc_id, 100 - {B} + (({B} * n * n_docs) // n_terms) AS m FROM lengths, corpus),
scores AS (
  SELECT item_id, rid, doc_id,
         CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + {K1} * m))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN postings USING (term) JOIN norms USING (rid)
  GROUP BY item_id, rid, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores WHERE score > 0) WHERE rank <= {k}"""
