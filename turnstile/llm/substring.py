"""Substring deduplication: winnowed anchors seed matches that are extended both ways.

A repeat is a window of ``min_words`` words that also starts in an earlier document
(smaller doc_id).  Any such window holds a winnowed anchor (the gram of ``gram``
words with the smallest hash in the window), so documents that share a window share
its anchor:

1. *Seed.*  Every anchor occurrence is a row: the anchor's hash, the hash of its
   context (all words of the windows it was chosen for) and the document.  A task first
   merges its own equal rows, so a passage that a third of the documents hold sends one
   row per task; documents beyond the first are already known to repeat it.
2. *Join on anchors.*  Rows are dealt by anchor.  Equal contexts are one class; all of
   its documents but the smallest repeat the whole context.
3. *Extend.*  Where an anchor has several contexts, the smallest document of each class
   lays out the windows around the anchor, left and right, and the windows (128-bit hashes of
   their words) are joined: whichever also starts in a smaller document is a repeat.
4. *Maximal repeats.*  A document's repeated windows are merged into maximal spans, and
   the words they cover are removed.

No pair of documents is ever formed, so groups of copies cost as much as their words.

Defined results: a null doc_id is ordered before all others; a null text has no words;
texts shorter than the threshold keep all; equal doc_ids count as one document and never
repeat each other; an empty table gives no rows; extra columns are kept by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .wordhash import SECOND_BASE, U, Prefix, hashed_texts, owners, slices, text_buffers, word_hashes, word_spans

MIN_WORDS = 13
GRAM = 6
#: rows a task gathers before it sends them merged
FLUSH = 1_000_000
LOWEST = -(1 << 63)
_PACKED = "bucket int, kind int, a binary, b binary, doc binary"
_ANSWER = "doc_id long, kind int, hash long"
#: kinds of answers: the document repeats the context / lay out the context's windows / repeats the window
REPEATS, LAY_OUT, WINDOW = 0, 1, 2


def anchors(hashes: np.ndarray, offsets: np.ndarray, min_words: int, gram: int):
    """Anchor occurrences of the texts of a batch.

    Returns (gram hash, first window start, last window start, text) per occurrence; windows
    [first, last] are those the gram was chosen for, leftmost smallest hash first.
    """
    n, span = len(hashes), min_words - gram + 1
    none = (np.zeros(0, U), *[np.zeros(0, np.int64)] * 3)
    if n < min_words:
        return none
    text = owners(offsets)
    at = np.arange(n - gram + 1)
    grams = Prefix(hashes).hashes(at, at + gram)
    m = n - min_words + 1
    best, place = grams[:m].copy(), np.arange(m)
    for k in range(1, span):
        other = grams[k:k + m]
        less = other < best
        best[less] = other[less]
        place[less] = np.flatnonzero(less) + k
    inside = text[:m] == text[min_words - 1:]
    start = np.flatnonzero(inside)
    if not len(start):
        return none
    place = place[start]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return best[start[first]], start[first], start[last], text[start[first]]


def _contexts(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, min_words: int) -> np.ndarray:
    return Prefix(hashes, SECOND_BASE).hashes(first, last + min_words)


def _merge(a: np.ndarray, b: np.ndarray, doc: np.ndarray):
    """Sort rows by (a, b, doc), drop equal ones; also where each (a, b) class begins."""
    order = np.lexsort((doc, b, a))
    a, b, doc = a[order], b[order], doc[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    fresh = new.copy()
    fresh[1:] |= doc[1:] != doc[:-1]
    return a[fresh], b[fresh], doc[fresh], new[fresh]


def _packed(a: np.ndarray, b: np.ndarray, doc: np.ndarray, kind: int, buckets: int, by: np.ndarray):
    """One row per bucket that has any of the given rows; a row's bucket is ``by`` modulo their number."""
    where = (by % U(buckets)).astype(np.int32)
    order = np.argsort(where, kind="stable")
    where, a, b, doc = where[order], a[order], b[order], doc[order]
    used, starts = np.unique(where, return_index=True)
    stops = np.append(starts[1:], len(where))
    cut = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(starts, stops)], pa.binary())
    return pa.record_batch([pa.array(used, pa.int32()), pa.array(np.full(len(used), kind, np.int32)),
                            cut(a), cut(b), cut(doc)], names=["bucket", "kind", "a", "b", "doc"])


def _joined(parts: list[tuple]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*parts)]


def _send(parts: list[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Merge a task's rows; later documents of a class already known to repeat go where their document says."""
    a, b, doc, new = _merge(*_joined(parts))
    yield _packed(a[new], b[new], doc[new], LAY_OUT, buckets, a[new] >> U(3))
    later = ~new
    if later.any():
        yield _packed(a[later], b[later], doc[later], REPEATS, buckets, doc[later].view(U) * SECOND_BASE >> U(7))


def _doc_ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").cast(pa.int64()).fill_null(LOWEST).to_numpy(zero_copy_only=False)


def _seed(buckets: int, min_words: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for part in slices(batch):
                hashes, offsets = hashed_texts(part.column("text"))
                a, first, last, text = anchors(hashes, offsets, min_words, gram)
                parts.append((a, _contexts(hashes, first, last, min_words), _doc_ids(part)[text]))
                held += len(a)
                if held >= FLUSH:
                    yield from _send(parts, buckets)
                    parts, held = [], 0
        if held:
            yield from _send(parts, buckets)
    return run


def _read(batches: Iterator[pa.RecordBatch]):
    """All rows of a partition by kind: {kind: (a, b, doc)}."""
    parts: dict[int, list] = {}
    for batch in batches:
        cols = batch.to_pydict()
        for kind, *values in zip(cols["kind"], cols["a"], cols["b"], cols["doc"]):
            parts.setdefault(kind, []).append([np.frombuffer(v, t) for v, t in zip(values, (U, U, np.int64))])
    return {k: _joined(v) for k, v in parts.items()}


def _answers(doc: np.ndarray, kind: int, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(doc), 100_000):
        part = slice(lo, lo + 100_000)
        yield pa.record_batch([pa.array(doc[part], pa.int64()), pa.array(np.full(len(doc[part]), kind, np.int32)),
                               pa.array(hashes[part].view(np.int64), pa.int64())], names=["doc_id", "kind", "hash"])


def _match_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of equal contexts; anchors with several classes are to be laid out."""
    rows = _read(batches)
    if REPEATS in rows:
        _, b, doc = rows[REPEATS]
        yield from _answers(doc, REPEATS, b)
    if LAY_OUT not in rows:
        return
    a, b, doc, new = _merge(*rows[LAY_OUT])
    yield from _answers(doc[~new], REPEATS, b[~new])
    a, b, doc = a[new], b[new], doc[new]  # one row per class, its smallest document
    same = np.zeros(len(a), bool)
    equal = a[1:] == a[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    yield from _answers(doc[same], LAY_OUT, b[same])


def _lay_out(buckets: int, min_words: int, gram: int):
    """Windows around the anchors whose contexts are asked for, extended left and right."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for part in slices(batch):
                hashes, offsets = hashed_texts(part.column("text"))
                _, first, last, text = anchors(hashes, offsets, min_words, gram)
                asked = _sets(part.column("hashes"))
                wanted = _member(_contexts(hashes, first, last, min_words), text, asked)
                start = _ranges(first[wanted], last[wanted] + 1)
                doc = _doc_ids(part)[np.repeat(text[wanted], (last - first + 1)[wanted])]
                parts.append((Prefix(hashes).hashes(start, start + min_words),
                              Prefix(hashes, SECOND_BASE).hashes(start, start + min_words), doc))
                held += len(doc)
                if held >= FLUSH:
                    yield from _send(parts, buckets)
                    parts, held = [], 0
        if held:
            yield from _send(parts, buckets)
    return run


def _match_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _read(batches)
    if REPEATS in rows:
        a, _, doc = rows[REPEATS]
        yield from _answers(doc, WINDOW, a)
    if LAY_OUT in rows:
        a, _, doc, new = _merge(*rows[LAY_OUT])
        yield from _answers(doc[~new], WINDOW, a[~new])


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, stop), one after another."""
    n = stop - start
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n - start, n)


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner) of a list column; null lists are empty."""
    lengths = np.array([0 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).view(U), np.repeat(np.arange(len(column)), lengths)


def _member(hashes: np.ndarray, text: np.ndarray, asked: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which (hash, text) are among the asked (hash, owner)."""
    if not len(asked[0]) or not len(hashes):
        return np.zeros(len(hashes), bool)
    salt = lambda h, t: h ^ (t.astype(U) * SECOND_BASE)
    return np.isin(salt(hashes, text), salt(*asked))


def _spans(covered: np.ndarray, offsets: np.ndarray, i: int) -> list[tuple[int, int]]:
    """Maximal runs of covered words of text i, as word positions within the text."""
    part = np.concatenate(([0], covered[offsets[i]:offsets[i + 1]].astype(np.int8), [0]))
    edges = np.flatnonzero(np.diff(part))
    return [(int(s), int(e)) for s, e in zip(edges[::2], edges[1::2])]


def _finish(min_words: int, gram: int, carry: list[str], keep_whole: bool):
    names = ["doc_id", "n_words", "n_removed", "kept_text", "spans"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                raw, ends = text_buffers(part.column("text"))
                start, stop, offsets = word_spans(raw, ends)
                covered = np.zeros(len(start) + 1, np.int32)
                if part.column("contexts").null_count + part.column("windows").null_count < 2 * part.num_rows:
                    hashes = word_hashes(raw, start, stop)
                    _, first, last, text = anchors(hashes, offsets, min_words, gram)
                    whole = _member(_contexts(hashes, first, last, min_words), text, _sets(part.column("contexts")))
                    at = _ranges(first[~whole], last[~whole] + 1)
                    hit = _member(Prefix(hashes).hashes(at, at + min_words),
                                  np.repeat(text[~whole], (last - first + 1)[~whole]), _sets(part.column("windows")))
                    np.add.at(covered, first[whole], 1)
                    np.add.at(covered, last[whole] + min_words, -1)
                    np.add.at(covered, at[hit], 1)
                    np.add.at(covered, at[hit] + min_words, -1)
                covered = np.cumsum(covered)[:-1] > 0
                rows = []
                data = raw.tobytes()
                for i, doc in enumerate(part.column("doc_id").to_pylist()):
                    lo, hi = offsets[i], offsets[i + 1]
                    drop = covered[lo:hi]
                    found = data[ends[i]:ends[i + 1]].split()
                    removed = int(drop.sum())
                    if removed:
                        found = [w for w, d in zip(found, drop.tolist()) if not d]
                    kept = data[ends[i]:ends[i + 1]] if keep_whole and not removed else b" ".join(found)
                    rows.append((doc, int(hi - lo), removed, kept.decode("utf-8"),
                                 [{"start": s, "stop": e} for s, e in _spans(covered, offsets, i)] if removed else []))
                cols = list(zip(*rows)) if rows else [[]] * len(names)
                yield pa.record_batch([*[pa.array(c, t) for c, t in zip(cols, types)],
                                       *[part.column(f"in_{c}") for c in carry]],
                                      names=[*names, *[f"in_{c}" for c in carry]])
    return run


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, carry: list[str] = (),
                   keep_whole: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and the removed maximal spans of every document.

    ``carry``: other columns, returned as ``in_<name>``; ``keep_whole``: where nothing is removed,
    ``kept_text`` is the text itself instead of its words joined by one space.
    """
    if not 1 <= gram <= min_words:
        raise ValueError("an anchor must fit into a window")
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    seeds = texts.mapInArrow(_seed(buckets, min_words, gram), _PACKED)
    answers = stored(seeds.repartition(buckets, "bucket").mapInArrow(_match_contexts, _ANSWER), "repeat-contexts")

    def lists(kind: int, source: DataFrame, name: str) -> DataFrame:
        return source.filter(F.col("kind") == kind).groupBy("doc_id").agg(F.collect_list("hash").alias(name))

    def of(frame: DataFrame, found: DataFrame, how: str) -> DataFrame:
        """Join lists to texts; a null doc_id went through the answers as the lowest number."""
        key = F.coalesce(frame["doc_id"], F.lit(LOWEST))
        return frame.join(found.withColumnRenamed("doc_id", "_doc"), key == F.col("_doc"), how).drop("_doc")

    asked = of(texts, lists(LAY_OUT, answers, "hashes"), "inner")
    windows = asked.mapInArrow(_lay_out(buckets, min_words, gram), _PACKED)
    hits = stored(windows.repartition(buckets, "bucket").mapInArrow(_match_windows, _ANSWER), "repeat-windows")

    found = (answers.filter(F.col("kind") == REPEATS).unionByName(hits).groupBy("doc_id")
             .agg(F.collect_list(F.when(F.col("kind") == REPEATS, F.col("hash"))).alias("contexts"),
                  F.collect_list(F.when(F.col("kind") == WINDOW, F.col("hash"))).alias("windows")))
    schema = "doc_id long, n_words long, n_removed long, kept_text string, spans array<struct<start:int,stop:int>>"
    schema += "".join(f", `in_{c}` {kind}" for c, kind in docs.select(*carry).dtypes)
    carried = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(c).alias(f"in_{c}") for c in carry])
    return of(carried, found, "left").mapInArrow(_finish(min_words, gram, list(carry), keep_whole), schema)


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The documents with their kept words as text, other columns as they are; ``n_chars`` follows the text.

    Texts that lose nothing stay as they are (null becomes empty); a document all of whose words are removed goes.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = repeated_spans(docs, carry=others, keep_whole=True, **options)
    found = found.filter((F.col("n_removed") == 0) | (F.col("n_words") > F.col("n_removed")))
    values = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"),
              "n_chars": F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast("long"))}
    if "n_chars" in others:
        values["n_chars"] = F.coalesce(values["n_chars"], F.col("in_n_chars"))
    return found.select(*[values.get(c, F.col(f"in_{c}")).alias(c) for c in docs.columns])


def op3_seed_and_extend(docs: DataFrame) -> DataFrame:
    out = repeated_spans(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def oracle_sql(min_words: int = MIN_WORDS) -> str:
    return f"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT rid, doc_id, i, array_to_string(w[i:i + {min_words - 1}], ' ') AS k
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - {min_words - 2})) AS i FROM split WHERE len(w) >= {min_words})),
firsts AS (SELECT k, min(doc_id) AS first_doc FROM windows GROUP BY k),
covered AS (
  SELECT DISTINCT rid, unnest(range(i, i + {min_words})) AS p
  FROM windows JOIN firsts USING (k) WHERE first_doc < doc_id),
kept AS (
  SELECT w.rid, string_agg(word, ' ' ORDER BY p) AS body, count(*) AS n
  FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM split) w
  ANTI JOIN covered c ON c.rid = w.rid AND c.p = w.p GROUP BY w.rid)
SELECT s.doc_id, CAST(len(s.w) AS BIGINT) AS n_words, CAST(len(s.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.rid = s.rid"""
