"""Toxicity by compression distance: two zstandard dictionaries, one per class.

A text is read in windows of a few words.  A window's margin is how many bytes
shorter it compresses with the toxic dictionary than with the ordinary one.  Most windows
of a toxic text are ordinary, so the toxic dictionary is trained on the windows that
toxic documents hold much more often than ordinary ones; the ordinary dictionary is trained
on all windows of ordinary documents.  Matches inside words count, so inflected
forms that were never seen still compress with the toxic dictionary.

The evidence of a margin, by window length, is its log-likelihood ratio between the classes, taken where it is a clear
sign; a document's evidence is the sum over its windows, and a logistic curve of the
logarithm of one plus the evidence turns it into the score (of the plain sum, texts with
much evidence would flatten the curve and texts with a few clear signs stay below the threshold).  Evidence and curve are fitted on documents that the dictionaries
used for them have not seen (two halves, each judged by the other's dictionaries).

Fitted on the driver on at most ``fit_rows`` labelled documents per class and ``fit_bytes`` of text;
scoring runs over whole texts, and a worker compresses each distinct window once.

Defined results: null and empty texts have no windows and get the curve's value for no
evidence; with labels of one class only, every score is that class's share; repeated rows score
alike; a null doc_id is not held out; ids labelled both 0 and 1 are not learnt from; an empty table gives
no rows; other columns, labels, language and source are never inputs of a score.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW_WORDS = 1
DICT_BYTES = 32_768
FIT_ROWS = 3000
FIT_BYTES = 24 << 20
#: a block must shrink by a few bytes or zstandard stores it raw; written so many times in a row, a
#: short window always shrinks, and what differs is how its first time is written
REPEAT = 4
#: a window distinguishes toxic text if it is in so many times the share of toxic documents (two
#: deviations of its count allowed for), and in so many documents and such a share of them
CONTRAST = 8.0
LEAST_DOCS = 3
LEAST_SHARE = 0.01
#: evidence below this is no sign
CLEAR = 1.0
#: margins are clipped to -LIMIT..LIMIT
LIMIT = 12
#: evidence is fitted apart for windows of up to so many bytes (short ones save less)
LENGTHS = (4, 5, 6, 7, 8, 10)
BINS = (len(LENGTHS) + 1) * (2 * LIMIT + 1)
#: distinct windows a worker remembers before it starts afresh
CACHE_WINDOWS = 400_000
THRESHOLD = 0.7


def windows(text: str | None, width: int = WINDOW_WORDS) -> list[bytes]:
    """The windows of a text: words in lower case."""
    found = (text or "").lower().encode("utf-8").split()
    return found if width == 1 else [b" ".join(found[i:i + width]) for i in range(0, len(found), width)]


def one_of_each(docs: list[list[bytes]]) -> list[list[bytes]]:
    """Documents without their near copies: one of those whose rare windows hash lowest alike."""
    held = Counter(w for d in docs for w in set(d))
    rare = max(2, 0.02 * len(docs))
    return list({tuple(sorted(zlib.crc32(w) for w in set(d) if held[w] <= rare)[:2]): d for d in docs}.values())


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Short matches count: the windows are a few words long."""
    how = zstandard.ZstdCompressionParameters(window_log=17, chain_log=12, hash_log=13, search_log=4, min_match=4,
                                              target_length=8, strategy=zstandard.STRATEGY_LAZY2,
                                              write_content_size=False, write_dict_id=False, write_checksum=False)
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=how)


def train(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; what is too little for the trainer is the dictionary itself."""
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:].rjust(8)


def distinctive(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> list[bytes]:
    """Windows that toxic documents hold far more often, the most frequent last (cheapest to refer to)."""
    inside, outside = (Counter(w for d in docs for w in set(d)) for docs in (toxic, ordinary))
    rate = (len(ordinary) + 1) / (len(toxic) + 1)
    least = min(len(toxic), max(LEAST_DOCS, LEAST_SHARE * len(toxic)))
    found = [w for w, n in inside.items()
             if n >= least and (n - 2 * n ** 0.5 + 1) * rate >= CONTRAST * (outside[w] + 0.5)]
    return sorted(found, key=lambda w: (inside[w], w))


def dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionaries."""
    signs = distinctive(toxic, ordinary)
    return train([b" " + w + b" " for d in ordinary for w in sorted(set(d))]), b"".join(b" " + w + b" " for w in signs)[-DICT_BYTES:].rjust(8)


class Margins:
    """Window -> bin of its length and of the bytes saved by the toxic dictionary, remembered per window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = _compressor(ordinary), _compressor(toxic)
        self.known: dict[bytes, int] = {}

    def of(self, found) -> list[int]:
        if len(self.known) > CACHE_WINDOWS:
            self.known = {}
        known, a, b = self.known, self.ordinary.compress, self.toxic.compress
        for w in [w for w in set(found) if w not in known]:
            block = (b" " + w + b" ") * REPEAT
            margin = max(-LIMIT, min(LIMIT, len(a(block)) - len(b(block))))
            known[w] = bisect_left(LENGTHS, len(w)) * (2 * LIMIT + 1) + margin + LIMIT
        return [known[w] for w in found]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray  # evidence of each bin
    curve: tuple[float, float]  # slope and intercept of the logistic curve over log(1 + evidence)

    def scorer(self):
        margins, weights, (slope, start) = Margins(self.ordinary, self.toxic), self.weights.tolist(), self.curve
        known: dict[bytes, float] = {}

        def score(text: str | None) -> float:
            found = windows(text)
            fresh = [w for w in set(found) if w not in known]
            if fresh:
                if len(known) > CACHE_WINDOWS:
                    known.clear()
                    fresh = list(set(found))
                known.update(zip(fresh, [weights[k] for k in margins.of(fresh)]))
                margins.known.clear()
            evidence = math.log1p(sum([known[w] for w in found]))
            return 1 / (1 + math.exp(-min(35.0, max(-35.0, slope * evidence + start))))
        return score


def _histograms(margins: Margins, docs: list[list[bytes]]) -> np.ndarray:
    return np.array([np.bincount(margins.of(d), minlength=BINS) for d in docs]).reshape(-1, BINS)


def _evidence(toxic: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Smoothed log-likelihood ratio of every margin, 0 where it is no clear sign."""
    p, q = toxic.sum(0) + 1.0, ordinary.sum(0) + 1.0
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    return np.where(ratio >= CLEAR, ratio, 0.0)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps with a small ridge."""
    scale = max(float(np.abs(x).max()), 1e-9)
    z, w = np.column_stack([x / scale, np.ones(len(x))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-2 * np.eye(2), z.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def fit(rows: list[tuple[str | None, int]], width: int = WINDOW_WORDS) -> Model:
    """Dictionaries, evidence and curve from (text, label) rows."""
    sets = {label: one_of_each([windows(t, width) for t, l in rows if l == label]) for label in (0, 1)}
    if not sets[0] or not sets[1]:
        share = float(np.clip(np.mean([l for _, l in rows]) if rows else 0.0, 1e-6, 1 - 1e-6))
        return Model(b" " * 8, b" " * 8, np.zeros(BINS), (0.0, float(np.log(share / (1 - share)))))
    halves = [{label: docs[h::2] or docs for label, docs in sets.items()} for h in (0, 1)]
    judged = []
    for h in (0, 1):
        judge = Margins(*dictionaries(halves[1 - h][1], halves[1 - h][0]))
        judged.append([_histograms(judge, halves[h][label]) for label in (0, 1)])
    weights = _evidence(np.concatenate([j[1] for j in judged]), np.concatenate([j[0] for j in judged]))
    x = np.log1p(np.concatenate([j[label] @ weights for j in judged for label in (0, 1)]))
    y = np.concatenate([np.full(len(j[label]), float(label)) for j in judged for label in (0, 1)])
    return Model(*dictionaries(sets[1], sets[0]), weights, _logistic(x, y))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is never learnt from (a row without doc_id: no, it has no label)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def bounded_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, text_bytes: int
                   ) -> list[tuple[str | None, int]]:
    """(text, label) of at most ``per_class`` rows of each label and ``text_bytes`` in all.

    Only rows whose crc32(doc_id as text) mod 3 is not 1 are learnt from; those whose ids hash lowest
    are taken; ids labelled both ways are left out.  The ids are chosen from the labels alone, so at most twice ``per_class`` ids are broadcast to
    find their texts and no text is shuffled but theirs.  A text that does not fit into what is left of its
    class's half is skipped; only the texts that are taken reach the driver.  Where no text with characters
    fits, the first one's start is taken, so that no class goes without.
    """
    rows = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")).dropna()
            .filter(~held_out(F.col("_id")) & F.col("label").isin(0, 1))
            .groupBy("_id").agg(F.min("label").alias("label"), F.max("label").alias("_most"))
            .filter("label = _most").drop("_most"))
    lowest = [rows.filter(F.col("label") == k).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for k in (0, 1)]
    chosen = F.broadcast(lowest[0].unionByName(lowest[1]).dropDuplicates(["_id"]))
    found = stored(docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id"))
                   .select("_id", "text", "label", F.monotonically_increasing_id().alias("rid")), "labelled-sample")
    half, order = text_bytes // 2, (F.xxhash64("_id"), "_id", "text")
    out: list[tuple[str | None, int]] = []
    for k in (0, 1):
        mine, left, taken, long = found.filter(F.col("label") == k), half, [], None
        sizes = mine.orderBy(*order).select("rid", F.coalesce(F.char_length("text"), F.lit(0)).alias("size"))
        for row in sizes.toLocalIterator():
            if row["size"] <= left:
                left -= row["size"]
                taken.append(row["rid"])
            elif long is None:
                long = row["rid"]
        if left == half and long is not None:
            taken.append(long)
        ids = found.sparkSession.createDataFrame([(i,) for i in taken], "rid long")
        texts = mine.join(F.broadcast(ids), "rid").withColumn("text", F.substring("text", 1, half))
        out += [(row["text"], k) for row in texts.orderBy(*order).toLocalIterator()]
    return out


def score_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(bounded_sample(docs, labels, "toxic", fit_rows, fit_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            found = [score(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def op2_compression_distance(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, labels)
