"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates.

A text's tokens are its runs of letters and its runs of signs.  Features are hashed
unigrams and bigrams of tokens and of token shapes (letters or signs, capitals, length), and
one indicator each for the text's length and for the share of its bigrams that it repeats.  A
feature's value is its share of the text's features, so a score is the mean weight of the
features: a sparse dot product over whole texts, computed on Arrow batches with numpy.

Weights come from follow-the-regularised-leader (proximal) updates on the driver over at
most ``fit_rows`` labelled documents per class and ``fit_bytes`` of text; scoring is a narrow map.

Defined results: null and empty texts have the two indicators only; with no labels every
score is one half; repeated rows score alike; a null doc_id is not held out; ids labelled
both 0 and 1 are not learnt from; an empty table gives no rows; other columns, labels, language
and source are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .toxicity import bounded_sample, held_out
from .wordhash import MIX_A, SECOND_BASE, U, mixed, owners, slices, text_buffers, word_hashes

BITS = 18
FIT_ROWS = 6000
FIT_BYTES = 24 << 20
EPOCHS = 3
ALPHA, BETA, L1, L2 = 4.0, 1.0, 0.02, 0.02
#: a feature's share of a text is multiplied by this
SCALE = 8.0
THRESHOLD = 0.5
_SPACE, _LETTER, _SIGN = 0, 1, 2
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[128:] = _LETTER
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = _LETTER
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, token offsets of the texts) of the runs of letters and of signs."""
    kind = _CLASS[raw]
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    start, stop = cuts[:-1], cuts[1:]
    solid = kind[start] != _SPACE if len(raw) else np.zeros(0, bool)
    start, stop = start[solid], stop[solid]
    return start, stop, np.searchsorted(start, offsets)


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, offsets of the texts) of a string column; repeats stand for counts."""
    raw, ends = text_buffers(column)
    start, stop, at = tokens(raw, ends)
    n_texts, text = len(ends) - 1, owners(at)
    word = word_hashes(raw, start, stop)
    length = stop - start
    capitals = np.concatenate(([0], np.cumsum(_UPPER[raw])))
    big = capitals[stop] - capitals[start] if len(raw) else length
    letters = _CLASS[raw[start]] == _LETTER if len(raw) else np.zeros(0, bool)
    first = _UPPER[raw[start]] if len(raw) else length
    shape = np.where(letters, 16 + 4 * np.minimum(length // 4, 5) + 2 * (big == length) + first,
                     200 + np.minimum(length, 8)).astype(U)
    shape = mixed(shape * SECOND_BASE)
    pair = text[1:] == text[:-1]
    bigram = mixed(word[:-1] * MIX_A + word[1:])
    shapes = mixed(shape[:-1] * MIX_A + shape[1:] + U(1))
    # the share of a text's bigrams that it has had before
    inside = bigram[pair] ^ mixed(text[1:][pair].astype(U) + U(7))
    distinct = np.unique(inside, return_index=True)[1]
    n_pairs = np.bincount(text[1:][pair], minlength=n_texts)
    n_new = np.bincount(text[1:][pair][distinct], minlength=n_texts)
    repeated = (10 * (n_pairs - n_new) // np.maximum(n_pairs, 1)).astype(U)
    long = np.log2(np.diff(at) + 1).astype(U)
    whole = np.arange(n_texts)
    number = np.concatenate([word, bigram[pair], shape, shapes[pair], mixed(repeated + U(1000)), mixed(long + U(2000))])
    owner = np.concatenate([text, text[1:][pair], text, text[1:][pair], whole, whole])
    order = np.argsort(owner, kind="stable")
    return (number[order] >> U(64 - bits)).astype(np.int64), np.searchsorted(owner[order], np.arange(n_texts + 1))


def fit(rows: list[tuple[str | None, int]], bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """(weights, intercept) by per-coordinate FTRL-proximal steps, one document at a time."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    bias = 1 << bits
    examples = []
    for lo in range(0, len(rows), 500):
        number, at = features(pa.array([t for t, _ in rows[lo:lo + 500]], pa.string()), bits)
        for i, (_, label) in enumerate(rows[lo:lo + 500]):
            index, count = np.unique(number[at[i]:at[i + 1]], return_counts=True)
            examples.append((np.append(index, bias), np.append(SCALE * count / count.sum(), 1.0), label))

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    rng = np.random.default_rng(1)
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            i, x, y = examples[k]
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / ALPHA * w
            n[i] = grown
    w = weights(slice(None))
    return w[:-1], float(w[-1])


def predict(column: pa.Array, weights: np.ndarray, start: float, bits: int = BITS) -> np.ndarray:
    number, at = features(column, bits)
    if not len(column):
        return np.zeros(0)
    sums = np.add.reduceat(weights[number], at[:-1])  # every text has at least its indicators
    return 1 / (1 + np.exp(-np.clip(SCALE * sums / np.diff(at) + start, -35, 35)))


def score_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    weights, start = fit(bounded_sample(docs, labels, "quality", fit_rows, fit_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=1 << 20):
                yield pa.record_batch([part.column("doc_id"), pa.array(predict(part.column("text"), weights, start))],
                                      names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def op10_ftrl_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, labels)
