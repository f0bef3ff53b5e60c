"""Minimum-bin-slack packing of tokenised documents into sequences of ``capacity`` tokens.

Lengths are whole numbers from 1 to ``capacity``, so the packing problem is the
histogram of lengths, however many documents there are.  The packer works on that
histogram: per bin it takes the longest length left as the seed, finds by subset-sum
dynamic programming on bitsets the fullest combination of the lengths left, and
removes it, as often as the counts allow at once.  Each step uses up a length, so
there are at most a few thousand distinct bins.  Pieces are numbered within their
length without gaps and meet the bins in an equi-join on (length, range of numbers).

Defined results: a null or empty text is the end token alone; repeated rows are
separate documents and are packed separately; an empty table gives no rows; only
documents longer than ``capacity`` are cut, the first piece taking the remainder.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import buckets_for, digest_number, stored
from .wordhash import slices

CAPACITY = 1024
END_ID = 2
#: distinct chunks whose ids a worker remembers (about 60 bytes each); beyond it, it starts afresh
CACHE_CHUNKS = 600_000
#: text bytes that are encoded at a time, which bounds the arrays a task holds
SLICE_BYTES = 4 << 20
#: chunks that are strung together
STRING = 2000
#: numbers that one range cell of a length covers when pieces look up their bin
RANGE = 4096

PIECES = "rid long, doc_id long, piece int, start long, length int, ids_crc32 long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkTokenizer:
    """Token ids of texts by the ``tokenizers`` library, which sees a distinct chunk of them once.

    A chunk is a space and what follows up to the next one.  The byte-level pre-tokeniser never joins a single
    space that follows a visible character with what stands before it, so chunks can be encoded in any
    company: new ones are strung together, and the bytes that ids stand for tell where each one ends.
    A text in which a space touches other white space, or that holds one of the file's added tokens (as
    text they count as that token), is encoded by itself; so is every text if the file normalises or
    pre-tokenises in another way.  A test compares the ids with those of whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.added = [t["content"] for t in spec["added_tokens"]]
        step = spec["pre_tokenizer"] or {}
        self.chunked = (spec["normalizer"] is None and step.get("type") == "ByteLevel" and step.get("use_regex", True)
                        and not step.get("add_prefix_space"))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)  # a byte-level token has a character per byte
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.starts, self.lengths, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: pa.Array) -> None:
        """Encode new chunks, strung together ``STRING`` at a time."""
        chunks = pa.concat_arrays([chunks])  # without an offset
        ends = np.frombuffer(chunks.buffers()[1], np.int64)[:len(chunks) + 1]
        raw = bytes(chunks.buffers()[2] or b"")[:ends[-1]]
        cuts = [*ends[:-1:STRING].tolist(), int(ends[-1])]
        found = self._encode([raw[lo:hi].decode() for lo, hi in zip(cuts, cuts[1:])])
        ids = np.fromiter((i for x in found for i in x), "<u4", sum(map(len, found)))
        at = np.searchsorted(np.cumsum(self.bytes_of[ids]), ends[1:]) + 1
        lengths = np.diff(at, prepend=0)
        self.starts = np.concatenate([self.starts, len(self.ids) + at - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        self.known = pa.concat_arrays([self.known, chunks])

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): little-endian unsigned 32-bit ids of the texts, one after the other; null texts are empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        parts = pc.split_pattern(texts, " ")
        cuts = parts.offsets.to_numpy().astype(np.int64)
        cuts = cuts - cuts[0]
        flat = parts.flatten().dictionary_encode()
        which, distinct = flat.indices.to_numpy(), flat.dictionary
        # white space at an end touches a space, and so does an empty part
        size = pc.binary_length(distinct)
        loose = pc.or_(pc.equal(size, 0), pc.not_equal(size, pc.binary_length(pc.utf8_trim_whitespace(distinct))))
        loose = loose.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(texts)), np.diff(cuts))
        whole = np.bincount(owner, loose[which], minlength=len(texts)) > 0
        if not self.chunked:
            whole[:] = True
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        chunks = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), distinct, pa.scalar(" ", pa.large_string()))
        if len(self.known) > CACHE_CHUNKS:
            self._forget()
        at = pc.index_in(chunks, self.known)
        new = pc.and_(at.is_null(), pa.array(~loose))
        if pc.any(new).as_py():
            self._learn(chunks.filter(new))
            at = pc.index_in(chunks, self.known)
        number = at.fill_null(0).to_numpy()
        starts, lengths = (np.where(loose, 0, x[number]) if len(x) else np.zeros(len(loose), np.int64)
                           for x in (self.starts, self.lengths))
        starts, lengths = starts[which], lengths[which]
        # a text's first part has no space before it; it, or the whole text, is encoded by itself
        first = texts.to_pylist() if whole.all() else pc.list_element(parts, 0).to_pylist()
        for k in np.flatnonzero(whole).tolist():
            first[k] = texts[k].as_py()
        found = self._encode(first)
        lengths[whole[owner]] = 0
        lengths[cuts[:-1]] = own = np.fromiter(map(len, found), np.int64, len(found))
        starts[cuts[:-1]] = len(self.ids) + np.cumsum(own) - own
        pool = np.concatenate([self.ids, np.fromiter((i for x in found for i in x), "<u4", int(own.sum()))])
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        out = pool[np.repeat(starts - ends + lengths, lengths) + np.arange(total)]
        return out, np.concatenate([[0], ends[cuts[1:] - 1]]) if len(texts) else np.zeros(1, np.int64)


_ENCODERS: dict[str, ChunkTokenizer] = {}


def encoder_of(path: str) -> ChunkTokenizer:
    """One per worker process, which keeps its chunks from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkTokenizer(path)
    return _ENCODERS[path]


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the remainder comes first."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return ([(0, first)] if first else []) + [(s, capacity) for s in range(first, n, capacity)]


def tokenised_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """One row per piece; ``ids`` holds the token ids unless ``keep_ids`` is off."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                ids, at = encoder.encoded(part.column("text"))
                # the end token after every text
                ids = np.insert(ids, at[1:], end)
                at = at + np.arange(len(at))
                raw = ids.tobytes()
                docs, cols = part.column("doc_id").to_pylist(), [[], [], [], [], [], []]
                for doc, lo, hi in zip(docs, at[:-1].tolist(), at[1:].tolist()):
                    for k, (s, n) in enumerate(cut_points(hi - lo, capacity)):
                        piece = raw[4 * (lo + s):4 * (lo + s + n)]
                        for c, v in zip(cols, (doc, k, s, n, zlib.crc32(piece), piece if keep_ids else None)):
                            c.append(v)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=names)
            pa.default_memory_pool().release_unused()

    schema = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary"
    return rows.mapInArrow(cut, schema).withColumn("rid", F.monotonically_increasing_id())


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths, each used at most ``counts`` times, whose sum is the largest not above ``room``.

    ``reach`` is a bitset of sums; the layers say which length first reached a sum.
    Longer lengths come first, so short ones stay for later bins.
    """
    limit = (1 << (room + 1)) - 1
    reach, layers = 1, []
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        for _ in range(min(counts[length], room // length)):
            wider = (reach | (reach << length)) & limit
            if wider == reach:
                break
            layers.append((length, reach))
            reach = wider
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, []
    for length, before in reversed(layers):
        if not before >> total & 1:
            out.append(length)
            total -= length
    return out


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """[(lengths of a bin with their multiplicity, how many such bins)], longest seed first."""
    left = {n: c for n, c in histogram.items() if c > 0}
    bins = []
    while left:
        seed = max(left)
        left[seed] -= 1
        content = {seed: 1}
        for length in fullest(left, capacity - seed):
            content[length] = content.get(length, 0) + 1
        left[seed] += 1
        times = min(left[n] // k for n, k in content.items())
        for n, k in content.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        bins.append((content, times))
    return bins


def bin_ranges(bins: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, lo, hi, first bin, copies per bin, offset): numbers lo..hi-1 of a length fill
    bins from ``first bin`` on, ``copies per bin`` in each, from ``offset`` on."""
    out, used, first = [], {}, 0
    for content, times in bins:
        offset = 0
        for length in sorted(content, reverse=True):
            copies = content[length]
            lo = used.get(length, 0)
            used[length] = lo + copies * times
            out.append((length, lo, used[length], first, copies, offset))
            offset += copies * length
        first += times
    return out


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` and a unique ``rid``."""
    spark = pieces.sparkSession
    # at most ``capacity`` rows: a bounded histogram
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges = bin_ranges(pack_histogram(histogram, capacity))
    cells = buckets_for(sum(histogram.values()))
    cut = pieces.withColumn("_cell", digest_number(F.lit("pack"), F.col("rid")) % cells)
    counts = cut.groupBy("length", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("length", "_cell").orderBy("rid")
    numbered = (cut.join(starts, ["length", "_cell"])
                .withColumn("_k", F.col("_start") + F.row_number().over(inside) - 1).drop("_cell", "_start")
                .withColumn("_range", F.floor(F.col("_k") / RANGE)))
    plan = spark.createDataFrame(ranges, T.StructType([
        T.StructField(n, T.IntegerType() if n in ("length", "copies", "base") else T.LongType())
        for n in ("length", "lo", "hi", "first", "copies", "base")]))
    plan = plan.withColumn("_range", F.explode(F.sequence(F.floor(F.col("lo") / RANGE),
                                                          F.floor((F.col("hi") - 1) / RANGE))))
    found = numbered.join(plan, ["length", "_range"]).filter("_k >= lo AND _k < hi")
    within = F.col("_k") - F.col("lo")
    return (found.withColumn("sequence_id", (F.col("first") + F.floor(within / F.col("copies"))).cast("long"))
            .withColumn("offset", (F.col("base") + (within % F.col("copies")) * F.col("length")).cast("long"))
            .drop("_k", "_range", "lo", "hi", "first", "copies", "base"))


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
                   keep_ids: bool = True) -> DataFrame:
    """Tokenise, cut and pack; the pieces are written once, as every later step reads them."""
    pieces = tokenised_pieces(docs, tokenizer_path or default_tokenizer(), capacity, keep_ids)
    return pack_pieces(stored(pieces, "pack-pieces"), capacity)


def op6_minimum_bin_slack(docs: DataFrame) -> DataFrame:
    packed = pack_documents(docs, keep_ids=False)
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                         "sequence_id", "offset")
