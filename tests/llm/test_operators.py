"""Operators of the training-data pipeline against brute force, SQL and edge cases."""

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_near_duplicates import brute
from turnstile.llm import (ann, jaccard, mixing, packing, quality_classifier, quality_rules, queries, sharding, substring,
                           toxicity, warc, wordhash)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash int, in_text string"
PASSAGE = " ".join(f"shared{i}" for i in range(40))


def rows_of(texts):
    return [(i, t, ("en", None)[i % 2], ("a", "b", None)[i % 3], None if t is None else len(t), i, "x")
            for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, copies, shared passages and columns with clashing names."""
    base = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \n\t ", "one", "two words", base, base, base + " tail", "x " * 30, "É " + PASSAGE + " end",
             PASSAGE + " other", "lead " + PASSAGE, "a\x0bb\x0cc", " ".join(f"long{i % 7000}" for i in range(9000)),
             "line one here\nline one here\nline two", "### *** $$$ %%% a b c d e f g h"]
    rows = rows_of(texts)
    return spark.createDataFrame(rows + [rows[5]], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


# ---- words
def test_word_hashes_follow_words():
    texts = [None, "", "a b", "b a", "  lead", "trail  ", "é\x0bb", "x" * 200_000, "a b"]
    found, at = wordhash.hashed_texts(pa.array(texts, pa.string()))
    plain = [words(t) for t in texts]
    assert np.diff(at).tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len(set(zip(flat, found.tolist()))) == len(set(flat)) == len(set(found.tolist()))


# ---- SQL oracles on real tables
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(queries.ORACLE[name])
    columns = sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(c) for c in columns]
    want = Counter(tuple(r[i] for i in at) for r in cur.fetchall())
    got = Counter(map(tuple, queries.QUERIES[name](spark, SF).select(*columns).collect()))
    assert got == want


# ---- 1 sharding
def test_tree_moves_rows_only_where_weights_change(spark):
    ids = spark.range(3000).withColumnRenamed("id", "doc_id")
    tree = sharding.uniform_tree(16)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in tree]
    a = {r["doc_id"]: r for r in sharding.place(ids, "doc_id", tree).collect()}
    b = {r["doc_id"]: r for r in sharding.place(ids, "doc_id", heavier).collect()}
    # outside the region of the heavier shard rows only leave, and only towards it
    assert all(b[k]["region"] == 0 for k in a if a[k]["region"] != b[k]["region"])
    assert all(a[k]["shard"] == b[k]["shard"] for k in a if a[k]["region"] == b[k]["region"] != 0)


def test_sharding_edge_cases(odd, empty):
    out = sharding.op1_hash_tree_sharding(odd).collect()
    assert len(out) == odd.count() and sharding.op1_hash_tree_sharding(empty).count() == 0
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {r["doc_id"]: r["size"] for r in out}[0] == 16


# ---- 2 toxicity, 10 quality
def _labelled(spark, texts, labels):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y, y) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int")


def test_compression_distance_separates_classes(spark):
    rng = np.random.default_rng(3)
    plain = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(400)]
    texts, labels = [], []
    for i in range(400):
        body = list(rng.choice(plain, 40))
        labels.append(int(i % 4 == 0))
        if labels[-1]:
            body[5:5] = ["wretchedly", "vilenesses", "scornful"]
        texts.append(" ".join(body))
    docs, table = _labelled(spark, texts + [None, ""], labels)
    out = {r["doc_id"]: r for r in toxicity.op2_compression_distance(docs, table).collect()}
    held = [i for i in range(400) if out[i]["held_out"]]
    assert held and all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in out)
    assert np.mean([out[i]["predicted"] == labels[i] for i in held]) > 0.95
    assert 0 <= out[400]["score"] == out[401]["score"] <= 1


def test_quality_classifier_separates_classes(spark, empty):
    texts = [("Plain words in a sentence number %d here." % i) if i % 3 else "!!! BUY %d *** NOW ###" % i for i in range(300)]
    docs, table = _labelled(spark, texts + [None, ""], [int(i % 3 > 0) for i in range(300)])
    out = {r["doc_id"]: r for r in quality_classifier.op10_ftrl_quality(docs, table).collect()}
    held = [i for i in range(300) if out[i]["held_out"]]
    assert np.mean([out[i]["predicted"] == int(i % 3 > 0) for i in held]) > 0.95
    assert 0 <= out[300]["score"] == out[301]["score"] <= 1
    none = table.limit(0)
    assert quality_classifier.op10_ftrl_quality(docs, none).count() == 302
    assert toxicity.op2_compression_distance(docs, none).count() == 302
    assert toxicity.op2_compression_distance(empty, none).count() == 0


def test_a_long_text_costs_the_sample_only_itself(spark):
    learnt = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs, table = _labelled(spark, [f"text number {i}" for i in range(60)], [i % 2 for i in range(60)])

    def sample(frame):
        return toxicity.bounded_sample(frame, table, "toxic", 100, 2000)

    plain = sample(docs)
    assert sorted(plain) == sorted((f"text number {i}", i % 2) for i in learnt)
    # the first text of either class is longer than its class's half
    first = [next(t for t, k in plain if k == label) for label in (0, 1)]
    long = docs.withColumn("text", F.when(F.col("text").isin(first), F.repeat("text", 200)).otherwise(F.col("text")))
    assert sample(long) == [x for x in plain if x[0] not in first]
    # every text is: the start of one is taken
    got = sample(docs.withColumn("text", F.repeat("text", 200)))
    assert [(len(t), k) for t, k in got] == [(1000, 0), (1000, 1)]


def test_ids_without_or_with_two_labels(spark):
    docs, table = _labelled(spark, [f"text {i}" for i in range(30)], [i % 2 for i in range(30)])
    both = table.unionByName(table.filter("doc_id = 3").withColumns({"toxic": F.lit(0), "quality": F.lit(0)}))
    assert "text 3" in {t for t, _ in toxicity.bounded_sample(docs, table, "toxic", 100, 2000)} or zlib.crc32(b"3") % 3 == 1
    assert "text 3" not in {t for t, _ in toxicity.bounded_sample(docs, both, "toxic", 100, 2000)}
    odd = docs.unionByName(spark.createDataFrame([(None, "no id")], "doc_id long, text string")).withColumns(
        {"score": F.lit("x"), "label": F.lit(1), "held_out": F.lit(2), "rid": F.lit(3), "_id": F.lit(4)})
    for op in (toxicity.op2_compression_distance, quality_classifier.op10_ftrl_quality):
        out = {r["doc_id"]: r for r in op(odd, both).collect()}
        assert len(out) == 31 and out[None]["held_out"] is False and 0 <= out[None]["score"] <= 1


def test_quality_weights_equal_plain_ftrl():
    """The sparse steps against the update rule written out coordinate by coordinate."""
    import math
    rows = [(f"{'good plain words' if i % 3 else 'BUY !!! $$$ now'} number {i % 7} again", int(i % 3 > 0)) for i in range(40)]
    weights, start = quality_classifier.fit(rows, bits=8, epochs=2)
    number, at = quality_classifier.features(pa.array([t for t, _ in rows]), 8)
    z, n = defaultdict(float), defaultdict(float)
    q = quality_classifier

    def weight(i):
        if abs(z[i]) <= q.L1:
            return 0.0
        return -(z[i] - math.copysign(q.L1, z[i])) / ((q.BETA + math.sqrt(n[i])) / q.ALPHA + q.L2)

    rng = np.random.default_rng(1)
    for _ in range(2):
        for k in rng.permutation(len(rows)):
            counts = Counter(number[at[k]:at[k + 1]].tolist())
            x = {i: q.SCALE * c / sum(counts.values()) for i, c in counts.items()} | {256: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - rows[k][1]) * x[i]
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / q.ALPHA * w[i]
                n[i] += g * g
    assert np.allclose(weights, [weight(i) for i in range(256)], atol=1e-9) and abs(start - weight(256)) < 1e-9


# ---- 3 substring
def brute_substring(rows, size=13):
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - size + 1):
            key = tuple(w[i:i + size])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        drop = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < d:
                drop.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in drop)
        out.append((d, len(w), len(drop), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_substring_matches_brute_force(spark, odd, empty):
    rng = np.random.default_rng(5)
    pool = [" ".join(rng.choice(list("abcdef"), 25)) for _ in range(6)]
    texts = [" ".join([*rng.choice(list("uvwxyz"), rng.integers(0, 9)), str(rng.choice(pool)),
                       *rng.choice(list("uvwxyz"), rng.integers(0, 9)), str(rng.choice(pool))]) for _ in range(120)]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    for frame in (docs, odd):
        got = Counter(map(tuple, substring.op3_seed_and_extend(frame).collect()))
        assert got == brute_substring([(r["doc_id"], r["text"]) for r in frame.collect()])
    assert substring.op3_seed_and_extend(empty).count() == 0
    kept = substring.deduplicated(odd)
    assert kept.columns == odd.columns and "shared5" not in {r["doc_id"]: r["text"] for r in kept.collect()}[10]


# ---- 4 WARC
def test_warc_round_trip_keeps_any_payload(spark, tmp_root):
    html = ["<a>", "<a>", None, "", "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n", "é" * 5000, "<a>"]
    pages = spark.createDataFrame([(i, f"http://h/{i}" if i % 2 else None, h, "z") for i, h in enumerate(html)],
                                  "page_id long, url string, html string, payload string")
    path = tmp_root + "/warc"
    warc.write_archives(pages, path)
    got = {r["page_id"]: r for r in warc.read_archives(spark, path).collect()}
    last = {(h or ""): i for i, h in enumerate(html)}
    for i, h in enumerate(html):
        body = (h or "").encode()
        owner = last[h or ""]
        assert got[i]["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert got[i]["record_type"] == ("response" if owner == i else "revisit")
        assert got[i]["refers_to"] == (None if owner == i else owner)
        assert bytes(got[i]["payload"]) == (body if owner == i else b"") and got[i]["payload_bytes"] == len(body)
    assert warc.op4_warc_revisits(pages.limit(0)).count() == 0


# ---- 5 quality rules
def test_quality_rules_edge_cases(odd, empty):
    out = {r["doc_id"]: r for r in quality_rules.op5_adaptive_quality_rules(odd).collect()}
    assert out[0]["n_words"] == 0 and out[0]["base_failed"] and not out[0]["kept"]
    assert out[8]["n_repeat_words"] == 30 and out[8]["base_failed"]
    assert out[14]["n_dup_lines"] == 1 and out[15]["n_symbols"] == 12
    assert out[13]["n_words"] == 9000 and out[13]["n_repeat_words"] == 4000 and out[5]["kept"]
    assert quality_rules.op5_adaptive_quality_rules(empty).count() == 0
    assert quality_rules.filter_documents(odd).columns == odd.columns


def test_quality_limits_follow_the_group(spark):
    """Equal documents are kept or not by what is usual in their group; small groups take their language's limits."""
    plain = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    rows = []

    def add(n, source, text, lang="en"):
        rows.extend((len(rows), f"{text} x{len(rows)}", lang, source, 0, 0, "x") for _ in range(n))

    add(190, "prose", plain)
    add(10, "prose", plain + " $$$")        # unusual here ...
    add(100, "code", plain + " $$$")        # ... usual here
    add(99, "small", plain + " $$$")        # below MIN_GROUP: judged by the language
    add(1, "small", plain + " $$$ #### %%%% &&& ***** ||||| <<<< >>>>")
    docs = spark.createDataFrame(rows[:-1] + rows[-1:], SCHEMA)
    out = {r["doc_id"]: r["kept"] for r in quality_rules.op5_adaptive_quality_rules(docs).collect()}
    assert all(out[i] for i in range(190)) and all(out[i] for i in range(200, 300))
    assert not any(out[i] for i in range(190, 200))
    exact = [r for r in rows if r[3] == "small"]
    for n, kept in ((100, True), (99, False)):  # a group of its own, or one that its language decides
        few = spark.createDataFrame([r for r in rows if r[3] == "prose" and r[0] < 190] * 20 + exact[:n], SCHEMA)
        got = [r["kept"] for r in quality_rules.op5_adaptive_quality_rules(few).filter("doc_id >= 300").collect()]
        assert sum(got) == (99 if kept else 0)  # the last one of 100 is unusual even in its group
    twice = spark.createDataFrame([(1, plain, "en", "a", 0, 0, "x"), (1, "short", "en", "a", 0, 0, "x")], SCHEMA)
    assert [r["text"] for r in quality_rules.filter_documents(twice).collect()] == [plain]


# ---- 6 packing
def check_packing(pieces):
    fill = defaultdict(list)
    for r in pieces:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in fill.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= packing.CAPACITY
    return len(fill)


def test_packing_is_exact_and_tight(spark, odd, empty):
    out = packing.pack_documents(odd).collect()
    n = check_packing(out)
    total = sum(r["length"] for r in out)
    assert n == -(-total // packing.CAPACITY) or n <= total / packing.CAPACITY + 2
    from public_tokenizers import path
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(path("byte_bpe_50k.json"))
    whole = defaultdict(dict)
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4")
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(ids) == r["length"]
        whole[r["doc_id"]][r["start"]] = ids.tolist()
    for r in odd.collect():
        joined = [i for _, part in sorted(whole[r["doc_id"]].items()) for i in part]
        assert joined == plain.encode(r["text"] or "", add_special_tokens=False).ids + [packing.END_ID]
    assert packing.op6_minimum_bin_slack(empty).count() == 0


def test_tokenizer_chunks_equal_whole_texts():
    from public_tokenizers import path
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(path("byte_bpe_50k.json"))
    texts = ["", " ", "  a b", "a  b", "a\n b", "it's  \n\n x", "tab\t x", "x <|endoftext|> y", "a\x1c b", "é  è",
             " lead trail ", "don 't", "1 22 333,4", "日本 語"]
    texts += ["<|endoftext|>", "<|endoftext|> first", "in <|endoftext|> the middle", "last<|endoftext|>", "<|endoftext", None]
    rng = np.random.default_rng(6)
    signs = list("abcdE1.,'!") + [" ", " ", " ", "\n", "\t", "\u00a0", "\u2003", "é", "日", "\x1c", "'s", "\r\n"]
    texts += ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(2000)]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert 50256 in want[-2006] and 50256 in want[-2003]
    encoder = packing.ChunkTokenizer(packing.default_tokenizer())
    for lo, hi in ((0, len(texts)), (5, 9), (0, 0), (7, 2000)):  # new chunks, known ones, none
        ids, at = encoder.encoded(pa.array(texts, pa.string()).slice(lo, hi - lo))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want[lo:hi]
    held, packing.CACHE_CHUNKS = packing.CACHE_CHUNKS, 10  # the cache starts afresh
    try:
        ids, at = encoder.encoded(pa.array(texts[:40], pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want[:40] and len(encoder.known) < 1000
    finally:
        packing.CACHE_CHUNKS = held


def test_fullest_equals_exhaustive_search():
    rng = np.random.default_rng(8)
    for _ in range(200):
        counts = Counter(rng.integers(1, 20, rng.integers(0, 9)).tolist())
        room = int(rng.integers(0, 40))
        sums = {0}
        for n, k in counts.items():
            sums = {s + n * j for s in sums for j in range(k + 1)}
        chosen = packing.fullest(dict(counts), room)
        assert sum(chosen) == max(s for s in sums if s <= room) and not Counter(chosen) - counts


def test_histogram_packing_fills_bins():
    assert packing.fullest({600: 1, 424: 1, 400: 3, 24: 1}, 1024) in ([600, 424], [424, 600], [400, 600, 24], [24, 400, 600])
    bins = packing.pack_histogram({512: 4, 1024: 2, 1: 3})
    assert sum(t for _, t in bins) == 5
    rng = np.random.default_rng(2)
    lengths = Counter(rng.integers(1, 1025, 5000).tolist())
    bins = packing.pack_histogram(lengths)
    used = Counter()
    for content, times in bins:
        assert sum(n * k for n, k in content.items()) <= 1024
        for n, k in content.items():
            used[n] += k * times
    assert used == lengths
    assert sum(t for _, t in bins) <= sum(n * c for n, c in lengths.items()) / 1024 * 1.01 + 1


# ---- 7 Jaccard join
def test_one_of_each_group_stays(odd):
    out = jaccard.one_per_group(odd)
    assert out.columns == odd.columns
    assert 6 not in {r["doc_id"] for r in out.collect()} and out.count() < odd.count()


# ---- 8 nearest neighbours
def test_ann_recall_and_edge_cases(spark):
    rng = np.random.default_rng(11)
    m = rng.normal(size=(1500, 16))
    m[100:600] = m[100]  # a third are equal
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    rows += [(1500, None), (1520, [0.0] * 16), (1540, [float("nan")] * 16), (1560, [1.0] * 3), (None, m[0].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit("x"))
    found = defaultdict(list)
    for r in ann.op8_inverted_multi_index(frame).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(found) == set(range(0, 1500, 20))
    hit = total = 0
    for q, near in found.items():
        score = m @ m[q]
        score[q] = -np.inf
        edge = np.sort(score)[-20]
        total += 20
        hit += sum(s >= edge - 1e-9 for _, s in near)
        assert len(near) == 20 and near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - m[q] @ m[v]) < 1e-9 for v, s in near)
    assert hit / total >= 0.9
    few = spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>")
    assert ann.op8_inverted_multi_index(few).count() == 4
    assert ann.op8_inverted_multi_index(few.limit(0)).count() == 0


def test_ann_takes_the_common_length(spark):
    m = np.random.default_rng(12).normal(size=(60, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    schema = "vec_id long, embedding array<double>"
    want = ann.op8_inverted_multi_index(spark.createDataFrame(rows, schema)).collect()
    # more of the unusable length than of the common one, and a usable vector that is longer
    odd = [(100 + i, [float("nan")] * 9) for i in range(80)] + [(200, [1.0] * 12)]
    got = ann.op8_inverted_multi_index(spark.createDataFrame(rows + odd, schema)).collect()
    assert len(want) == 60 and sorted(got) == sorted(want)


@pytest.mark.parametrize("n", [500, 6000])
def test_ann_prunes_at_every_size(spark, n):
    rng = np.random.default_rng(13)
    centres = rng.normal(size=(40, 16))
    m = centres[rng.integers(0, 40, n)] + 0.3 * rng.normal(size=(n, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, v array<double>")
    _, share = ann.fit(frame, 16, ann.centroids_for(n), ann.SAMPLE_ROWS, ann.TOP, ann.RECALL)
    assert ann.TOP < share * n < 0.7 * n  # the search leaves cells out
    found = defaultdict(list)
    for r in ann.nearest(frame, frame.filter("vec_id % 20 = 0"), 16).collect():
        found[r["query_id"]].append(r["score"])
    hit = 0
    for q, near in found.items():
        score = m @ m[q]
        score[q] = -np.inf
        hit += sum(s >= np.sort(score)[-20] - 1e-9 for s in near)
    assert len(found) == n // 20 and hit / (20 * len(found)) >= 0.9


# ---- 9 mixing
def test_mixing_targets_and_bounds(odd, empty, spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.mix(docs)
    out = mixing.op9_mix_to_weights(docs).collect()
    taken = defaultdict(int)
    for r in out:
        assert r["taken"] <= 3 * r["size"]
        taken[(r["source_size"], r["target"])] += r["taken"]
    for (size, target), got in taken.items():
        # a multinomial total: within five deviations of its slots
        assert abs(got - target) <= mixing.BLOCK_WORDS * (2 + 5 * (target / mixing.BLOCK_WORDS) ** 0.5) and target <= 3 * size
    # every epoch of a source is a permutation of its blocks
    seen = Counter((r["sid"], r["epoch"], r["block"]) for r in plan.slots.collect())
    assert max(seen.values()) == 1
    small = mixing.op9_mix_to_weights(odd).collect()
    assert len(small) == odd.count() and {r["doc_id"]: r["taken"] for r in small}[0] == 0
    assert mixing.op9_mix_to_weights(empty).count() == 0
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    sizes = Counter({r["doc_id"]: 0 for r in small})
    for r in small:
        sizes[r["doc_id"]] += r["taken"]
    got = Counter()
    for r in mixed.collect():
        got[r["doc_id"]] += len(words(r["text"]))
    assert all(got[d] == sizes[d] for d in sizes)


def test_mixed_texts_are_split_once_not_for_every_take(odd):
    """inside the lambda over a document's takes there are slices of its words, and no text is split."""
    mixed = mixing.mixed_documents(odd)
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("slice(lambda ") == 1 and "slice(array_remove(split(" not in plan
    whole = {r["doc_id"]: words(r["text"] or "") for r in odd.collect()}
    assert all(set(words(r["text"])) <= set(whole[r["doc_id"]]) for r in mixed.collect())


def test_mixing_shards_hold_what_they_drew(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    tiny = spark.createDataFrame([(10 ** 6, "aaa", "few words " * 200)], docs.schema)
    plan = mixing.mix(docs.unionByName(tiny), weights=(5, 2, 1), shard_slots=300)
    sources = sorted(plan.sources.collect(), key=lambda r: r["sid"])
    total, starts = sum(r["quota"] for r in sources), {}
    for r in sources:
        starts[r["sid"]] = sum(q["quota"] for q in sources if q["sid"] < r["sid"])
    draw, counts = {}, Counter()
    for slot in range(total):
        place = int(hashlib.md5(f"{mixing.SEED}:draw:{slot}".encode()).hexdigest()[:13], 16) % total
        draw[slot] = max((r["sid"] for r in sources if r["quota"] and starts[r["sid"]] <= place))
        counts[draw[slot]] += 1
    slots = plan.slots.collect()
    assert len(slots) == len({r["slot"] for r in slots}) == total and len({r["shard"] for r in slots}) > 3
    assert all(r["shard"] == r["slot"] // 300 for r in slots)
    cap = {r["sid"]: 3 * r["blocks"] for r in sources}
    moved = [r for r in slots if r["sid"] != draw[r["slot"]]]
    assert len(moved) == sum(max(0, counts[s] - cap[s]) for s in cap)
    assert all(counts[draw[r["slot"]]] > cap[draw[r["slot"]]] for r in moved)
    got = Counter(r["sid"] for r in slots)
    assert all(got[s] <= cap[s] for s in cap)
    assert len({(r["sid"], r["i"]) for r in slots}) == total
    assert any(abs(got[r["sid"]] - r["quota"]) > 0 for r in sources)
    # rows without an id keep their words too
    bare = odd.withColumn("doc_id", F.lit(None).cast("long"))
    assert mixing.op9_mix_to_weights(bare).count() == odd.count()
    # a source at its cap whose draw passes it: what is beyond goes to the others
    rows = [(i, "ab"[i % 2] if i < 60 else "c", f"w{i} " * 64) for i in range(64)]
    full = mixing.mix(spark.createDataFrame(rows, docs.schema), weights=(1, 1, 40), shard_slots=16)
    used = Counter((r["sid"], r["epoch"], r["block"]) for r in full.slots.collect())
    assert max(used.values()) == 1 and sum(used.values()) == full.sources.agg(F.sum("quota")).first()[0]


# ---- pipeline
def test_pipeline_stages_against_brute_force(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    first = corpus_pipeline.quality_stage(spark, docs, SF).collect()
    want = {r["doc_id"] for r in quality_rules.op5_adaptive_quality_rules(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in first} == want
    frame = spark.createDataFrame(first, docs.schema)
    second = corpus_pipeline.near_duplicate_stage(spark, frame, SF).collect()
    groups = brute([(r["doc_id"], r["text"]) for r in first], 5)
    assert {r["doc_id"] for r in second} == {d for d, g, _ in groups if d == g}
    frame = spark.createDataFrame(second, docs.schema)
    third = corpus_pipeline.substring_stage(spark, frame, SF).collect()
    left = brute_substring([(r["doc_id"], r["text"]) for r in second])
    assert len(third) == sum(n > gone for _, n, gone, _ in left)
    assert all(len(words(r["text"])) == {d: n - gone for d, n, gone, _ in left}[r["doc_id"]] for r in third)
    assert list(third[0].asDict()) == columns
    for stage in (f for _, f in corpus_pipeline.STAGES):
        assert stage(spark, empty, SF).count() == 0
    out = corpus_pipeline.run(spark, SF).collect()
    check_packing(out)
    assert out and {r["doc_id"] for r in out} <= {r["doc_id"] for r in third}


def test_pipeline_keeps_every_word_from_mixing_to_packing(spark):
    docs, frames = spark.read.parquet(f"{SF}/documents.parquet"), {}
    con = duckdb.connect()

    def judged(rows, sql):
        con.register("documents", pa.table({c: [r[c] for r in rows] for c in ("doc_id", "text", "lang", "source")}))
        cursor = con.execute(sql)
        names = [c[0] for c in cursor.description]
        return [dict(zip(names, r)) for r in cursor.fetchall()]

    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.stored(stage(spark, frame, SF), "test-stage")
        frames[name] = frame
    kept = {r["doc_id"] for r in judged(docs.collect(), quality_rules.oracle_sql()) if r["kept"]}
    assert {r["doc_id"] for r in frames["quality_rules"].collect()} == kept
    left = frames["substring_dedup"]
    taken = {r["doc_id"]: r["taken"] for r in judged(left.collect(), mixing.oracle_sql())}
    assert taken == {r["doc_id"]: r["taken"] for r in mixing.op9_mix_to_weights(left).collect()}
    source = {r["doc_id"]: Counter(words(r["text"])) for r in left.collect()}
    mixed = {r["doc_id"]: r["text"] for r in frames["mix_to_weights"].collect()}
    assert {d: len(words(t)) for d, t in mixed.items()} == {d: n for d, n in taken.items() if n}
    assert all(set(words(t)) <= set(source[d]) for d, t in mixed.items())
    from public_tokenizers import path
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
    assert set(pieces) == set(mixed)
    for d, text in mixed.items():
        ids = plain.encode(text, add_special_tokens=False).ids + [packing.END_ID]
        at = 0
        for start, length, crc in sorted(pieces[d]):
            assert start == at and crc == zlib.crc32(np.array(ids[at:at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
