"""Ranked lexical search: SQL, brute force, the range-maximum tables, edge cases."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from turnstile.llm import ranked_search as rs

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, item_id long, score long, rank int"
ITEMS = "item_id long, text string, doc_id long, score string"


def terms_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def brute(docs, items, k=10):
    held = [(d, Counter(terms_of(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = defaultdict(Counter)
    for i, t in items:
        asked[i].update(terms_of(t))
    out = set()
    for i, q in asked.items():
        scored = []
        for d, c, n in held:
            m = 25 + (75 * n * n_docs) // total
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t, r in q.items() if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out |= {(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)}
    return out


def found(df):
    return {(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()}


def test_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = set(con.execute(rs.oracle_sql()).fetchall())
    got = rs.op11_rmq_ranked_search(*[spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark")])
    assert found(got) == want and len(want) > 300


def test_odd_rows_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)] + ["É", "日本", "Straße", "x1"]
    p = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, rng.integers(1, 60), p=p / p.sum())) for _ in range(150)]
    texts += [None, "", " .,; ", "W1-w2_w3.W1", "é É é", "long " + " ".join(f"l{i % 900}" for i in range(20000)) + " w59"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, texts[9]), (None, "w40 w41")]
    docs += [(1000 - i, "tie w58 w57") for i in range(40)]  # more equal documents than places
    items = [(1, "w1 w5 w9 w9"), (2, "W58 tie"), (3, None), (4, "nowhere"), (5, ""), (None, "x1 日本"), (6, "é"), (1, "w20"),
             (7, " ".join(words)), (8, "w40 w41")]
    d = spark.createDataFrame([(i, t, "en", 1, 2, 3) for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, 9, "s") for i, t in items], ITEMS)
    assert found(rs.best_documents(d, q)) == brute(docs, items)
    assert found(rs.best_documents(d, q, k=3)) == brute(docs, items, 3)
    # an index of all terms and queries in several passes give the same rows
    try:
        rs.BLOCK_TERMS, rs.BLOCK_ITEMS = 40, 2
        assert found(rs.best_documents(d, q)) == brute(docs, items)
    finally:
        rs.BLOCK_TERMS, rs.BLOCK_ITEMS = 1 << 20, 4096


def test_empty_tables(spark):
    d, q = spark.createDataFrame([(1, "a b", "en", 1, 1, 1)], DOCS), spark.createDataFrame([(1, "a", 1, "")], ITEMS)
    assert rs.best_documents(d, q.limit(0)).count() == 0
    assert rs.best_documents(d.limit(0), q).count() == 0
    # a term that every document holds weighs floor(1000 ln(4 / 3))
    assert found(rs.best_documents(d, q)) == brute([(1, "a b")], [(1, "a")])


def test_range_maxima_are_first_maxima():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 9, 300)
    tables = rs.RangeMaxima(values, 100)
    start = rng.integers(0, 200, 500)
    stop = start + rng.integers(1, 101, 500)
    assert tables.argmax(start, stop).tolist() == [a + int(np.argmax(values[a:b])) for a, b in zip(start, stop)]


def test_search_leaves_intervals_out():
    """One rare term: only the few intervals that can hold it are split."""
    import pyarrow as pa

    texts = pa.array([f"common filler{i % 7} " + ("rare" if i == 400 else "") for i in range(2000)])
    batch = pa.record_batch([pa.array(range(2000), pa.int64()), texts], names=["doc_id", "text"])
    row = next(iter(rs._index_rows(None)(iter([batch]))))
    held = {c: row.column(c)[0].as_py() for c in ("lengths", "docs", "freqs")}
    held |= {c: row.column(c)[0].values.to_numpy() for c in ("terms", "counts")} | {"doc_ids": row.column("doc_ids")[0].values}
    shard = rs.Shard(held, 2000, int(row.column("n_terms")[0].as_py()))
    asked, _ = rs.term_hashes(pa.array(["rare common"]))
    best = rs.Best(1)
    splits = rs.search_shard(shard, shard.lists(asked), np.array([7000, 1]), best)
    assert best.id.tolist() == [400] and splits < 20
