"""Chosen-path join (op7), tensored banding (op12) and the links they share, against brute force."""

from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnstile.llm import jaccard, links, tensored
from turnstile.session import checkpoint_root

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, rep long, hub string, left int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", 1, "h", 2) for d, t in rows], SCHEMA)


def shingle_set(text, width, lower):
    raw = (text or "").encode()
    w = (raw.lower() if lower else raw).split()  # bytes.lower changes A-Z only
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else None


def brute(rows, width, lower=False):
    """Row -> smallest doc_id of its component, and its sets; pairs share a shingle, so an index finds them."""
    sets = [shingle_set(t, width, lower) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if not sets[i] or d is None:
            continue
        met = Counter(j for s in sets[i] for j in where[s])
        for j, n in met.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for s in sets[i]:
            where[s].append(i)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            smallest[root(i)] = min(d, smallest.get(root(i), d))
    return [(d, None if d is None else smallest[root(i)], sets[i]) for i, (d, _) in enumerate(rows)]


def edited(rng, base, edits, words):
    out = list(base)
    for _ in range(edits):
        out[rng.integers(0, len(out))] = f"e{rng.integers(0, words)}"
    return " ".join(out)


def mixed_rows(rng, groups=12):
    rows, passage = [], " ".join(f"p{i}" for i in range(40))
    for g in range(groups):
        base = [f"g{g}t{i}" for i in range(60)]
        rows += [edited(rng, base, rng.integers(0, 5), 10 ** 6) for _ in range(1 + 4 * (g % 5))]
    rows += [t + " " + passage for t in rows[:8]] + [passage + f" own{i} " * 3 for i in range(6)]
    rows += [None, "", " \n", "one", "ONE", "one two", "One  two", "long " + " ".join(f"l{i % 900}" for i in range(20000))]
    return [(i, t) for i, t in enumerate(rows)] + [(3, rows[3]), (3, "another text of the same id " * 4), (None, rows[5]), (None, None)]


@pytest.mark.parametrize("small", [2000, 4])
def test_chosen_path_equals_brute_force(spark, small):
    rows = mixed_rows(np.random.default_rng(7))
    got = jaccard.near_duplicates(frame(spark, rows).repartition(3), small=small).collect()
    want = brute(rows, 5)
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == Counter((d, c) for d, c, _ in want)
    by = {d: s for d, _, s in want}  # the sets of the smallest rows: repeated ids are not linked to
    for r in got:
        if r["linked_to"] is not None and r["doc_id"] not in (3, None) and r["linked_to"] != 3:
            a, b = by[r["copy_of"]], by[r["linked_to"]]
            assert a != b and abs(len(a & b) / len(a | b) - r["similarity"]) < 1e-12 and r["similarity"] >= 0.8
    # a group of different texts has links
    assert all(any(x["linked_to"] is not None for x in got if x["class_id"] == r["class_id"])
               for r in got if r["doc_id"] is not None and r["copy_of"] != r["class_id"])


@pytest.mark.parametrize("small", [2000, 4])
def test_tensored_equals_brute_force(spark, small):
    rows = mixed_rows(np.random.default_rng(8))
    got = tensored.near_duplicates(frame(spark, rows).repartition(3), small=small).collect()
    want = Counter((d, len(s or ()), c, d == c) for d, c, s in brute(rows, 2, lower=True))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for op, column, width, lower in ((jaccard.op7_chosen_path_join, "class_id", 5, False),
                                     (tensored.op12_tensored_minhash, "component_id", 2, True)):
        got = {r["doc_id"]: r[column] for r in op(docs).collect()}
        assert got == {d: c for d, c, _ in brute(rows, width, lower)}


def _cell(sets, radius=0.0):
    """One cell of these sets of tokens, each a group of its own."""
    token = np.concatenate([np.sort(np.array(x, np.uint64)) for x in sets])
    sketch = links.bin_sketches(token, np.repeat(np.arange(len(sets)), [len(x) for x in sets]), len(sets))
    k = len(sets)
    return pa.table({"cell": [1] * k, "rep": range(k), "n": [len(x) for x in sets],
                     "sketch": pa.array([row.tobytes() for row in sketch], pa.binary()), "radius": [radius] * k,
                     "group": range(k), "block": [0] * k, "lone": [True] * k, "place": [0] * k,
                     "marks": pa.array([[]] * k, pa.list_(pa.int64()))})


def _kept(sets, threshold):
    return {(a, b) for i, j in links._near_pairs(_cell(sets), threshold, None) for a, b in zip(i.tolist(), j.tolist())}


def test_no_pair_of_a_cell_that_meets_the_threshold_is_left_out():
    # 200 of 250 tokens in common, in few bins; the others fill bins of their own
    common = [(b << 56) + i for b in range(4) for i in range(50)]
    own = [[(b << 56) + 99 for b in range(lo, lo + 25)] for lo in (10, 100)]
    assert _kept([common + own[0], common + own[1]], 0.8) == {(0, 1)}
    # bins that hold more tokens than a count says
    common = [(b << 56) + i for b in range(4) for i in range(300)]
    own = [[(b << 56) + 2 * i + k for b in range(20, 30) for i in range(15)] for k in (0, 1)]
    assert _kept([common + own[0], common + own[1]], 0.8) == {(0, 1)}
    rng = np.random.default_rng(7)
    for n in (3, 40, 300, 3000):
        base = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2)
        sets = [set(rng.permutation(base)[:n - rng.integers(0, n // 8 + 1)].tolist()) for _ in range(40)]
        sets += [set((rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2)).tolist()) for _ in range(10)]
        want = {(i, j) for j in range(50) for i in range(j) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])}
        kept = _kept([sorted(x) for x in sets], 0.8)
        assert want <= kept and len(want) > 100
        assert not any(j >= 40 for _, j in kept)  # unlike sets are ruled out


def test_pivots_are_met_once_however_many_buckets_share_them(spark):
    rows = spark.createDataFrame([(r, b) for b in range(6) for r in range(64)] + [(r, 9) for r in (70, 71)] + [(80, 10)],
                                 "rep long, bucket long")
    found = links.pivots_of(rows)
    want = {(r, p) for r in range(64) for p in (0, 1, 2) if r != p} | {(71, 70)}
    assert sorted(map(tuple, found.collect())) == sorted(want)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(pivots") < plan.index("Join")  # above the join, which gives a row per entry


def test_small_steps_are_written_by_few_tasks(spark):
    """many shuffle partitions do not make every step of the join write that many tiny files."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base) if i % 2 else edited(rng, base, 2, 40)) for i in range(400)]
    work = Path(checkpoint_root(spark).removeprefix("file:")) / "turnstile-work"
    before = set(work.iterdir()) if work.exists() else set()
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = {r["doc_id"]: r["class_id"] for r in jaccard.op7_chosen_path_join(frame(spark, rows)).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert found == {d: c for d, c, _ in brute(rows, 5)}
    files = {f.name.rsplit("-", 1)[0]: len([*f.glob("part-*")]) for f in set(work.iterdir()) - before}
    small = ("members", "met", "pivots", "pairs", "similarities", "star", "hung", "leaves", "cells", "hub-links", "links", "cc-labels")
    assert set(small) <= set(files)
    assert max(files[x] for x in small) <= spark.sparkContext.defaultParallelism


def test_pivots_that_are_broadcast_or_not_give_the_same_pairs(spark, monkeypatch):
    rng = np.random.default_rng(12)
    token = np.sort(rng.integers(0, 1 << 63, (30, 50), np.uint64), axis=1)
    token[10:] = token[rng.integers(0, 10, 20)]
    sketch = links.bin_sketches(token.ravel(), np.repeat(np.arange(30), 50), 30)
    reps = spark.createDataFrame([(i, 50, bytearray(row.tobytes())) for i, row in enumerate(sketch)], "rep long, n int, sketch binary")
    pairs = spark.createDataFrame([(a, b) for a in range(30) for b in range(10) if a != b], "a long, b long")
    want = sorted((a, b) for a in range(30) for b in range(10) if a != b and (token[a] == token[b]).all())
    for most in (links.BROADCAST_PIVOTS, 0):
        monkeypatch.setattr(links, "BROADCAST_PIVOTS", most)
        found = links.plausible(pairs, reps, 0.8)
        assert sorted((r["a"], r["b"]) for r in found.collect()) == want
        assert ("ResolvedHint (strategy=broadcast)" in found._jdf.queryExecution().analyzed().toString()) == bool(most)


def _stored_since(spark, before, name):
    work = Path(checkpoint_root(spark).removeprefix("file:")) / "turnstile-work"
    return [f for f in work.iterdir() if f.name.rsplit("-", 1)[0] == name and f not in before]


def test_sets_that_share_many_tables_are_dealt_to_one_cell(spark):
    """Pairs below the threshold share a dozen tables each, whose members are the same: their sketches move once."""
    rng = np.random.default_rng(13)
    rows = []
    for g in range(40):
        base = [f"g{g}x{i}" for i in range(100)]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, edited(rng, base, 10, 10 ** 7))]
    work = Path(checkpoint_root(spark).removeprefix("file:")) / "turnstile-work"
    before = set(work.iterdir()) if work.exists() else set()
    found = {r["doc_id"]: r["component_id"] for r in tensored.op12_tensored_minhash(frame(spark, rows)).collect()}
    assert found == {d: c for d, c, _ in brute(rows, 2, lower=True)} and len(set(found.values())) > 30
    cells, = _stored_since(spark, before, "cells")
    per_set = [r["count"] for r in spark.read.parquet(str(cells)).groupBy("rep").count().collect()]
    assert len(per_set) > 60 and max(per_set) == 1


def test_first_buckets_do_not_carry_all_paths_of_their_sets(spark):
    classes = spark.createDataFrame([(r, [[256 + r % 2, 512 * r + 1], [3, 4, 5]]) for r in range(1, 5)], "rep long, paths array<array<long>>")
    found = jaccard._first_paths(classes, 2)
    assert set(found.columns) == {"path", "run", "rep"}
    assert sorted(map(tuple, found.select("path", "run", "rep").collect())) == [(256, 0, 2), (256, 0, 4), (257, 1, 1), (257, 1, 3)]


def test_unlike_buckets_keep_the_first_of_equal_ones(spark):
    # 1 to 3: the same own sets; 4: the same sets, one not its own; 5: other sets; 6: before 4, as there
    entries = [(r, b, 10 - b, True) for b in (1, 2, 3) for r in (7, 8)] + [(7, 4, 1, True), (8, 4, 1, False)]
    entries += [(7, 5, 0, True), (8, 5, 0, True), (9, 5, 0, True), (7, 6, 0, True), (8, 6, 0, False)]
    found = links.unlike_buckets(spark.createDataFrame(entries, "rep long, bucket long, place long, own boolean"), 2)
    assert sorted(map(tuple, found.select("rep", "bucket", "place").collect())) == [(7, 3, 7), (7, 5, 0), (7, 6, 0), (8, 3, 7), (8, 5, 0), (8, 6, 0), (9, 5, 0)]


@pytest.mark.parametrize("most", [links.BROADCAST_KEYS, 0])
def test_tables_of_shared_left_keys_hold_all_that_meet(spark, monkeypatch, most):
    monkeypatch.setattr(links, "BROADCAST_KEYS", most)
    rng, m = np.random.default_rng(14), 3
    rows = [(int(rng.integers(0, 30)), bool(rng.integers(0, 2)), [int(i * 100 + x) for i, x in enumerate(rng.integers(1, 40, 2 * m))])
            for _ in range(60)]
    held = spark.createDataFrame(rows, "rep long, own boolean, marks array<long>")
    got = tensored.shared_tables(m)(held, 2).collect()
    left, tables = defaultdict(set), defaultdict(set)
    for rep, _, marks in rows:
        for i in range(m):
            left[marks[i]].add(rep)
            for j in range(m):
                tables[marks[i], marks[m + j]].add(rep)
    want = Counter((rep, own, i * m + j + 1) for rep, own, marks in rows for i in range(m) for j in range(m) if len(left[marks[i]]) > 1)
    assert Counter((r["rep"], r["own"], r["place"]) for r in got) == want and sum(want.values()) < 60 * m * m
    met = defaultdict(set)
    for r in got:
        met[r["bucket"]].add(r["rep"])
    mixed = [sorted(v) for v in tables.values() if len(v) > 1]
    assert sorted(sorted(v) for v in met.values() if len(v) > 1) == sorted(mixed) and mixed


@pytest.mark.parametrize("most", [links.BROADCAST_KEYS, 0])
def test_exact_similarities_of_popular_sets(spark, monkeypatch, most):
    monkeypatch.setattr(links, "BROADCAST_KEYS", most)
    rng = np.random.default_rng(15)
    sets = [sorted({int(x) for x in rng.integers(0, 60, 40)}) for _ in range(40)]
    tokens = spark.createDataFrame(list(enumerate(sets)), "rep long, tokens array<long>")
    # one set with all others (as a and as b), and all pairs of a few
    pairs = {(0, j) for j in range(1, 40)} | {(i, 39) for i in range(39)} | {(i, j) for i in range(5, 10) for j in range(5, 10) if i != j}
    found = links.exact(spark.createDataFrame(sorted(pairs), "a long, b long"), lambda ids: tokens.join(ids, "rep"))
    a_b = {(a, b): (set(sets[a]), set(sets[b])) for a, b in pairs}
    assert sorted(map(tuple, found.collect())) == sorted((a, b, len(x & y), len(x | y)) for (a, b), (x, y) in a_b.items())


def test_five_thousand_near_copies(spark):
    """One bucket of thousands of different near copies: one group, and comparisons in proportion to it."""
    rng = np.random.default_rng(9)
    base = [f"b{i}" for i in range(200)]
    rows = [(i, edited(rng, base, 1 + i % 2, 10 ** 7)) for i in range(5000)]
    docs = frame(spark, rows + [(9000, "unlike " + " ".join(f"u{i}" for i in range(70)))])
    compared = []

    def counted(pairs, fetch, plain=links.exact):
        out = plain(pairs, fetch)
        compared.append(out.count())
        return out

    links.exact = counted
    try:
        for op, column in ((jaccard.op7_chosen_path_join, "class_id"), (tensored.op12_tensored_minhash, "component_id")):
            compared.clear()
            got = {r["doc_id"]: r[column] for r in op(docs).collect()}
            assert set(got.values()) == {0, 9000} and sum(v == 0 for v in got.values()) == 5000
            assert sum(compared) < 3 * 5000  # all pairs would be 12.5 million
    finally:
        links.exact = counted.__defaults__[0]


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, each a group of its own."""
    rows, linked = [], {"op7": 0, "op12": 0}
    rng = np.random.default_rng(10)
    for g in range(400):
        base = [f"g{g}x{i}" for i in range(100)]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, edited(rng, base, 2 if g % 2 else 4, 10 ** 7))]
    for name, op, width, column in (("op7", jaccard.op7_chosen_path_join, 5, "class_id"),
                                    ("op12", tensored.op12_tensored_minhash, 2, "component_id")):
        want = {d: c for d, c, _ in brute(rows, width, name == "op12")}
        got = {r["doc_id"]: r[column] for r in op(frame(spark, rows)).collect()}
        total = sum(d != c for d, c in want.items())
        assert all(got[d] in (d, c) for d, c in want.items()) and total > 150
        assert sum(got[d] == c for d, c in want.items() if d != c) >= 0.99 * total


def test_empty_and_wordless_tables(spark):
    none = frame(spark, [])
    blank = frame(spark, [(1, None), (2, ""), (None, " ")])
    assert jaccard.op7_chosen_path_join(none).count() == 0 and tensored.op12_tensored_minhash(none).count() == 0
    assert sorted(tensored.op12_tensored_minhash(blank).collect(), key=str) == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)], key=str)
    assert {(r["doc_id"], r["class_id"]) for r in jaccard.op7_chosen_path_join(blank).collect()} == {(1, 1), (2, 2), (None, None)}


def test_one_per_group_judges_rows_by_their_own_text(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = frame(spark, [(1, text), (2, text), (2, "a text of its own"), (None, text), (4, None)])
    kept = jaccard.one_per_group(docs)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        [(1, text), (2, "a text of its own"), (None, text), (4, None)])


def test_banding_needs_about_the_square_root_of_the_minhashes():
    k, m = tensored.banding(250_000, 0.8)
    assert (k, m) == (2, 8)
    assert (1 - (1 - 0.8 ** k) ** m) ** 2 >= 0.999  # what meets of pairs at the threshold
    minhashes, independent = 2 * m * k, 2 * k * m * m  # independent tables need one per table and position
    assert minhashes * m == independent
    rng = np.random.default_rng(4)
    a = np.unique(rng.integers(0, 2 ** 63, 500).astype(np.uint64))
    b = np.unique(np.concatenate([a[:450], rng.integers(0, 2 ** 63, 50).astype(np.uint64)]))
    token, at = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b), len(a) + len(b)])
    keys = tensored.small_keys(token, at, 1, 400)
    t = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((keys[:, 0] == keys[:, 1]).mean() - t) < 0.06 and not keys[:, 2].any()


def test_whole_groups_are_never_cut():
    rng = np.random.default_rng(2)
    key = np.sort(rng.integers(0, 40, 500))
    batches = [pa.record_batch([pa.array(key[lo:lo + n])], names=["k"]) for lo, n in
               zip(range(0, 500, 7), [7] * 72)] + [pa.record_batch([pa.array([], pa.int64())], names=["k"])]
    seen, total = set(), 0
    for t in links.whole_groups(iter(batches), "k"):
        mine = set(t.column("k").to_pylist())
        assert not mine & seen
        seen |= mine
        total += t.num_rows
    assert total == 500 and F is not None
