"""Quality rules with adaptive thresholds per language and source.

Each document's measures (word count, word and symbol characters, repeated lines
and words) come from string and array functions.  KLL quantile sketches of the
adaptive measures are built per (language, source), with one more level per
language and one for all; sketches merge, so map tasks send a sketch, not rows,
however hot a source is.  Limits are tail quantiles of a document's own group: what
lies beyond them is unlike the rest of its language and source, whatever is usual there.  A group
below ``min_group`` documents uses its language's limits, and that one, if small too, the
corpus's.  A join with the limits then filters.  ``RULES`` also names a least distance from the
median, which decides only where a group's tail is as good as tied with its middle.

Defined results: a null text has no words; documents without words fail the base
rule; null language and source are groups of their own; repeated rows are judged
alike, rows that share a doc_id by their own text; an empty table gives no rows; extra
columns are kept by ``filter_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, stored, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: entries a sketch keeps per level; groups up to this size are exact
SKETCH_K = 4096
MIN_GROUP = 100
#: measure -> (upper tail quantile, lower one or none, least distance of a limit from the median)
RULES = {
    "symbol_share": (0.95, None, 0.02),
    "dup_line_share": (0.99, None, 0.05),
    "mean_word": (0.98, 0.005, 0.5),
}


def _count_chars(text: Column, chars: str) -> Column:
    """How many of the (one-byte) characters a text holds: bytes lost by removing each."""
    parts = [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in chars]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def repeated_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the text, the first included.

    Windows are hashed; only texts that repeat a window at all sort (hash, position) pairs,
    keep the positions whose neighbour has the same hash, and add up what they cover.
    """
    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)),
                           lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(window)]))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeats(p: Column) -> Column:
            same = F.filter(p, lambda s, j: (s["h"] == F.get(p, j - 1)["h"]) | (s["h"] == F.get(p, j + 1)["h"]))
            return F.array_sort(F.transform(same, lambda s: s["i"]))

        def span(at: Column) -> Column:
            gaps = F.transform(at, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(at, j + 1) - x, F.lit(window))))
            return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

        return let(let(pairs, repeats), span)

    def of_hashes(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))

    def of_words(w: Column) -> Column:
        numbers = F.transform(w, lambda x: F.xxhash64(x))
        return F.when(F.size(w) <= window, F.lit(0)).otherwise(let(let(numbers, hashes), of_hashes))

    return let(tokens, of_words).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the measures of every document."""
    body = docs.select("doc_id", "lang", "source", F.xxhash64("text").alias("text_hash"),
                       F.coalesce(F.col("text"), F.lit("")).alias("body"))
    lines = F.filter(F.split("body", "\n"), lambda x: F.length(F.trim(F.translate(x, SPACES[1:], " " * 5))) > 0)
    out = body.withColumn("w", words(F.col("body"))).withColumn("lines", lines)
    out = (out.withColumn("n_words", F.size("w").cast("long"))
           .withColumn("word_chars", (F.char_length("body") - _count_chars(F.col("body"), SPACES)).cast("long"))
           .withColumn("n_symbols", _count_chars(F.col("body"), SYMBOLS).cast("long"))
           .withColumn("n_lines", F.size("lines").cast("long"))
           .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
           .withColumn("n_repeat_words", repeated_words(F.col("w"))))
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))
    return (out.withColumn("symbol_share", F.col("n_symbols") / F.greatest("word_chars", F.lit(1)))
            .withColumn("dup_line_share", F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)))
            .withColumn("mean_word", F.col("word_chars") / F.greatest("n_words", F.lit(1)))
            .drop("body", "w", "lines"))


def limits(measured: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """level, lang, source, n and the limits of each group that passed the base rule.

    One aggregate builds the sketches per (lang, source); the levels above merge them.
    """
    base = (measured.filter(~F.col("base_failed")).groupBy("lang", "source")
            .agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(m, F.lit(k)).alias(m) for m in RULES]))
    base = stored(base, "quality-sketches")
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(m, F.lit(k)).alias(m) for m in RULES]]
    levels = [base.withColumn("level", F.lit(0)),
              base.groupBy("lang").agg(*merged).withColumn("source", F.lit(None).cast("string")).withColumn("level", F.lit(1)),
              base.agg(*merged).filter("n > 0").withColumns({"lang": F.lit(None).cast("string"),
                                           "source": F.lit(None).cast("string"), "level": F.lit(2)})]
    sketches = levels[0].unionByName(levels[1]).unionByName(levels[2])
    out = ["level", "lang", "source", "n"]
    for m, (upper, lower, least) in RULES.items():
        middle = F.kll_sketch_get_quantile_double(m, F.lit(0.5))
        high = F.kll_sketch_get_quantile_double(m, F.lit(upper))
        out += [F.greatest(high, middle + least).alias(f"{m}_max"), (high < middle + least).alias(f"{m}_guarded")]
        if lower is not None:
            low = F.kll_sketch_get_quantile_double(m, F.lit(lower))
            out += [F.least(low, middle - least).alias(f"{m}_min")]
    return sketches.select(*out)


def judge(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The measures with ``base_failed`` and ``kept``."""
    measured = stored(measures(docs), "quality-measures")  # a few numbers per row; read by both passes
    table = stored(limits(measured), "quality-limits")
    bounds = [c for m, (_, lower, _) in RULES.items() for c in (f"{m}_max", *([f"{m}_min"] if lower is not None else []))]

    def level(k: int, keys: list[str]) -> DataFrame:
        names = [F.col(c).alias(f"{c}_{k}") for c in ("n", *bounds)]
        return table.filter(F.col("level") == k).select(*[F.col(x).alias(f"_{x}{k}") for x in keys], *names)

    own, by_lang, whole = level(0, ["lang", "source"]), level(1, ["lang"]), level(2, [])
    # limits are a few numbers per group; resolve the levels among themselves first
    resolved = own.join(by_lang, F.col("_lang0").eqNullSafe(F.col("_lang1")), "left")
    resolved = resolved.join(whole.withColumn("_one", F.lit(1)), F.lit(1) == F.col("_one"), "left")

    def pick(c: str) -> Column:
        return (F.when(F.col("n_0") >= min_group, F.col(f"{c}_0"))
                .when(F.col("n_1") >= min_group, F.col(f"{c}_1")).otherwise(F.col(f"{c}_2")).alias(c))

    resolved = resolved.select(F.col("_lang0").alias("_lang"), F.col("_source0").alias("_source"), *[pick(c) for c in bounds])
    joined = measured.join(resolved, F.col("lang").eqNullSafe(F.col("_lang"))
                           & F.col("source").eqNullSafe(F.col("_source")), "left")
    fine = F.lit(True)
    for m, (_, lower, _) in RULES.items():
        fine = fine & (F.col(m) <= F.col(f"{m}_max"))
        if lower is not None:
            fine = fine & (F.col(m) >= F.col(f"{m}_min"))
    return joined.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(fine, F.lit(True))))


def op5_adaptive_quality_rules(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns."""
    columns = docs.columns
    keep = judge(docs).filter("kept").select(F.col("doc_id").alias("_kept"), F.col("text_hash").alias("_text")).distinct()
    mine = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.xxhash64("text") == F.col("_text"))
    return docs.join(keep, mine, "left_semi").select(*columns)


def oracle_sql() -> str:
    """Exact quantiles instead of sketches (equal while a group is within a sketch's exact size)."""
    word = r"'[^\x20\x09-\x0D]+'"

    def pick(m, p):  # the ranks that sketches use
        return f"(list_sort(list({m})))[CAST(greatest(1, ceil(round({p} * count(*), 6))) AS INTEGER)]"

    picks = ", ".join(f"{pick(m, p)} AS {m}_{e}" for m, (upper, lower, _) in RULES.items()
                      for e, p in (("high", upper), ("mid", 0.5), ("low", lower)) if p is not None)
    ends = [(m, e) for m, (_, lower, _) in RULES.items() for e in ("max", "min") if e == "max" or lower is not None]
    least = {m: rule[2] for m, rule in RULES.items()}
    bounds = ", ".join(f"greatest({m}_high, {m}_mid + {least[m]}) AS {m}_max" if e == "max"
                       else f"least({m}_low, {m}_mid - {least[m]}) AS {m}_min" for m, e in ends)
    chosen = {f"{m}_{e}": f"CASE WHEN g.n >= {MIN_GROUP} THEN g.{m}_{e} WHEN l.n >= {MIN_GROUP} THEN l.{m}_{e} ELSE a.{m}_{e} END"
              for m, e in ends}
    verdict = " AND ".join(f"m.{m} {'<=' if e == 'max' else '>='} {chosen[f'{m}_{e}']}" for m, e in ends)
    symbols = " + ".join(f"(length(body) - length(replace(body, '{c}', '')))" for c in SYMBOLS)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS body FROM documents),
split AS (
  SELECT *, regexp_extract_all(body, {word}) AS w,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, {word})) AS lines FROM docs),
windows AS (
  SELECT rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM split WHERE len(w) >= {WINDOW})),
repeats AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
covered AS (
  SELECT rid, CAST(sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) AS BIGINT) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM repeats) GROUP BY rid),
counted AS (
  SELECT s.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST({symbols} AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON c.rid = s.rid),
m AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols / greatest(word_chars, 1) AS symbol_share, n_dup_lines / greatest(n_lines, 1) AS dup_line_share,
         word_chars / greatest(n_words, 1) AS mean_word FROM counted),
g0 AS (SELECT lang, source, count(*) AS n, {picks} FROM m WHERE NOT base_failed GROUP BY lang, source),
l0 AS (SELECT lang, count(*) AS n, {picks} FROM m WHERE NOT base_failed GROUP BY lang),
a0 AS (SELECT count(*) AS n, {picks} FROM m WHERE NOT base_failed),
g AS (SELECT lang, source, n, {bounds} FROM g0),
l AS (SELECT lang, n, {bounds} FROM l0),
a AS (SELECT n, {bounds} FROM a0)
SELECT m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
       CASE WHEN m.base_failed THEN false ELSE coalesce({verdict}, true) END AS kept
FROM m CROSS JOIN a
LEFT JOIN g ON g.lang IS NOT DISTINCT FROM m.lang AND g.source IS NOT DISTINCT FROM m.source
LEFT JOIN l ON l.lang IS NOT DISTINCT FROM m.lang"""
