"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

A base rule drops short and very repetitive texts. Five shares of a text are then compared with joint cutoffs that are
chosen on labelled documents. The cutoffs come from a fixed path of levels, each of which rejects all that the one
before rejects. Within a stratum (language) the levels are tested in order: a level is certified if the count of
distinct good texts that it rejects, or fewer, would have at most the probability ``DELTA`` / (number of strata) under a
false-rejection rate of ``ALPHA``, by the exact binomial distribution. Testing stops at the first level that fails, so
the levels of a stratum need no correction for their number (fixed-sequence testing), and strata are corrected for
theirs (Bonferroni): with confidence 1 - ``DELTA`` no stratum loses more than ``ALPHA`` of its good texts that pass the
base rule. A trial is a distinct text, since copies of a text, repeated rows and repeated labels are no further
evidence. The last certified level of a stratum is used; where none is certified, for want of labels or for real risk,
only the base rule rejects.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ._scratch import Scratch

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ALPHA, DELTA = 0.03, 0.05
#: Levels of joint cutoffs, fixed before any label is seen: a text is rejected if any share is above its cutoff.
PATH = {
    "symbols": (0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01),
    "dup_lines": (0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2),
    "repeats": (0.48, 0.46, 0.44, 0.42, 0.4, 0.38, 0.36, 0.34, 0.32, 0.3),
    "capitals": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2),
    "word_length": (48.0, 32.0, 24.0, 20.0, 16.0, 14.0, 13.0, 12.0, 11.0, 10.0),
}
LEVELS = len(PATH["symbols"])
#: Cutoffs are broadcast if there are no more strata than this, else joined.
MOST_BROADCAST = 10_000
WINDOW_HASH = "xxhash64(w[i], w[i + 1], w[i + 2])"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAKS = "\t\n\x0b\f\r"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of each text.

    Repeated windows are found per row, without a shuffle: each 3-word window becomes a long with its hash in the high
    bits and its place in the low ones, so equal windows stand together when these are sorted. The words of neighbours
    are then compared; where they differ, the hashes say too little and the windows themselves are sorted. ``text_key``
    is a hash that equal texts share.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("stratum"), text.alias("t"))
    spaced = F.trim(F.translate("t", _BREAKS, " " * len(_BREAKS)))
    lines = F.filter(F.split("t", "\n"), lambda x: F.trim(F.translate(x, _BREAKS, " " * len(_BREAKS))) != "")
    rows = rows.select(
        "doc_id", "stratum",
        F.xxhash64("t").alias("text_key"),
        F.length(_without(F.col("t"), " " + _BREAKS)).cast("long").alias("word_chars"),
        (F.length("t") - F.length(_without(F.col("t"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(_without(F.col("t"), CAPITALS))).cast("long").alias("n_capitals"),
        lines.alias("lines"),
        F.when(spaced != "", F.split(spaced, " +")).otherwise(F.array().cast("array<string>")).alias("w"),
    )
    rows = rows.select(
        "doc_id", "stratum", "text_key", "word_chars", "n_symbols", "n_capitals", "w",
        F.size("w").alias("n"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("cast(ceil(log2(size(w) + 1)) as int)").alias("s"),
    )
    places = "sequence(0, n - 3)"
    rows = rows.withColumn("keys", F.expr(f"CASE WHEN n >= 3 THEN sort_array(transform({places}, i -> shiftleft({WINDOW_HASH}, s) | i)) END"))
    high = "shiftrightunsigned({}, s)".format
    near = f"(j > 0 AND {high('keys[j - 1]')} = {high('x')}) OR (j < n - 3 AND {high('keys[j + 1]')} = {high('x')})"
    rows = rows.withColumn("hits", F.expr(f"filter(keys, (x, j) -> {near})"))
    place = "cast({} & (shiftleft(1L, s) - 1) as int)".format
    words = " AND ".join(f"w[{place('hits[j - 1]')} + {k}] = w[{place('x')} + {k}]" for k in range(3))
    differ = f"size(filter(hits, (x, j) -> j > 0 AND {high('hits[j - 1]')} = {high('x')} AND NOT ({words}))) > 0"
    by_hash = f"sort_array(transform(hits, x -> {place('x')}))"
    windows = f"sort_array(transform({places}, i -> named_struct('g', concat_ws(' ', w[i], w[i + 1], w[i + 2]), 'i', i)))"
    same = "filter(k, (x, j) -> (j > 0 AND k[j - 1].g = x.g) OR (j < n - 3 AND k[j + 1].g = x.g))"
    by_words = f"aggregate(array({windows}), cast(array() as array<int>), (a, k) -> sort_array(transform({same}, x -> x.i)))"
    rows = rows.withColumn("found", F.expr(f"CASE WHEN {differ} THEN {by_words} ELSE {by_hash} END"))
    covered = F.expr(
        "CASE WHEN size(found) > 0 THEN aggregate(sequence(0, size(found) - 1), 0L, (a, k) -> a + CASE WHEN k = 0 THEN 3L ELSE least(3L, found[k] - found[k - 1]) END) ELSE 0L END"
    )
    return rows.select(
        "doc_id", "stratum", "text_key", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", covered.alias("n_repeat_words")
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def shares() -> dict[str, Column]:
    """The values that cutoffs apply to; a text without words has zeros."""
    return {
        "symbols": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
        "capitals": F.col("n_capitals") / F.greatest("word_chars", F.lit(1)),
        "word_length": F.col("word_chars") / F.greatest("n_words", F.lit(1)),
    }


def binomial_tail(k: str, n: str, p: float) -> Column:
    """P(X <= k) for X binomial with n trials at rate p, summed exactly in logarithms."""
    step = f"(s, i) -> named_struct('t', s.t + ln((({n}) - i + 1) / i) + ln({p!r}D / (1D - {p!r}D)), 'p', s.p + exp(s.t + ln((({n}) - i + 1) / i) + ln({p!r}D / (1D - {p!r}D))))"
    start = f"named_struct('t', ({n}) * ln(1D - {p!r}D), 'p', exp(({n}) * ln(1D - {p!r}D)))"
    return F.expr(f"CASE WHEN ({k}) = 0 THEN exp(({n}) * ln(1D - {p!r}D)) WHEN ({k}) > ({n}) * {p!r}D THEN 1D ELSE aggregate(sequence(1L, {k}), {start}, {step}, s -> s.p) END")


def rejected_at(cutoffs: dict[str, Column]) -> Column:
    """Whether a share is above its cutoff; a null cutoff rejects nothing."""
    value = shares()
    return reduce(lambda a, b: a | b, [F.coalesce(value[name] > cut, F.lit(False)) for name, cut in cutoffs.items()])


def certified_levels(counts: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, level): the last certified level of each stratum that has one, from 1."""
    good = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    trials = counts.where(~base_failed()).join(good, "doc_id").dropDuplicates(["stratum", "text_key"])
    above = [F.count_if(rejected_at({name: F.lit(cuts[level]) for name, cuts in PATH.items()})).alias(f"k_{level}") for level in range(LEVELS)]
    tallies = trials.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *above)
    cells = [F.struct(F.lit(level + 1).alias("level"), F.col(f"k_{level}").alias("k")) for level in range(LEVELS)]
    tested = (
        tallies.withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy()))  # a row for each stratum
        .select("stratum", "n", "strata", F.inline(F.array(*cells)))
        .withColumn("passed", binomial_tail("k", "n", alpha) * F.col("strata") <= delta)
    )
    # rejections rise along the path, so the levels that pass come first
    failed = F.min(F.when(~F.col("passed"), F.col("level")))
    return tested.groupBy("stratum").agg((F.coalesce(failed, F.lit(LEVELS + 1)) - 1).alias("level")).where("level > 0")


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    A null or empty text has no words and fails the base rule. A null lang is a stratum of its own; strata without
    enough labels have no cutoffs. Labels without doc_id or quality, or of unknown documents, do not count; repeated
    labels, rows and texts of a stratum count once. A very long text is one task's array of words and windows, about
    100 bytes a word. Other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    counts = scratch.save("counts", measures(docs))
    levels = scratch.save("levels", certified_levels(counts, labels, alpha, delta))
    levels = F.broadcast(levels) if levels.count() <= MOST_BROADCAST else levels
    cut = {name: F.get(F.array(*map(F.lit, cuts)), F.col("level") - 1) for name, cuts in PATH.items()}
    return (
        counts.join(levels, "stratum", "left")
        .withColumn("base_failed", base_failed())
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~rejected_at(cut)).alias("kept"))
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that the rules keep; rows that repeat a doc_id stay only if all of them are kept.

    Null, empty and short texts go; long ones are measured whole. Columns of any name are kept; an empty table gives an empty result.
    """
    found = apply_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    same = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none")]
    gone = found.where("not kept").select(*same).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("row")).select(*same, "row")
    return rows.join(gone, ["id", "none"], "left_anti").select("row.*")


def _oracle() -> str:
    levels = " UNION ALL ".join("SELECT " + ", ".join([f"{level + 1} AS level", *(f"{cuts[level]!r}::DOUBLE AS cut_{name}" for name, cuts in PATH.items())]) for level in range(LEVELS))
    reject = " OR ".join(f"coalesce({name} > cut_{name}, false)" for name in PATH)
    p = ALPHA
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
e AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
tri AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM e WHERE len(w) >= 3) x),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) x WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS c FROM rep CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) y GROUP BY rid),
m AS (SELECT doc_id, stratum, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
  len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c, 0) AS BIGINT) AS n_repeat_words
  FROM e LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  n_symbols::DOUBLE / greatest(word_chars, 1) AS symbols, n_dup_lines::DOUBLE / greatest(n_lines, 1) AS dup_lines,
  n_repeat_words::DOUBLE / greatest(n_words, 1) AS repeats, n_capitals::DOUBLE / greatest(word_chars, 1) AS capitals,
  word_chars::DOUBLE / greatest(n_words, 1) AS word_length FROM m),
good AS (SELECT DISTINCT stratum, t, symbols, dup_lines, repeats, capitals, word_length FROM f WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
path AS ({levels}),
tall AS (SELECT stratum, level, count(*) AS n, count(*) FILTER (WHERE {reject}) AS k FROM good CROSS JOIN path GROUP BY stratum, level),
steps AS (SELECT stratum, level, n, k, i, CASE WHEN i = 0 THEN n * ln(1 - {p!r}::DOUBLE) ELSE ln((n - i + 1)::DOUBLE / i) + ln({p!r}::DOUBLE / (1 - {p!r}::DOUBLE)) END AS step
  FROM (SELECT *, unnest(range(0, k + 1)) AS i FROM tall WHERE k <= n * {p!r}::DOUBLE) x),
terms AS (SELECT *, sum(step) OVER (PARTITION BY stratum, level ORDER BY i) AS t FROM steps),
tails AS (SELECT stratum, level, sum(exp(t)) * (SELECT count(DISTINCT stratum) FROM tall) AS tail FROM terms GROUP BY stratum, level),
bad AS (SELECT stratum, min(level) AS level FROM tall LEFT JOIN tails USING (stratum, level) WHERE coalesce(tail, 1) > {DELTA} GROUP BY stratum),
cuts AS (SELECT s.stratum, path.* FROM (SELECT DISTINCT stratum FROM tall) s LEFT JOIN bad USING (stratum) JOIN path ON path.level = coalesce(bad.level, {LEVELS + 1}) - 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({reject}) AS kept
FROM f LEFT JOIN cuts USING (stratum)
"""


ORACLE_SQL = _oracle()
