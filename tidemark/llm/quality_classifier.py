"""Quality and toxicity of documents by hierarchical empirical Bayes.

A document classifier gives evidence from words and from the shape of a text: log likelihood ratios of the features
that differ clearly between labelled classes, summed and calibrated by a logistic curve on labelled documents that
the ratios were not counted on. Words are judged over all labelled documents and over those of each language, so the
words of a small language count as much as those of the largest. Sites give evidence too: grouped aggregation over all documents sums the calibrated
probabilities of each host and of each path on it. Rates of hosts shrink towards the global rate and rates of paths
towards their host's, the more the fewer documents a site has; the strength of shrinking comes from the spread of the
rates themselves (method of moments). A document's posterior adds its own evidence to the log odds of its site, which
are taken without the document itself.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._scratch import Scratch
from ._skew import join_counted
from ._words import Words, mix

#: Labelled documents that the classifier is fitted on, at most; those with the least hash of their id.
SAMPLE_ROWS = 20_000
MIN_DOCS, MIN_Z, SMOOTH = 10, 6.0, 0.5
#: A word counts if most documents with it are of the rarer class, by the lower Wilson bound of so many deviations.
PURITY_Z, MIN_PURITY = 2.0, 0.5
TARGETS = ("quality", "toxic")
#: Sums beyond this are as good as it; bins of the sums, and the pull of a language's curve to that of all.
MOST, BINS, LANG_PULL = 20.0, 400, 0.01
#: Ids of shape features; words are 64-bit hashes.
SHAPE_IDS = 256
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_CLASSES = np.zeros((256, 3), dtype=bool)
_CLASSES[[ord(c) for c in "#*$%&|<>"], 0] = True
_CLASSES[ord("A") : ord("Z") + 1, 1] = True
_CLASSES[[ord(c) for c in "!?"], 2] = True
_EDGES = np.array([0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.7])


def _features(texts: pa.Array, size: int = 1 << 19):
    """(first row, rows, word hashes with their rows, shape feature ids of each row) in runs of about ``size`` bytes."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = min(len(texts), max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1))
        own, raw = offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]]
        words = Words(_FOLD[raw], own)
        shares = []
        solid = np.r_[0, np.cumsum(raw > 0x20)][own]
        for k in range(_CLASSES.shape[1]):
            found = np.r_[0, np.cumsum(_CLASSES[:, k][raw])][own]
            shares.append(np.diff(found) / np.maximum(np.diff(solid), 1))
        again = np.zeros(len(words.hash), dtype=np.int64)
        again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])
        sums = np.r_[0, np.cumsum(again)]
        shares.append((sums[words.first + words.count] - sums[words.first]) / np.maximum(words.count, 1))
        shape = [16 * k + np.searchsorted(_EDGES, share, side="right") for k, share in enumerate(shares)]
        shape.append(16 * len(shares) + np.minimum(np.log2(words.count + 1).astype(np.int64), 15))
        yield at, to, words, np.stack(shape, axis=1)
        at = to


def _salts(langs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each row a number of its language, and whether it has one."""
    salt_of = {lang: int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little") for lang in set(langs.to_pylist()) if lang is not None}
    return np.array([salt_of.get(lang, 0) for lang in langs.to_pylist()], dtype=np.uint64), ~np.asarray(langs.is_null())


def _count(batches):
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        langs = batch.column(2)
        for at, to, words, shape in _features(batch.column(1)):
            key = np.stack([words.row.astype(np.uint64), words.hash], axis=1)
            key = np.unique(key, axis=0) if len(key) else key
            rows = np.concatenate([key[:, 0].astype(np.int64), np.repeat(np.arange(to - at), shape.shape[1])])
            yield pa.RecordBatch.from_arrays([pa.array(ids[at + rows]), pa.array(np.concatenate([key[:, 1].view(np.int64) if len(key) else np.empty(0, np.int64), shape.ravel()])), langs.take(pa.array(at + rows))], names=["doc_id", "feature", "lang"])


class Classifier:
    """Weights of features (sorted) for each target, and the logistic curve of each sum.

    A word of a single language is the feature ``mix(hash ^ salt)`` with the salt of the language.
    """

    def __init__(self, features: np.ndarray, weights: np.ndarray, curves: list[tuple[float, float]], rates: list[float]):
        order = np.argsort(features.view(np.uint64))
        self.features, self.weights, self.curves, self.rates = features.view(np.uint64)[order], weights[order], curves, rates
        #: Curves of single languages by their salt; other languages have those above.
        self.own_curves: dict[int, list[tuple[float, float]]] = {}

    def sums(self, words: Words, shape: np.ndarray, salts: np.ndarray | None = None, known: np.ndarray | None = None) -> np.ndarray:
        out = np.zeros((len(shape), len(TARGETS)))
        if not len(self.features):
            return out
        rows, found = [], []
        features = [(words.row, words.hash), (np.repeat(np.arange(len(shape)), shape.shape[1]), shape.ravel().astype(np.uint64))]
        if salts is not None:
            own = known[words.row]
            features.append((words.row[own], mix(words.hash[own] ^ salts[words.row[own]])))
        for row, feature in features:
            place = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
            hit = self.features[place] == feature
            rows.append(row[hit])
            found.append(place[hit])
        key = np.unique(np.concatenate(rows) * len(self.features) + np.concatenate(found))
        np.add.at(out, key // len(self.features), self.weights[key % len(self.features)])
        return out

    def log_odds(self, sums: np.ndarray, salts: np.ndarray | None = None, known: np.ndarray | None = None) -> np.ndarray:
        a, b = (np.tile(x, (len(sums), 1)).astype(float) for x in zip(*self.curves))
        for salt, curves in self.own_curves.items() if salts is not None else ():
            own = known & (salts == np.uint64(salt))
            a[own], b[own] = zip(*curves)
        return np.clip(a + b * np.clip(sums, -MOST, MOST), -30, 30)


def _curve(value: np.ndarray, yes: np.ndarray, n: np.ndarray, to: tuple[float, float] = (0.0, 1.0), pull: tuple[float, float] = (0.01, 1.0)) -> tuple[float, float]:
    """Logistic curve (intercept, slope) through binned counts, with a weak pull towards ``to`` (Newton's method)."""
    def loss(a: float, b: float) -> float:
        z = a + b * value
        return float((n * np.logaddexp(0, z) - yes * z).sum() + pull[0] / 2 * (a - to[0]) ** 2 + pull[1] / 2 * (b - to[1]) ** 2)

    a, b = to
    least = loss(a, b)
    for _ in range(100):
        z = np.clip(a + b * value, -30, 30)
        p = 1 / (1 + np.exp(-z))
        w = n * p * (1 - p) + 1e-9
        g = np.array([(yes - n * p).sum() - pull[0] * (a - to[0]), ((yes - n * p) * value).sum() - pull[1] * (b - to[1])])
        h = np.array([[w.sum() + pull[0], (w * value).sum()], [(w * value).sum(), (w * value * value).sum() + pull[1]]])
        step = np.linalg.solve(h, g)
        scale = 1.0
        while scale > 1e-9 and loss(a + scale * step[0], b + scale * step[1]) > least:
            scale /= 2
        a, b = a + scale * step[0], b + scale * step[1]
        least = loss(a, b)
        if scale * np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def _lang(docs: DataFrame) -> Column:
    return (docs["lang"] if "lang" in docs.columns else F.lit(None)).cast("string").alias("lang")


def _chosen(counts: DataFrame, shapes: bool) -> DataFrame:
    """(lang, feature, w_quality, w_toxic) of the features that tell the classes of their stratum apart.

    ``counts`` has n documents with the feature out of ``docs``, and of both those of each target. Shape features count
    over all documents only (``shapes``).
    """
    weight, clear = [], []
    shape = F.col("feature").between(0, SHAPE_IDS - 1)
    for t in TARGETS:
        of, n = F.col(f"docs_{t}"), F.col("n")
        yes, no = F.greatest(of, F.lit(1)), F.greatest(F.col("docs") - of, F.lit(1))
        pooled = n / F.greatest("docs", F.lit(1))
        z = F.abs(F.col(t) / yes - (n - F.col(t)) / no) / F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(1e-9)) * (1 / yes + 1 / no))
        ratio = F.log((F.col(t) + SMOOTH) / (yes + 2 * SMOOTH)) - F.log((n - F.col(t) + SMOOTH) / (no + 2 * SMOOTH))
        # words speak only for the rarer class: a long text has many words of either, and their sum would drown its shape
        share = F.when(yes <= no, F.col(t)).otherwise(n - F.col(t)) / n
        bound = (share + PURITY_Z**2 / (2 * n) - PURITY_Z * F.sqrt(share * (1 - share) / n + PURITY_Z**2 / (4 * n * n))) / (1 + PURITY_Z**2 / n)
        rarer = F.when(yes <= no, ratio).otherwise(-ratio)
        counts_for = (z >= MIN_Z) & F.when(shape, (n >= MIN_DOCS) & F.lit(shapes)).otherwise((rarer > 0) & (bound >= MIN_PURITY))
        clear.append(counts_for)
        weight.append(F.when(counts_for, ratio).otherwise(F.lit(0.0)).alias(f"w_{t}"))
    return counts.where(clear[0] | clear[1]).select("lang", "feature", *weight)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Fit on at most ``sample_rows`` labelled documents; four fifths give the weights, the others the curves."""
    scratch = Scratch(docs.sparkSession, "classifier")
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = scratch.save("sample", sample.withColumn("holdout", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _lang(docs)).join(F.broadcast(sample), "doc_id")  # at most ``sample_rows`` rows
    # copies of a text count once
    firsts = scratch.save("firsts", texts.where("not holdout").groupBy(F.xxhash64("text").alias("h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id"))
    fitting = texts.where("not holdout").join(F.broadcast(firsts), "doc_id", "left_semi")
    sizes = [F.count(F.lit(1)).alias("docs"), *(F.coalesce(F.sum((F.col(t) == 1).cast("long")), F.lit(0)).alias(f"docs_{t}") for t in TARGETS)]
    strata = scratch.save("strata", fitting.groupBy("lang").agg(*sizes))  # one row for each language
    whole = strata.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("docs", *(f"docs_{t}" for t in TARGETS))))
    totals = whole.first()
    features = fitting.select("doc_id", "text", "lang").mapInArrow(_count, "doc_id long, feature long, lang string").join(F.broadcast(sample), "doc_id")
    by_lang = features.groupBy("lang", "feature").agg(F.count(F.lit(1)).alias("n"), *(F.sum((F.col(t) == 1).cast("long")).alias(t) for t in TARGETS))
    by_lang = scratch.save("counts", by_lang)  # bounded by the sample
    pooled = by_lang.groupBy("feature").agg(*(F.sum(c).alias(c) for c in ("n", *TARGETS)))
    chosen = _chosen(pooled.crossJoin(F.broadcast(whole)).withColumn("lang", F.lit(None).cast("string")), True)
    chosen = chosen.unionByName(_chosen(by_lang.where(F.col("lang").isNotNull()).join(F.broadcast(strata), "lang"), False)).toPandas()
    weights = chosen[[f"w_{t}" for t in TARGETS]].to_numpy(dtype=float)
    keys, of_all = chosen["feature"].to_numpy(dtype=np.int64).view(np.uint64), chosen["lang"].isna().to_numpy()
    # a word that counts in every language counts once
    place = {feature: i for i, feature in enumerate(keys.tolist()) if of_all[i]}
    for i in np.flatnonzero(~of_all):
        if keys[i].item() in place:
            weights[i, weights[place[keys[i].item()]] != 0] = 0
    salts, _ = _salts(pa.array(chosen["lang"].where(~of_all, None).tolist(), pa.string()))
    keys = np.where(of_all, keys, mix(keys ^ salts))
    some = (weights != 0).any(axis=1)
    model = Classifier(keys[some].view(np.int64), weights[some], [(0.0, 1.0)] * 2, [0.5, 0.5])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    sums = texts.where("holdout").select("doc_id", "text", "lang").mapInArrow(lambda it: _sums(it, shared), "doc_id long, lang string, quality_sum double, toxic_sum double").join(F.broadcast(sample), "doc_id")
    model.curves, model.rates, own = [], [], {}
    for t in TARGETS:
        place = F.round(F.greatest(F.least(F.col(f"{t}_sum"), F.lit(MOST)), F.lit(-MOST)) * (BINS / (2 * MOST)))
        binned = sums.groupBy("lang", place.alias("bin")).agg(F.sum((F.col(t) == 1).cast("long")).alias("yes"), F.count(F.lit(1)).alias("n")).toPandas()
        points = lambda part: (part["bin"].to_numpy(dtype=float) * (2 * MOST / BINS), part["yes"].to_numpy(dtype=float), part["n"].to_numpy(dtype=float))
        model.curves.append(_curve(*points(binned)) if len(binned) else (0.0, 1.0))
        for lang, part in binned.groupby("lang"):
            own.setdefault(lang, []).append(_curve(*points(part), model.curves[-1], (LANG_PULL, 1.0)))
        model.rates.append((totals[f"docs_{t}"] + 1) / (totals["docs"] + 2))
    salts, _ = _salts(pa.array(list(own), pa.string()))
    model.own_curves = dict(zip(salts.tolist(), own.values()))
    return model


def _sums(batches, shared):
    for batch in batches:
        salts, known = _salts(batch.column(2))
        for at, to, words, shape in _features(batch.column(1)):
            sums = shared.value.sums(words, shape, salts[at:to], known[at:to])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), batch.column(2).slice(at, to - at), pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["doc_id", "lang", "quality_sum", "toxic_sum"])


def _evidence(batches, shared):
    for batch in batches:
        salts, known = _salts(batch.column(4))
        for at, to, words, shape in _features(batch.column(1)):
            odds = shared.value.log_odds(shared.value.sums(words, shape, salts[at:to], known[at:to]), salts[at:to], known[at:to])
            columns = [batch.column(i).slice(at, to - at) for i in (0, 2, 3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(odds[:, 0]), pa.array(odds[:, 1])], names=["doc_id", "host", "path", "quality_odds", "toxic_odds"])


def _strength(rows: DataFrame, keys: list[str], target: str, rate: Column, floor: float = 1.0, most: float = 1e6) -> float:
    """Documents that a site's parent counts for: the within-site variance over the variance of the true rates."""
    groups = rows.groupBy(*keys).agg(F.sum(F.col("docs").cast("double")).alias("n"), F.sum(target).alias("s"), F.first(rate).alias("m"))
    spread = groups.agg(
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("m"), 2)).alias("q"), F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"), F.sum(F.pow(F.col("n").cast("double"), 2)).alias("nn"), F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("v"),
    ).first()
    if not spread["n"] or spread["k"] < 2:
        return most
    within = spread["v"] / spread["n"]
    between = (spread["q"] - (spread["k"] - 1) * within) / max(spread["n"] - spread["nn"] / spread["n"], 1e-9)
    return most if between <= 0 else min(most, max(floor, within / between))


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, model: Classifier | None = None) -> DataFrame:
    """One row per input row: doc_id, host, path, site_quality, quality, toxic (probabilities), kept.

    ``kept`` holds for quality at least 0.5 and toxicity under 0.5. ``host`` and ``path`` are columns of ``docs``; by
    default the source, and the language as its section. Null hosts and paths are sites of their own. A null or empty
    text has the features of a text without words; long texts are read whole, in a run of their own. Without labels every document has the same evidence. Repeated rows
    and rows without doc_id are treated like others; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "bayes")
    model = model or fit(docs, labels)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (docs["source"] if host is None else host).alias("host"), (docs["lang"] if path is None else path).alias("path"), _lang(docs))
    rows = rows.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    scored = scratch.save("evidence", rows.mapInArrow(lambda it: _evidence(it, shared), "doc_id long, host string, path string, quality_odds double, toxic_odds double"))
    probability = lambda odds: 1 / (1 + F.exp(-F.col(odds)))
    sites = scratch.save(
        "paths",
        scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("docs"), *(F.sum(probability(f"{t}_odds")).alias(t) for t in TARGETS)),
    )
    hosts = scratch.save("hosts", sites.groupBy("host").agg(F.sum("docs").alias("host_docs"), *(F.sum(t).alias(f"host_{t}") for t in TARGETS)))
    totals = hosts.agg(F.sum("host_docs").alias("n"), *(F.sum(f"host_{t}").alias(t) for t in TARGETS)).first()
    joined = sites.join(hosts, "host")
    strengths = {}
    for t in TARGETS:
        overall = F.lit((totals[t] or 0.0) / (totals["n"] or 1))
        strengths[t] = (_strength(joined, ["host"], t, overall), _strength(joined, ["host", "path"], t, F.col(f"host_{t}") / F.col("host_docs")))
    joined = scratch.save("sites", joined)
    # a site may have most documents, so its rows are dealt over salts
    found = join_counted(scored, joined.withColumn("n", F.col("docs")), ["host", "path"], totals["n"] or 0, ["doc_id", "quality_odds", "toxic_odds"])
    out = {}
    for t in TARGETS:
        by_host, by_path = strengths[t]
        own = probability(f"{t}_odds")
        overall = (totals[t] or 0.0) / (totals["n"] or 1)
        host_rate = (F.col(f"host_{t}") - own + by_host * overall) / (F.col("host_docs") - 1 + by_host)
        site = (F.col(t) - own + by_path * host_rate) / (F.col("docs") - 1 + by_path)
        site = F.greatest(F.least(site, F.lit(1 - 1e-9)), F.lit(1e-9))
        base = min(max(model.rates[TARGETS.index(t)], 1e-9), 1 - 1e-9)
        odds = F.col(f"{t}_odds") - math.log(base / (1 - base)) + F.log(site / (1 - site))
        out |= {f"site_{t}": site, f"p_{t}": 1 / (1 + F.exp(-odds))}
    found = found.withColumns(out)
    return found.select("doc_id", "host", "path", F.col("site_quality"), F.col("p_quality").alias("quality"), F.col("p_toxic").alias("toxic"), ((F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5)).alias("kept"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
