import math
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality_classifier
from tidemark.llm.quality_classifier import Classifier, _curve, classify, fit

SF = "/root/testdata/sf0.01"


def test_accuracy_on_labels_that_were_not_fitted(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0)
    got = classify(docs, seen).select("doc_id", "kept").join(labels.join(seen, "doc_id", "left_anti").toDF("doc_id", "good", "bad"), "doc_id").collect()
    clean = [r for r in got if r.good == 1 and r.bad == 0]
    assert len(got) > 80 and sum(r.kept for r in clean) / len(clean) > 0.97
    junk = [r for r in got if r.good == 0 or r.bad == 1]
    assert sum(not r.kept for r in junk) / len(junk) > 0.5


def test_posteriors_against_plain_arithmetic(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, rng.choice(["good words here", "spam spam", "", None]), rng.choice(["a", "b", None]), rng.choice(["h1", "h2", "h3", None])) for i in range(80)] + [(None, "x", "a", "h9"), (3, "x", "a", "h9")]
    model = Classifier(np.array([1], dtype=np.int64), np.zeros((1, 2)), [(0.4, 1.0), (-2.0, 1.0)], [0.6, 0.1])
    from tidemark.llm._words import Words

    data = np.frombuffer(b"spam", dtype=np.uint8)
    spam = Words(data, np.array([0, 4])).hash
    model = Classifier(spam.view(np.int64), np.array([[-1.5, 2.0]]), [(0.4, 1.0), (-2.0, 1.0)], [0.6, 0.1])
    got = sorted((tuple(r) for r in classify(docs_of(rows).withColumn("path", F.lit(1)), None, model=model).collect()), key=str)
    own = lambda t, k: 1 / (1 + math.exp(-([0.4, -2.0][k] + ([-1.5, 2.0][k] if t and "spam" in t else 0))))
    want = []
    sites = [(i, t, h or "", lang or "") for i, t, lang, h in rows]
    posts = []
    for k in range(2):
        total = sum(own(t, k) for _, t, _, _ in sites)
        overall = total / len(sites)

        def strength(groups, parent):
            n = sum(len(g) for g in groups.values())
            within = sum(len(g) * parent(key) * (1 - parent(key)) for key, g in groups.items()) / n
            q = sum(len(g) * (sum(g) / len(g) - parent(key)) ** 2 for key, g in groups.items())
            between = (q - (len(groups) - 1) * within) / max(n - sum(len(g) ** 2 for g in groups.values()) / n, 1e-9)
            return 1e6 if between <= 0 else min(1e6, max(1.0, within / between))

        hosts, paths = defaultdict(list), defaultdict(list)
        for _, t, h, p in sites:
            hosts[h].append(own(t, k))
            paths[h, p].append(own(t, k))
        kh = strength(hosts, lambda h: overall)
        kp = strength(paths, lambda hp: sum(hosts[hp[0]]) / len(hosts[hp[0]]))
        out = []
        for _, t, h, p in sites:
            mine = own(t, k)
            host_rate = (sum(hosts[h]) - mine + kh * overall) / (len(hosts[h]) - 1 + kh)
            site = (sum(paths[h, p]) - mine + kp * host_rate) / (len(paths[h, p]) - 1 + kp)
            odds = math.log(mine / (1 - mine)) - math.log([0.6, 0.1][k] / (1 - [0.6, 0.1][k])) + math.log(site / (1 - site))
            out.append((site, 1 / (1 + math.exp(-odds))))
        posts.append(out)
    for (i, t, h, p), (site, quality), (_, toxic) in zip(sites, *posts):
        want.append((i, h, p, site, quality, toxic, quality >= 0.5 and toxic < 0.5))
    want.sort(key=str)
    key = lambda r: (str(r[0]), r[1], r[2], round(r[4], 9))
    got.sort(key=key), want.sort(key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3:6] for r in got], [r[3:6] for r in want], rtol=1e-6)
    assert [r[6] for r in got] == [r[6] for r in want]


def test_curve_recovers_a_logistic():
    x = np.linspace(-4, 4, 81)
    n = np.full(81, 10_000.0)
    a, b = _curve(x, n / (1 + np.exp(-(0.5 + 1.3 * x))), n)
    assert abs(a - 0.5) < 0.01 and abs(b - 1.3) < 0.01


def test_no_labels_and_no_documents(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = classify(docs_of([(1, "a b"), (2, None)]), none).collect()
    assert len(got) == 2 and len({round(r.quality, 9) for r in got}) == 1
    assert classify(docs_of([]), none).count() == 0


def test_toxic_words_of_every_language(spark, docs_of):
    rng = random.Random(5)
    rows, labels = [], []
    for lang, n, word in (("en", 900, "scum"), ("de", 120, "miststück"), ("fr", 60, "ordure")):
        for i in range(n):
            bad = rng.random() < 0.15
            words = [f"{lang}{rng.randint(0, 300)}" for _ in range(39 - bad)] + [word] * bad
            rng.shuffle(words)
            labels.append((len(rows), 1, int(bad)))
            rows.append((len(rows), " ".join(words), lang, "s"))
    got = {r.doc_id: (r.kept, r.lang) for r in classify(docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).join(docs_of(rows).select("doc_id", "lang"), "doc_id").collect()}
    for lang in ("en", "de", "fr"):
        own = [(got[i][0], bad) for i, _, bad in labels if got[i][1] == lang]
        toxic = [kept for kept, bad in own if bad]
        assert len(toxic) > 3 and sum(not k for k in toxic) / len(toxic) > 0.9
        assert sum(kept for kept, bad in own if not bad) / sum(not bad for _, bad in own) > 0.97


def test_sites_of_any_size(spark):
    """Sums of squares of ten thousand million documents are beyond 64 bits."""
    from tidemark.llm.quality_classifier import _strength

    def plain(groups, rate):
        n = sum(g[0] for g in groups)
        within = rate * (1 - rate)
        q = sum(g[0] * (g[1] / g[0] - rate) ** 2 for g in groups)
        between = (q - (len(groups) - 1) * within) / (n - sum(g[0] ** 2 for g in groups) / n)
        return min(1e6, max(1.0, within / between))

    groups = [(10**10, 4e9), (3 * 10**9, 1e9), (5, 2.0)]
    rows = spark.createDataFrame([(f"h{i}", n, s) for i, (n, s) in enumerate(groups)], "host string, docs long, toxic double")
    assert math.isclose(_strength(rows, ["host"], "toxic", F.lit(0.37)), plain(groups, 0.37), rel_tol=1e-9)


def test_chosen_words_against_plain_counts(spark, docs_of):
    """Which words speak for a class, and how much, from a count of some hundred documents."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(700):
        bad = rng.random() < 0.2
        words = [f"w{rng.randint(0, 60)}" for _ in range(30)] + ["scum"] * (bad and rng.random() < 0.8) + ["odd"] * (rng.random() < 0.1) + ["vile"] * (bad and rng.random() < 0.3)
        rng.shuffle(words)
        rows.append((i, " ".join(words), rng.choice(["a", "b"]), "s"))
        labels.append((i, 1, int(bad)))
    rows += [(1000 + i, rows[i][1], "a", "s") for i in range(40)]  # copies count once
    labels += [(1000 + i, 1, labels[i][2]) for i in range(40)]
    model = fit(docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    import zlib

    fitting = [(r, lab) for r, lab in zip(rows, labels) if zlib.crc32(str(r[0]).encode()) % 5 != 0]
    seen, kept = set(), []
    for r, lab in sorted(fitting, key=lambda x: x[0][0]):
        if r[1] not in seen:
            seen.add(r[1])
            kept.append((set(r[1].split()), lab[2]))
    total, yes = len(kept), sum(b for _, b in kept)
    want = {}
    for word in {w for ws, _ in kept for w in ws}:
        n, k = sum(word in ws for ws, _ in kept), sum(b for ws, b in kept if word in ws)
        pooled = n / total
        z = abs(k / yes - (n - k) / (total - yes)) / math.sqrt(max(pooled * (1 - pooled), 1e-9) * (1 / yes + 1 / (total - yes)))
        ratio = math.log((k + 0.5) / (yes + 1)) - math.log((n - k + 0.5) / (total - yes + 1))
        share = k / n
        bound = (share + 4 / (2 * n) - 2 * math.sqrt(share * (1 - share) / n + 4 / (4 * n * n))) / (1 + 4 / n)
        if z >= 6 and ratio > 0 and bound >= 0.5:
            want[word] = ratio
    assert set(want) == {"scum", "vile"}
    from tidemark.llm._words import Words

    hashes = {w: int(Words(np.frombuffer(w.encode(), dtype=np.uint8), np.array([0, len(w)])).hash[0]) for w in {w for ws, _ in kept for w in ws}}
    place = {int(f): i for i, f in enumerate(model.features)}
    got = {w: model.weights[place[h], 1] for w, h in hashes.items() if h in place and model.weights[place[h], 1] != 0}
    assert set(got) == set(want) and all(math.isclose(got[w], want[w], rel_tol=1e-9) for w in want)
