import math
import random
from collections import Counter, defaultdict
from functools import cache
from pathlib import Path
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import language_id
from tidemark.llm.language_id import _model, identify, learn_counts, op4_language_id, train

SF = Path("/root/testdata/sf0.001")


def plain_bits(training, text):
    """Method C with exclusion by recursion over contexts."""
    counts = defaultdict(Counter)
    for t in training:
        raw = b"\n\n\n" + t.encode()
        for i in range(3, len(raw)):
            for k in range(4):
                counts[raw[i - k : i]][raw[i]] += 1

    def p(context, byte):
        shorter = (lambda b: p(context[1:], b)) if context else (lambda b: 1 / 256)
        seen = counts.get(context)
        if not seen:
            return shorter(byte)
        left = sum(shorter(b) for b in range(256) if b not in seen)
        total = sum(seen.values()) + (len(seen) if left > 0 else 0)
        return seen[byte] / total if byte in seen else len(seen) / total * shorter(byte) / left

    p = cache(p)
    raw = b"\n\n\n" + text.encode()
    return sum(-math.log2(p(raw[i - 3 : i], raw[i])) for i in range(3, len(raw)))


def model_of(tables):
    return _model(tables, [r.lang for r in tables.select("lang").distinct().collect()])


TRAINING = {"a": ["aba bab\nabba", "ab"], "b": ["bcb cc b", "é c"], "c": ["".join(map(chr, range(1, 128))), "漢字 ½"]}


def test_code_lengths_against_recursion(spark, docs_of):
    docs = docs_of([(1, t, k) for k, ts in TRAINING.items() for t in ts])
    model = model_of(train(docs))
    assert model.languages == ["a", "b", "c"]
    texts = ["abab", "cb", "é", "xyz ab", "b", "漢字 字漢", "\x01\x02", "aba bab\nabba é c", "日本"]
    got = model.code_lengths([p for t in texts for p in (b"\n\n\n", t.encode())])
    want = [[plain_bits(TRAINING[k], t) for k in model.languages] for t in texts]
    assert np.allclose(got, want, rtol=1e-4)


def test_predictions_against_recursion(spark, docs_of):
    docs = spark.read.parquet(str(SF / "documents.parquet")).orderBy("doc_id").select("doc_id", "lang", F.substring("text", 1, 90).alias("text")).collect()
    training, rows = defaultdict(list), []
    for r in docs[:40]:
        training[r.lang].append(r.text)
    asked = [(r.doc_id, r.text) for r in docs[40:48]]
    tables = train(docs_of([(r.doc_id, r.text, r.lang) for r in docs[:40]]))
    languages = sorted(training)
    for doc_id, text in asked:
        bits = [plain_bits(training[k], text) for k in languages]
        rows.append((doc_id, languages[int(np.argmin(bits))], 1 / sum(2 ** max(min(bits) - b, -1000) for b in bits)))
    for cells in (1 << 24, 1):  # one block, and a block for each language
        got = sorted((r.doc_id, r.lang_pred, r.score) for r in identify(docs_of(asked), tables, cells).collect())
        assert [g[:2] for g in got] == [r[:2] for r in sorted(rows)] and np.allclose([g[2] for g in got], [r[2] for r in sorted(rows)], rtol=1e-2)


def test_every_context_is_a_distribution(docs_of):
    model = model_of(train(docs_of([(1, t, k) for k, ts in TRAINING.items() for t in ts])))
    for context in (b"aba", b"xab", b"xyb", b"xyz", "漢".encode(), b"\x01\x02\x03"):
        code = int.from_bytes(context) * 256 + np.arange(256)
        place = model.strings.of(code)
        bits = np.where((place >= 0)[:, None], model.after_3[place], model._escaped(code))
        assert np.allclose(np.exp2(-bits.astype(float)).sum(axis=0), 1, atol=1e-3)


def test_seventy_languages_and_ties(docs_of):
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiouy"][:70]
    text = lambda i, n: " ".join(syllables[i] + syllables[(i + k) % 70][0] for k in range(1, n))
    tables = train(docs_of([(i, text(i, 20), f"l{i:02}") for i in range(70)] + [(100, text(3, 20), "same as l03")]))
    for cells in (1 << 24, 20_000):
        got = identify(docs_of([(i, text(i, 12)) for i in range(70)] + [(0, "12 ½ ²"), (3, text(3, 12))]), tables, cells).collect()
        assert sorted((r.doc_id, r.lang_pred) for r in got) == sorted([(i, f"l{i:02}") for i in range(70)] + [(0, "und"), (3, "l03")])


def test_sample_is_bounded_by_language(docs_of, monkeypatch):
    docs = docs_of([(i, f"wort {i} " * 50, "de") for i in range(400)] + [(1000 + i, f"mot {i} " * 5, "fr") for i in range(10)])
    totals = []
    for most in (10_000, 0):  # sizes broadcast, and joined with salted keys
        monkeypatch.setattr(language_id, "MOST_BROADCAST", most)
        totals.append({r.lang: r.n for r in learn_counts(docs, 20_000).groupBy("lang").agg(F.sum("n").alias("n")).collect()})
    total = totals[0]
    assert totals[1] == total and 10_000 < total["de"] < 30_000 and total["fr"] == sum(len(f"mot {i} " * 5) for i in range(10))


def test_odd_rows(spark, docs_of):
    rows = [(1, "the and of the", "en"), (2, "der die das und", "de"), (3, None, "en"), (4, "", "en"), (5, "12 34 !", "de"), (None, "the of", None), (6, "das und " * 20_000, None), (6, "und", None)]
    docs = docs_of([(i, t, lang) for i, t, lang in rows]).withColumn("score", F.lit("x"))
    got = identify(docs, train(docs)).collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in got) == sorted([("1", "en"), ("2", "de"), ("3", "und"), ("4", "und"), ("5", "und"), ("None", "en"), ("6", "de"), ("6", "de")])
    assert all(0 <= r.score <= 1 for r in got)
    assert identify(docs_of([]), train(docs_of([]))).count() == 0
    assert [r.lang_pred for r in identify(docs_of([(1, "abc")]), train(docs_of([]))).collect()] == ["und"]


def test_held_out_accuracy(spark):
    sf = str(SF).replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = op4_language_id(spark, sf).join(docs, "doc_id").collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert len(held) > 200 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98


def test_no_language_is_lost_by_the_sample(spark, docs_of):
    """A language whose few texts are each larger than the sample is learned from one of them at least."""
    books = [(i, "the house and garden " * 300, "en") for i in range(40)] + [(100 + i, f"das haus {i} und der garten " * 250, "de") for i in range(3)] + [(200, "la maison et le jardin " * 300, "fr")]
    for sample in (1, 600, 1200, 3000):
        found = {r.lang for r in learn_counts(docs_of(books).select("doc_id", "lang", "text"), sample).select("lang").distinct().collect()}
        assert found == {"en", "de", "fr"}


def test_the_draw_holds_for_any_size(spark):
    """Shares of a language with 2**40 bytes and more, where products of longs would overflow."""
    rows = spark.range(4000).select((F.col("id") * (1 << 50)).alias("draw"))
    for size in (2.0**20, 2.0**40, 2.0**60):
        share = rows.where(language_id.drawn(F.col("draw"), F.lit(size), F.lit(-1), int(size / 4))).count() / 4000
        assert abs(share - 1 / 4 * (1 << 62) / (4000 << 50)) < 0.01
    assert rows.where(language_id.drawn(F.col("draw"), F.lit(2.0**60), F.lit(0), 1)).count() == 1


def test_many_languages_in_one_scan(spark, docs_of):
    """Blocks of any size give the same predictions, and the texts are read once."""
    rng = random.Random(3)
    names = [f"l{i:02}" for i in range(12)]
    docs = docs_of([(i, " ".join("".join(rng.choice("abcdefgh"[k % 5 : k % 5 + 4]) + name[1:] for k in range(4)) for _ in range(20)), name) for i, name in enumerate(names * 5)])
    tables = train(docs).cache()
    key = lambda r: (r.doc_id, r.lang_pred, round(r.score, 9))
    whole = sorted(map(key, identify(docs, tables).collect()))
    for cells in (1, 2000):
        assert len(language_id.blocks_of(tables, cells)) > 1
        found = identify(docs, tables, cells)
        assert sorted(map(key, found.collect())) == whole
        assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert len(language_id.blocks_of(tables, 1 << 24, 10)) == 12
