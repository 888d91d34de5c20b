import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity as tx

INSULTS = ["idiot", "moron", "scum", "clown", "worthless", "pathetic"]
HIDDEN = {
    "idiot": ["1d10t", "i d i o t", "iiidiot", "i.d.i.o.t"], "moron": ["m0r0n", "m o r o n", "mooooron", "m-o-r-o-n"], "scum": ["$cum", "s c u m", "scuuuum", "s_c_u_m"],
    "clown": ["cl0wn", "c l o w n", "clowwwwn", "c*l*o*w*n"], "worthless": ["w0rthl3ss", "w o r t h l e s s", "wooorthless"], "pathetic": ["p@th3t1c", "p a t h e t i c", "patheeetic"],
}
WORDS = "the of and house letter little summer running water happy people green street yellow middle coffee bottle story window garden morning paper again never always often market".split()


def corpus(n=1500, seed=1):
    """(rows, labels, rows with hidden words): every seventh document has an insult."""
    rng = random.Random(seed)
    rows, labels, hidden = [], [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(8, 30))]
        bad = i % 7 == 0
        mask = list(words)
        if bad:
            at, insult = rng.randrange(len(words)), rng.choice(INSULTS)
            words[at : at + 1] = [insult]
            mask[at : at + 1] = [rng.choice(HIDDEN[insult])]
        rows.append((i, " ".join(words) + "."))
        hidden.append((i + n, " ".join(mask) + "."))
        labels.append((i, int(bad)))
    return rows, labels, hidden


@pytest.fixture(scope="module")
def model(spark, docs_of):
    rows, labels, _ = corpus()
    return tx.fit(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_hidden_words_are_restored_and_scored(spark, docs_of, model):
    decoder = tx.Decoder(model.costs)
    for word, masks in HIDDEN.items():
        for mask in masks:
            assert decoder.restore([f"the {mask} of"])[0] == [f"the {word} of"], mask
    for text in ["The letter, little summer.", "a running water (coffee)", "don't 12 3.5 x"]:
        assert decoder.restore([text]) == ([text], [0])
    _, _, hidden = corpus()
    got = {r.doc_id: r for r in tx.score_toxicity(docs_of(hidden), model).collect()}
    bad = [i for i, _ in hidden if (i - 1500) % 7 == 0]
    assert sum(got[i].score >= 0.5 for i in bad) / len(bad) > 0.97
    assert not [i for i, _ in hidden if i not in bad and got[i].score >= 0.5]
    assert all(got[i].n_restored for i in bad) and min(r.score for r in got.values()) >= 0 and max(r.score for r in got.values()) <= 1


def test_held_out_accuracy(spark, docs_of, model):
    rows, labels, _ = corpus()
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    got = {r.doc_id: r.score >= 0.5 for r in tx.score_toxicity(docs_of(rows), model).collect()}
    assert len(held) > 200 and all(got[i] == bool(labels[i][1]) for i in held)


def test_viterbi_against_all_readings(model):
    rng = random.Random(4)
    table = np.array([rng.uniform(0.1, 6) for _ in range(tx.CONTEXTS * tx.SYMBOLS)], dtype=np.float32)
    for decoder in (tx.Decoder(model.costs), tx.Decoder(table)):
        for _ in range(250):
            span = "".join(rng.choice("ab1$0.- éo!|") * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randint(1, 6)))

            def cost(choice):
                more, context = decoder.price("".join(r for r, _ in choice), 0)
                return sum(c for _, c in choice) + more + (decoder.costs[context * tx.SYMBOLS] if context else 0)

            every = list(itertools.product(*(tx.readings(c, n) for c, n in tx.runs(span))))
            best = min(map(cost, every))
            found = decoder.decode(span)
            assert min(cost(c) for c in every if "".join(r for r, _ in c) == found) == pytest.approx(best, abs=1e-6)


def test_language_model_against_plain_counts(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abé c1.\n") for _ in range(40))) for i in range(60)] + [(100, None), (101, ""), (102, "  "), (103, "日本 語x")]
    got = {r.gram: r.n for r in tx.gram_counts(docs_of(rows)).collect()}
    want = Counter()
    for _, text in rows:
        for word in re.split(r"[ \n]+", text or ""):
            symbols = [tx._symbol(c) for c in word]
            for k, s in enumerate([*symbols, 0] if symbols else []):
                a, b, c = [0, 0, 0, *symbols][k : k + 3]
                want[((a * 30 + b) * 30 + c) * 30 + s] += 1
    assert got == dict(want)
    costs = tx.gram_costs(np.array(list(got)), np.array(list(got.values())))
    p = np.exp(-costs.astype(float)).reshape(-1, tx.SYMBOLS)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)

    def plain(context, symbol):
        if context is None:
            return 1 / tx.SYMBOLS
        own = {g % 30: 0 for g in got}
        for g, n in got.items():
            before = (g // 27000, g // 900 % 30, g // 30 % 30)
            if before[3 - len(context) :] == context:
                own[g % 30] += n
        own = {k: v for k, v in own.items() if v}
        lower = plain(context[1:] if context else None, symbol)
        return (own.get(symbol, 0) + len(own) * lower) / (sum(own.values()) + len(own)) if own else lower

    for gram in [*list(got)[:40], 5, 27005, 809999]:
        context = (gram // 27000, gram // 900 % 30, gram // 30 % 30)
        assert costs[gram] == pytest.approx(-math.log(plain(context, gram % 30)), abs=1e-4)


def plain_spans(decoder, text):
    """Character by character what ``Decoder.spans`` finds in one text."""
    low = "".join(chr(int(p)) for p in tx.Chunk([text]).points)[: len(text)]
    tokens = [m.span() for m in re.finditer(r"[^\t\n\x0b\x0c\r ]+", low)]
    letter = lambda c: 1 <= tx._symbol(c) <= 27

    def hides(a, b):
        w = low[a:b]
        for i, c in enumerate(w):
            if letter(c) and w[i : i + 3] == 3 * c:
                return True
            if letter(c) and w[i : i + 2] == 2 * c:
                if decoder.price(w, 0)[0] + (end := lambda x: decoder.costs[x * 30] if x else 0)(decoder.price(w, 0)[1]) - decoder.price(w[:i] + w[i + 1 :], 0)[0] - end(decoder.price(w[:i] + w[i + 1 :], 0)[1]) > tx.PAIR:
                    return True
            if (c in tx.LOOK_ALIKES or c in tx.SEPARATORS) and any(map(letter, w[:i])) and any(map(letter, w[i + 1 :])):
                return True
            if c in "0123456789@$€" and any(map(letter, w[max(0, i - 1) : i] + w[i + 1 : i + 2])):
                return True
        return False

    single = [b - a == 1 and (letter(low[a]) or low[a] in tx.LOOK_ALIKES) for a, b in tokens]
    out, k = [], 0
    while k < len(tokens):
        to = k
        while single[k] and to + 1 < len(tokens) and single[to + 1] and tokens[to + 1][0] == tokens[to][1] + 1:
            to += 1
        if to - k + 1 >= tx.SPACED:
            out.append((tokens[k][0], tokens[to][1]))
        else:
            out += [t for t in tokens[k : to + 1] if hides(*t)]
        k = to + 1
    return out


def test_spans_against_plain_rules(model):
    decoder = tx.Decoder(model.costs)
    rng = random.Random(9)
    texts = ["".join(rng.choice(["a", "t", "l", "e", "e", "1", "$", ".", " ", " ", "\n", "é", "日", "letter", "the", " x", "!"]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    chunk = tx.Chunk(texts)
    starts, ends = decoder.spans(chunk)
    got = list(zip(starts.tolist(), ends.tolist()))
    want = [(a + int(chunk.offsets[i]), b + int(chunk.offsets[i])) for i, t in enumerate(texts) for a, b in plain_spans(decoder, t)]
    assert got == want


def test_odd_rows(spark, docs_of, model):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "1"), (5, "x" * 100_000), (6, "a " * 30_000), (7, "İstanbul ſ 日本"), (None, "an 1d10t"), (9, "an 1d10t"), (9, "an 1d10t")]
    docs = docs_of(rows).withColumns({"score": F.lit("x"), "word": F.lit(1), "restored": F.lit(None), "toxic": F.lit(1)})
    got = sorted(((r.doc_id, r.restored, r.score) for r in tx.score_toxicity(docs, model).collect()), key=str)
    assert len(got) == len(rows)
    by = {}
    for i, text, score in got:
        by.setdefault(i, []).append((text, score))
    assert by[1] == by[2] and by[1][0][0] == "" and by[1][0][1] < 0.5
    assert by[9][0] == by[9][1] == by[None][0] and by[9][0][1] >= 0.5
    assert by[7][0][0] == "İstanbul ſ 日本"
    assert tx.score_toxicity(docs_of([]), model).count() == 0


def test_without_labels_or_documents(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for rows in ([], [(1, "a word"), (2, None)]):
        found = tx.fit(docs_of(rows), none)
        assert not len(found.words) and all(r.score < 0.5 for r in tx.score_toxicity(docs_of([(1, "a"), (2, None)]), found).collect())
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, toxic int")
    assert tx.score_toxicity(docs_of([(1, "a")]), tx.fit(docs_of([(1, "a"), (2, "b"), (None, "c")]), labels)).count() == 1
