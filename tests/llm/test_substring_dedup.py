import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import substring_dedup
from tidemark.llm._scratch import Scratch
from tidemark.llm._words import Words, chunks, word_hashes
from tidemark.llm.substring_dedup import dedup_substrings, repeated_spans


def kept_words(rows):
    """(doc_id, words, places that go) of each row."""
    words = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for p in range(len(w) - 12):
                k = tuple(w[p : p + 13])
                first[k] = min(i, first.get(k, i))
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - 12):
            if i is not None and first[tuple(w[p : p + 13])] < i:
                gone |= set(range(p, p + 13))
        out.append((i, w, gone))
    return out


def plain(rows):
    out = []
    for i, w, gone in kept_words(rows):
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()), key=str)


def make(rng, n):
    word = lambda: "".join(rng.choice("abcdéf") for _ in range(rng.randint(1, 3)))
    passages = [[word() for _ in range(rng.randint(10, 60))] for _ in range(8)]
    rows, docs = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            at = rng.randint(0, len(w))
            w[at:at] = p[a : a + rng.randint(8, 60)]
        if docs and rng.random() < 0.2:
            w = list(rng.choice(docs))
            if w and rng.random() < 0.6:
                w[rng.randrange(len(w))] = word()
        docs.append(w)
        rows.append((rng.choice([i, 1000 - i]), rng.choice([" ", "\n", " \t "]).join(w)))
    return rows


def test_against_brute_force(docs_of):
    rows = make(random.Random(7), 250) + [(5000, None), (5001, ""), (5002, " \n"), (None, "x " * 30), (5003, "x " * 30), (5004, "x " * 29)]
    rows += [rows[3], (rows[4][0], rows[5][1])]
    extra = docs_of(rows, 5).withColumns({"rid": F.lit(1), "m": F.lit(2), "spans": F.lit(3)})
    assert digest(dedup_substrings(extra)) == plain(rows)


def thue_morse(n, a, b):
    """Two words of 2**n letters that collide under every odd base modulo 2**64 once n is 11."""
    x, y = a, b
    for _ in range(n):
        x, y = x + y, y + x
    return x, y


def test_colliding_words_hot_passages_periods_and_long_texts(docs_of):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"a{i} b{i} {passage if i % 3 else ''} c{i}") for i in range(900)]
    cycle = " ".join(f"w{i % 7}" for i in range(100))
    long = " ".join(f"u{i}" for i in range(30_000))
    rows += [(1001, cycle), (1002, cycle + " end"), (1003, "a " + cycle), (1004, "z " * 40), (1005, "y " + "z " * 20), (1006, long), (1007, long + " " + cycle), (1008, "k " + long)]
    t, u = thue_morse(11, "a", "b")
    w, p = [f"w{i}" for i in range(12)], [f"q{i}" for i in range(20)]
    rows += [(2001, " ".join([*w, t, "x1"])), (2002, " ".join([*w, u, "y2", "z3"])), (2003, " ".join([*p, t])), (2004, " ".join([*p, u]))]
    t, u = (" ".join(x) for x in thue_morse(11, ["a"], ["b"]))
    rows += [(3001, " ".join(p) + " " + t), (3002, " ".join(p) + " " + u), (3003, "q " + t)]
    assert digest(dedup_substrings(docs_of(rows, 12))) == plain(rows)


def weak(bits):
    real = Words.windows
    return lambda self, size: real(self, size) & np.uint64((1 << bits) - 1)


@pytest.mark.parametrize("bits", (6,))
def test_colliding_windows_are_told_apart_by_their_words(docs_of, monkeypatch, bits):
    monkeypatch.setattr(Words, "windows", weak(bits))
    rows = make(random.Random(9), 120)
    assert digest(dedup_substrings(docs_of(rows))) == plain(rows)


def test_window_of_an_unrelated_earlier_document_hides_no_repeat(docs_of, monkeypatch):
    real = Words.windows

    def collide(self, size):
        found = real(self, size)
        if size == 13:
            found[np.isin(self.hash[: len(found)], word_hashes(np.frombuffer(b"AB", np.uint8), np.array([0, 1]), np.array([1, 2])))] = 7
        return found

    monkeypatch.setattr(Words, "windows", collide)
    tail = " ".join(f"t{i}" for i in range(12))
    rows = [(1, "A " + tail), (2, "B " + tail), (3, "x B " + tail + " y"), (4, "B " + tail), (5, "A " + tail + " end")]
    assert digest(dedup_substrings(docs_of(rows))) == plain(rows)


def test_paths_follow_unbranched_nodes(docs_of, spark):
    """Edges that occur together in all documents are one path, across blocks; a document that begins, ends or forks there ends it."""
    text = [f"w{i}" for i in range(300)]
    rows = [(1, " ".join(text)), (2, "x " + " ".join(text)), (3, " ".join(text[100:140]) + " fork " + " ".join(f"f{i}" for i in range(20))), (4, " ".join(text[120:140]) + " fork " + " ".join(f"f{i}" for i in range(20)))]
    docs = docs_of(rows).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rid"))
    spans, copies = repeated_spans(docs, Scratch(spark, "test"))
    found = sorted((r.doc_id, r.start, r.stop, r.src, r.shift) for r in spans.collect())
    assert copies.count() == 0
    assert [f for f in found if f[0] == 2] == [(2, 1, 301, 1, -1)]  # four paths, one source
    assert [f for f in found if f[0] == 3] == [(3, 0, 40, 1, 100)]
    assert [f for f in found if f[0] == 4] == [(4, 0, 20, 1, 120), (4, 8, 41, 3, 20)]


def single_edges(edges, scratch):
    return edges.select("h", "src", "srid", "srcpos", F.lit(1).alias("edges"), "n")


def test_documents_meet_paths_and_not_edges(spark, docs_of, monkeypatch):
    """The rows are the same if every edge is a path of its own, but many times as many rows are met."""
    rng = random.Random(2)
    passages = [" ".join(f"p{k}x{i}" for i in range(60 + 40 * k)) for k in range(5)]
    rows = [(i, f"a{i} {rng.choice(passages)} b{i} {rng.choice(passages)}") for i in range(60)]
    met = []
    real = substring_dedup._met

    def counted(*a):
        found = real(*a)
        met.append(found.count())
        return found

    monkeypatch.setattr(substring_dedup, "_met", counted)
    assert digest(dedup_substrings(docs_of(rows))) == plain(rows)
    monkeypatch.setattr(substring_dedup, "compact_paths", single_edges)
    assert digest(dedup_substrings(docs_of(rows))) == plain(rows)
    assert met[1] > 40 * met[0] > 0


def test_paths_against_a_plain_walk(spark):
    """Paths of random texts with few words, whose graph branches often."""
    rng = random.Random(6)
    texts = {i: [rng.choice("ab") for _ in range(rng.randint(10, 60))] for i in range(1, 30)}
    base = [rng.choice("abcdefgh") for _ in range(900)]
    texts |= {100 + i: base[a : a + rng.randint(150, 300)] for i, a in enumerate(rng.sample(range(700), 7))}
    at = {}
    for i, w in texts.items():
        for p in range(len(w) - 12):
            at.setdefault(tuple(w[p : p + 13]), []).append((i, p))
    one = lambda k, d: (lambda s: s.pop() if len(s) == 1 else None)({tuple(texts[i][p + d : p + d + 13]) if 0 <= p + d <= len(texts[i]) - 13 else None for i, p in at[k]})
    repeated = {k for k, places in at.items() if len({i for i, _ in places}) > 1}
    number = {k: n for n, k in enumerate(at)}
    rows = [(number[k], min(at[k])[0], 0, min(at[k])[1], number.get(one(k, -1)), number.get(one(k, 1)), len(at[k])) for k in repeated]
    edges = spark.createDataFrame(rows, "h long, src long, srid long, srcpos int, prev long, next long, n long").repartition(3)
    got = sorted((r.h, r.src, r.srcpos, r.edges, r.n) for r in substring_dedup.compact_paths(edges, Scratch(spark, "t")).collect())
    follows = {k: one(k, 1) for k in repeated if one(k, 1) in repeated and one(one(k, 1), -1) == k}
    want = []
    for k in repeated - set(follows.values()):
        n, end = 1, k
        while end in follows:
            n, end = n + 1, follows[end]
        want.append((number[k], *min(at[k]), n, len(at[k])))
    assert got == sorted(want) and max(w[3] for w in want) > 64


def test_empty_table(docs_of):
    assert dedup_substrings(docs_of([])).count() == 0


def test_stage_keeps_untouched_texts(docs_of):
    text = "some  words\nhere " * 10
    rows = [(1, text), (2, text), (3, "own\n\ntext"), (4, "new start " + text)]
    got = {r.doc_id: r.text for r in substring_dedup.stage(None, docs_of(rows), "").collect()}
    assert got == {1: text, 3: "own\n\ntext", 4: "new start"}


def test_stage_keeps_columns_of_any_name(docs_of):
    text = " ".join(f"w{i}" for i in range(20))
    docs = docs_of([(1, text), (2, "new " + text)]).withColumns({c: F.lit(f"own {c}") for c in ("n_words", "n_removed", "kept_text", "row", "rid", "spans", "copied", "src")})
    out = substring_dedup.stage(None, docs, "")
    assert out.columns == docs.columns
    assert {(r.doc_id, r.text, r.n_words, r.row, r.kept_text) for r in out.collect()} == {(1, text, "own n_words", "own row", "own kept_text"), (2, "new", "own n_words", "own row", "own kept_text")}


def test_word_hashes_differ():
    words = [b"a" * n for n in range(1, 200)] + [bytes([65 + i % 26]) * 8 + b"x" * j for i in range(26) for j in range(3)] + [f"w{i}".encode() for i in range(20_000)]
    data = b" ".join(words)
    ((_, _, found),) = list(chunks(pa.array([data.decode()])))
    assert len(found.hash) == len(words) and len(set(found.hash.tolist())) == len(set(words))


def test_window_hashes_follow_the_words():
    texts = pa.array(["a b  c d", None, "b c d", "", "x a\tb c"])
    ((_, _, words),) = list(chunks(texts))
    h = words.windows(3)
    place = {r: words.first[r] for r in range(5)}
    assert h[place[0] + 1] == h[place[2]] and h[place[0]] == h[place[4] + 1] and h[place[0]] != h[place[2]]
    assert list(words.count) == [4, 0, 3, 0, 4]
