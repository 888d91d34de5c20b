import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import _golay, simhash
from tidemark.llm._scratch import Scratch
from tidemark.llm.components import connected_components
from tidemark.llm.simhash import anchor_keys, fingerprint, link_fingerprints, near_duplicates


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def near_fps(rng, n):
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            out.append(x)
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
    return sorted({x - (1 << 64) if x >> 63 else x for x in out})


def test_golay_covers():
    points = np.random.default_rng(0).integers(0, 1 << 23, 5000)
    words, has = _golay.anchors(points)
    distance = np.where(has, np.bitwise_count(words ^ points[:, None]), 99)
    assert (distance[:, 0] <= 3).all() and (np.where(has, distance, 0) <= 4).all()


def test_every_close_pair_shares_an_anchor():
    """All ways to spread 0 to 4 differing bits over the three blocks, 60 random pairs each."""
    rng = random.Random(1)
    pairs = []
    for split in [(i, j, k) for i in range(5) for j in range(5) for k in range(5) if i + j + k <= 4]:
        for _ in range(60):
            x = y = rng.getrandbits(64)
            for n, (shift, bits) in zip(split, simhash.BLOCKS):
                for b in rng.sample(range(shift, shift + bits), n):
                    y ^= 1 << b
            pairs.append((x, y))
    keys, index = anchor_keys(np.array(pairs, dtype=np.uint64).ravel())
    met = [set() for _ in range(2 * len(pairs))]
    for key, i in zip(keys.tolist(), index.tolist()):
        met[i].add(key)
    assert len(pairs) == 35 * 60 and all(met[2 * i] & met[2 * i + 1] for i in range(len(pairs)))


def test_stage_keeps_columns_of_any_name(spark, docs_of):
    docs = docs_of([(2, "a b c d e"), (1, "a b c d e"), (3, None), (4, ""), (None, "x y z w v")]).withColumns({c: F.lit(f"own {c}") for c in ("fp", "id", "none", "row", "_id", "_none", "component_id", "fingerprint")})
    out = simhash.stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.fp, r._id) for r in out.collect()), key=str) == [(1, "a b c d e", "own fp", "own _id"), (3, None, "own fp", "own _id"), (None, "x y z w v", "own fp", "own _id")]


def test_one_giant_component(spark):
    """A chain of fingerprints, each a bit from the next: one root for all nodes."""
    fps, x = [], 0
    for i in range(400):
        x ^= 1 << (i * 7 % 63)
        fps.append(x)
    edges = spark.createDataFrame([(min(a, b), max(a, b)) for a, b in zip(fps, fps[1:]) if a != b], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges, Scratch(spark, "t")).collect()}
    assert got == {f: min(fps) for f in set(fps)}


def test_fingerprint_against_plain():
    for text in [None, "", "  \n", "One", "a b c", "A b c d e", "é " * 50 + "Zebra", "w%d " * 3, "x " * 3000 + "y"]:
        assert fingerprint(text) == plain_fingerprint(text)


def check_links(spark, cap):
    fps = near_fps(random.Random(3), 600)
    scratch = Scratch(spark, "t")
    edges = link_fingerprints(spark.createDataFrame([(f,) for f in fps], "fp long").repartition(5), scratch, cap)
    got = {f: f for f in fps} | {r.node: r.root for r in connected_components(edges, scratch).collect()}
    assert got == plain_components(fps)


def test_links_against_all_pairs(spark):
    check_links(spark, 50_000)


def test_large_anchors_use_the_grid(spark):
    check_links(spark, 1)


def test_dense_run():
    base = np.uint64(0x0123456789ABCDEF)
    fps = np.unique(np.array([base ^ np.uint64((1 << i) | (1 << j)) for i in range(64) for j in range(64)], dtype=np.uint64))
    a, b = simhash._link_run(fps)
    assert len(a) == len(fps) - 1 and set(b) == {fps[0]}


def test_documents(docs_of):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(300)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base * 3)] + [(100 + i, t + " one more") for i, t in enumerate(base)]
    rows += [(200, None), (201, ""), (202, " "), (None, base[0]), (None, None), (3, base[3])]
    fps = {t: plain_fingerprint(t) for _, t in rows}
    roots = plain_components(sorted({f - (1 << 64) if f >> 63 else f for f in fps.values()}))
    signed = lambda t: fps[t] - (1 << 64) if fps[t] >> 63 else fps[t]
    first = {}
    for i, t in rows:
        if i is not None:
            first[roots[signed(t)]] = min(i, first.get(roots[signed(t)], i))
    expected = sorted(((i, f"{fps[t]:016x}", first.get(roots[signed(t)])) for i, t in rows), key=str)
    got = near_duplicates(docs_of(rows).withColumns({"fp": F.lit(1), "anchor": F.lit(2)}))
    assert sorted(map(tuple, got.collect()), key=str) == expected
    assert near_duplicates(docs_of([])).count() == 0
