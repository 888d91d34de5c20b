import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import exact_dedup
from tidemark.llm._scratch import Scratch
from tidemark.llm.exact_dedup import build_directory, build_index, dedup_exact, owners_of, stage

ROWS = [(5, "a b"), (2, "a \t b"), (9, "a  b"), (3, None), (4, ""), (7, "x" * 50_000), (8, "x" * 50_000 + " "), (1, "c"), (None, "c"), (None, "only"), (1, "c"), (6, " ")]


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    out = []
    for norm, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_against_brute_force(docs_of):
    assert sorted(map(tuple, dedup_exact(docs_of(ROWS)).collect()), key=str) == expected(ROWS)


def test_chains_under_colliding_keys(docs_of):
    rows = [(i, f"t{i % 40}") for i in range(400)]
    got = dedup_exact(docs_of(rows), key=F.pmod(F.xxhash64("norm"), F.lit(3)), capacity=5)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_oversized_groups_and_salted_chains_meet(docs_of, monkeypatch):
    # _own runs in Python workers that import the module anew, so its bound is given to the function that they get
    chains = exact_dedup._chains
    rows = [(i if i % 7 else None, f"t{i % 4}" if i % 3 else f"own {i}") for i in range(900)]
    docs = docs_of(rows, 6)
    found = list(chains(iter([(0, 0, 5, 0, "s", 9, 2, [9, None], b"x"), (0, 0, 5, 0, "u", 3, 1, [3], b"y"), (0, 0, 5, 0, "s", 1, 1, [1], b"x"), (0, 0, 6, 0, "s", 1, 1, [4], b"x")]), True))
    assert [(f[2], f[4], f[5], f[9], f[10], f[11]) for f in found] == [(5, 0, b"x", [9, None, 1], 1, 3), (5, 1, b"y", [3], 3, 1), (6, 0, b"x", [4], 1, 1)]
    monkeypatch.setattr(exact_dedup, "HELD_IDS", 2)
    found = list(chains(iter([(0, 0, 5, 0, "s", i, 1, [i], b"x") for i in range(5)]), True))
    assert [(f[5], f[9], f[11]) for f in found] == [(None, [0, 1, 2], None), (b"x", [3, 4], None)]
    for share in (0.0, 0.5):  # all keys salted, none salted
        monkeypatch.setattr(exact_dedup, "HOT_SHARE", share)
        got = dedup_exact(docs, key=F.pmod(F.xxhash64("norm"), F.lit(3)), capacity=5)
        assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_lookup_reads_the_bucket(spark, docs_of):
    index = build_index(docs_of([(i, f"text {i % 50}") for i in range(300)] + [(900, "text  7")]), Scratch(spark, "test"))
    assert sorted(r.doc_id for r in index.lookup("text\t7").collect()) == [*range(7, 300, 50), 900]
    assert index.lookup("no such text").count() == 0
    assert len(set(index.owners.tolist())) > 1 and list(index.owners) == sorted(index.owners)


def test_stage_keeps_columns_of_any_name(spark, docs_of):
    docs = docs_of([*ROWS, (None, None)]).withColumns({c: F.lit(f"own {c}") for c in ("sha", "id", "none", "row", "_sha", "_row", "key")})
    out = stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.sha, r._row) for r in out.where("doc_id is not null").collect()) == sorted([(2, "a \t b", "own sha", "own _row"), (3, None, "own sha", "own _row"), (6, " ", "own sha", "own _row"), (7, "x" * 50_000, "own sha", "own _row"), (8, "x" * 50_000 + " ", "own sha", "own _row"), (1, "c", "own sha", "own _row")])
    assert [r.text for r in out.where("doc_id is null").collect()] == ["only"]


def test_hot_group(docs_of):
    rows = [(i, "same" if i % 3 else f"own {i}") for i in range(3000)]
    assert sorted(map(tuple, dedup_exact(docs_of(rows, 40)).collect()), key=str) == expected(rows)


def test_empty_table_and_clashing_columns(docs_of):
    assert dedup_exact(docs_of([])).count() == 0
    more = docs_of(ROWS).withColumns({"key": F.lit("k"), "bucket": F.lit(1), "norm": F.lit(""), "sha": F.lit("")})
    assert sorted(map(tuple, dedup_exact(more).collect()), key=str) == expected(ROWS)


def test_directory_doubles_only_where_overfull():
    buckets = build_directory({0: 10, 1: 10, 1 << 15: 3}, 10)
    assert buckets[0] == 0 and buckets[1] == 1 and buckets[(1 << 15) + 5] == 1 << 15
    assert len(set(build_directory({}, 1))) == 1
    assert set(owners_of(buckets, {0: 10, 1: 10, 1 << 15: 3}, 2)) == {0, 1}
