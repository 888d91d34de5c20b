import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from tidemark.llm import vector_codes as vc

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, rounds=4):
    """Row by row in Python integers: (vec_id, label, code, error, label_error, sha) of each kept row."""
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // 4
    parts = [[r[1][p * w : (p + 1) * w] for r in kept] for p in range(4)]
    books = [[list(x) for x in part[:256]] for part in parts]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda p: [min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e)) for x in parts[p]]
    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for x, e in zip(parts[p], nearest(p)):
                groups.setdefault(e, []).append(x)
            for e, xs in groups.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    codes = [nearest(p) for p in range(4)]
    errors = [sum(far(parts[p][i], books[p][codes[p][i]]) for p in range(4)) for i in range(len(kept))]
    by_label = {}
    for (_, _, g), e in zip(kept, errors):
        by_label[g] = by_label.get(g, 0) + e
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return [(i, g, "".join(f"{codes[p][k]:02x}" for p in range(4)), errors[k], by_label[g], sha) for k, (i, _, g) in enumerate(kept)]


def same(spark, rows, block=8):
    got = [tuple(r) for r in vc.encode_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_against_plain_integers(spark):
    rng = random.Random(7)
    centres = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(9)]
    rows = [(i * 3 % 701, [c + rng.gauss(0, 0.05) for c in centres[i % 9]], rng.choice([0, 1, 2, None])) for i in range(600)]
    rows += [(700, [0.5] * 8, 1)] * 150  # copies, and repeated ids
    rows += [(None, [0.1] * 8, None), (None, [0.2] * 8, 5), (800, None, 1), (801, [1.0] * 7 + [None], 1), (802, [1.0] * 7 + [float("nan")], 1), (803, [float("-inf")] + [1.0] * 7, None)]
    same(spark, rows)


def test_few_rows_and_none(spark):
    same(spark, [(5, [1.0, -1.0, 0.5, 2.0], None), (4, [1.0, -1.0, 0.5, 2.0], 7)])
    same(spark, [(1, None, 1), (2, [float("nan")] * 4, 1)])
    same(spark, [])
    same(spark, [(1, [], 1), (2, [], None)])


def test_widths_and_sizes_are_refused(spark):
    for rows in ([(1, [1.0] * 6, 1)], [(1, [1.0] * 8, 1), (2, [1.0] * 4, 1)]):
        with pytest.raises(ValueError):
            vc.encode_vectors(spark.createDataFrame(rows, SCHEMA))
    with pytest.raises(Exception, match="under 65536"):
        vc.encode_vectors(spark.createDataFrame([(1, [1e6] * 4, 1)], SCHEMA))


def test_shortlists_lose_no_entry():
    rng = np.random.default_rng(1)
    shorter = 0
    for _ in range(300):
        entries = rng.integers(-40, 40, (30, 3))
        values = rng.integers(-5, 5, (16, 3)) + rng.integers(-40, 40, 3)
        some = vc.shortlist(values.min(axis=0), values.max(axis=0), entries)
        shorter += len(some) < 30
        index, error = vc.assign(values, entries, some)
        every = ((values[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == every.argmin(axis=1)).all() and (error == every.min(axis=1)).all()
    assert shorter > 250


def test_the_curve_steps_to_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = vc.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        path = cells[np.argsort(np.array([int.from_bytes(k) for k in keys]))]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], 1)], SCHEMA).withColumns({c: F.lit("x") for c in ("row", "code", "error", "n", "part", "ints", "label_key")})
    assert [tuple(r) for r in vc.encode_vectors(frame).collect()] == plain([(1, [1.0, 2.0, 3.0, 4.0], 1)])


def test_query_against_sql(spark):
    embeddings = duckdb.sql(f"SELECT * FROM '{SF}/embeddings.parquet'")  # noqa: F841
    found = duckdb.sql(vc.ORACLE_SQL)
    got = vc.op11_vector_codes(spark, SF)
    assert got.columns == [c[0] for c in found.description]
    assert sorted(map(tuple, got.collect())) == sorted(found.fetchall())
