"""Codes of vectors by one small codebook for each of four parts, fitted over Hilbert-sorted flat blocks.

Parts of vectors are sorted along a Hilbert curve and cut into flat blocks, which keep the least and greatest value of
each component (a box), their sums, and the values. In a round the nearest and farthest distance between a block's box
and each codebook entry gives the block's shortlist: an entry whose nearest distance is beyond the least of all farthest
ones is no vector's nearest. A block with one entry left is assigned by its sums alone; others go through a small
integer kernel over the shortlist. All arithmetic is on integers, so the codes are exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._scratch import Scratch, shuffle_partitions
from ._skew import join_counted

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors in a block, and bits of a component in its place on the curve.
BLOCK, BITS = 64, 4
#: Scaled components must be smaller, so that squared distances stay within 64 bits.
MOST = 1 << 26
PLACED = "part int, key binary, row long, values binary"
BLOCKS = "part int, n int, low binary, high binary, sums binary, rows binary, values binary"


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Place of each row of cell numbers (below 2**bits) on the Hilbert curve, as bytes that sort in its order."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    if not dims:
        return [b""] * cells.shape[0]
    level = 1 << (bits - 1)
    while level > 1:  # undo the turns of the sub-cubes, from the largest on
        low = level - 1
        for i in range(dims):
            upper = (x[i] & level) != 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where(x[-1] & level, level - 1, 0)
        level >>= 1
    x ^= turn
    planes = (x.T[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None]) & 1
    return [row.tobytes() for row in np.packbits(planes.reshape(len(cells), bits * dims).astype(np.uint8), axis=1)]


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Ascending indexes of the entries that may be nearest to some point of the box."""
    below, above = low - entries, entries - high
    outside = np.maximum(np.maximum(below, above), 0)
    nearest = (outside * outside).sum(axis=1)
    reach = np.maximum(np.abs(below), np.abs(above))
    return np.flatnonzero(nearest <= (reach * reach).sum(axis=1).min())


def assign(values: np.ndarray, entries: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, its squared distance) of each row among the entries ``some``; ties to the lower index."""
    few = entries[some]
    distances = (values * values).sum(axis=1)[:, None] - 2 * (values @ few.T) + (few * few).sum(axis=1)[None, :]
    best = distances.argmin(axis=1)
    return some[best], distances[np.arange(len(values)), best]


def _place(low: np.ndarray, high: np.ndarray, bits: int):
    """A function of batches (row, ints) that gives each part of a vector with its place on the curve."""
    step = np.maximum((high - low) // (1 << bits) + 1, 1)

    def run(batches):
        for batch in batches:
            rows = batch.column(0)
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, len(low))
            cells = (values - low) // step
            width = len(low) // PARTS
            for p in range(PARTS):
                at = slice(p * width, (p + 1) * width)
                raw = [row.tobytes() for row in np.ascontiguousarray(values[:, at], dtype="<i4")]
                columns = [pa.array(np.full(batch.num_rows, p, dtype=np.int32)), pa.array(hilbert_keys(cells[:, at], bits), pa.binary()), rows, pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "key", "row", "values"])

    return run


def _flatten(width: int, block: int):
    """A function of sorted batches (part, row, values) that gives flat blocks of one part each."""

    def made(part: int, rows: np.ndarray, values: np.ndarray) -> tuple:
        wide = values.astype(np.int64)
        return part, len(rows), *(x.astype("<i8").tobytes() for x in (wide.min(axis=0), wide.max(axis=0), wide.sum(axis=0), rows)), values.tobytes()

    def batch_of(blocks: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*blocks), kinds)], names=["part", "n", "low", "high", "sums", "rows", "values"])

    def run(batches):
        part, rows, values, out = -1, np.empty(0, dtype=np.int64), np.empty((0, width), dtype="<i4"), []
        for batch in batches:
            parts, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            raw = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype="<i4").reshape(batch.num_rows, width)
            for p in range(PARTS):
                at = parts == p
                if not at.any():
                    continue
                if p != part and len(rows):
                    out.append(made(part, rows, values))
                    rows, values = rows[:0], values[:0]
                part, rows, values = p, np.concatenate([rows, own[at]]), np.concatenate([values, raw[at]])
                whole = len(rows) // block * block
                out += [made(p, rows[i : i + block], values[i : i + block]) for i in range(0, whole, block)]
                rows, values = rows[whole:], values[whole:]
            if out:
                yield batch_of(out)
                out = []
        if len(rows):
            yield batch_of([made(part, rows, values)])

    return run


def _numbers(row: dict, width: int) -> tuple:
    low, high, sums, rows = (np.frombuffer(row[c], dtype="<i8") for c in ("low", "high", "sums", "rows"))
    return row["part"], low, high, sums, rows, np.frombuffer(row["values"], dtype="<i4").reshape(row["n"], width).astype(np.int64)


def _sum_up(width: int, shared):
    """A function of batches of blocks that gives (part, entry, n, sums) of the assigned parts of its task."""

    def run(batches):
        books = shared.value
        n = np.zeros((PARTS, ENTRIES), dtype=np.int64)
        sums = np.zeros((PARTS, ENTRIES, width), dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                p, low, high, whole, _, values = _numbers(row, width)
                some = shortlist(low, high, books[p])
                if len(some) == 1:
                    n[p, some[0]] += len(values)
                    sums[p, some[0]] += whole
                else:
                    index, _ = assign(values, books[p], some)
                    n[p] += np.bincount(index, minlength=ENTRIES)
                    np.add.at(sums[p], index, values)
        part, entry = np.nonzero(n)
        columns = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    return run


def _code(width: int, shared):
    """A function of batches of blocks that gives (row, code of the part in its place, error) of every part."""

    def run(batches):
        books = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                p, low, high, _, rows, values = _numbers(row, width)
                index, error = assign(values, books[p], shortlist(low, high, books[p]))
                columns = [pa.array(rows), pa.array(index.astype(np.int64) << (8 * (PARTS - 1 - p))), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "code", "error"])

    return run


def scaled(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, ints) of the rows whose vector is complete and finite; ``row`` is a number of the row."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    number = lambda x: F.when(F.abs(x) * scale < MOST, F.floor(x * scale)).otherwise(F.raise_error(F.lit(f"components must be under {MOST // scale} in size"))).cast("int")
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("embedding").isNotNull() & good)
    return kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.transform("embedding", number).alias("ints"))


class Codebooks:
    """Entries of each part, (parts, entries, width) integers; fewer than 256 where there are fewer vectors."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def fit_codes(embeddings: DataFrame, rounds: int = ROUNDS, block: int = BLOCK, bits: int = BITS, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame, Codebooks]:
    """(kept vectors by ``row``, their codes and errors by ``row``, codebooks).

    Vectors that are null, or hold a null or a component that is not finite, are left out; the width of the others must
    be one multiple of four, and components must be under 65,536 in size, else ValueError or an error of the job. A
    codebook starts as that part of the 256 smallest vec_ids; of rows with one vec_id those with the smaller vector come
    first, and rows without vec_id come last. An empty table has empty codebooks. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    scratch = scratch or Scratch(spark, "codes")
    base = scratch.save("vectors", scaled(embeddings))
    widths = base.agg(F.min(F.size("ints")).alias("least"), F.max(F.size("ints")).alias("most")).first()
    width = widths["least"] or 0
    if widths["most"] not in (None, width) or width % PARTS:
        raise ValueError(f"vectors need one width, a multiple of {PARTS}; found {widths['least']} to {widths['most']}")
    width //= PARTS
    first = base.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(ENTRIES).collect()  # the codebooks' start
    books = np.array([r["ints"] for r in first], dtype=np.int64).reshape(len(first), PARTS, width).transpose(1, 0, 2).copy()
    if not len(first) or not width:
        codes = base.select("row", F.lit(0).cast("long").alias("code"), F.lit(0).cast("long").alias("error"))
        return base, codes, Codebooks(books)
    bounds = base.select(F.posexplode("ints")).groupBy("pos").agg(F.min("col").alias("low"), F.max("col").alias("high")).orderBy("pos").collect()  # one row for each component
    low, high = (np.array([r[c] for r in bounds], dtype=np.int64) for c in ("low", "high"))
    placed = base.select("row", "ints").mapInArrow(_place(low, high, bits), PLACED)
    # the row number parts equal vectors, of which there may be many
    dealt = placed.repartitionByRange(shuffle_partitions(spark), "part", "key", "row").sortWithinPartitions("part", "key", "row")
    blocks = scratch.save("blocks", dealt.select("part", "row", "values").mapInArrow(_flatten(width, block), BLOCKS))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)  # 1,024 entries at most
        found = blocks.mapInArrow(_sum_up(width, shared), "part int, entry int, n long, sums array<long>").groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)))
        for r in found.collect():  # a row for each entry
            books[r["part"], r["entry"]] = np.array([r[f"s{i}"] for i in range(width)], dtype=np.int64) // r["n"]
        shared.unpersist()
        books = books.copy()
    shared = spark.sparkContext.broadcast(books)
    coded = blocks.mapInArrow(_code(width, shared), "row long, code long, error long")
    return base, coded.groupBy("row").agg(F.sum("code").alias("code"), F.sum("error").alias("error")), Codebooks(books)


def encode_vectors(embeddings: DataFrame, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of each kept vector; see ``fit_codes``.

    ``label_error`` sums the errors of equal labels, nulls together; a label may hold most rows, so the join by it is salted.
    """
    scratch = Scratch(embeddings.sparkSession, "codes")
    base, codes, books = fit_codes(embeddings, rounds, block, scratch=scratch)
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    rows = scratch.save("coded", base.select("row", "vec_id", "label", key.alias("label_key")).join(codes, "row"))
    sums = scratch.save("labels", rows.groupBy("label_key").agg(F.count(F.lit(1)).alias("n"), F.sum("error").alias("label_error")))
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = join_counted(rows, sums, ["label_key"], total, ["row"])
    text = F.lower(F.lpad(F.hex("code"), 2 * PARTS, "0"))
    return found.select("vec_id", "label", text.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("label")


def _oracle() -> str:
    nearest = """(SELECT r, p, first(e ORDER BY dist, e) AS e, min(dist) AS dist FROM
  (SELECT x.r, x.p, b.e, list_inner_product(x.w, x.w) - 2 * list_inner_product(x.w, b.w) + list_inner_product(b.w, b.w) AS dist FROM x JOIN {book} b ON b.p = x.p) z GROUP BY r, p)"""
    text = """WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
x AS MATERIALIZED (SELECT r, p, v[CAST(p * len(v) // 4 + 1 AS BIGINT):CAST((p + 1) * len(v) // 4 AS BIGINT)] AS w FROM kept, range(4) t(p)),
book0 AS MATERIALIZED (SELECT p, r AS e, w FROM x WHERE r < 256)"""
    for k in range(ROUNDS):
        text += f""",
near{k} AS MATERIALIZED {nearest.format(book=f"book{k}")},
mean{k} AS MATERIALIZED (SELECT p, e, list(m ORDER BY i) AS w FROM (SELECT n.p, n.e, u.i, floor(sum(x.w[u.i]) / count(*)) AS m FROM near{k} n JOIN x ON x.r = n.r AND x.p = n.p, LATERAL (SELECT unnest(range(1, len(x.w) + 1)) AS i) u GROUP BY n.p, n.e, u.i) y GROUP BY p, e),
book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.w, b.w) AS w FROM book{k} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e)"""
    return text + f""",
last AS MATERIALIZED {nearest.format(book=f"book{ROUNDS}")},
coded AS (SELECT r, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error FROM last GROUP BY r),
named AS (SELECT k.vec_id, k.label, c.code, c.error FROM kept k JOIN coded c ON c.r = k.r)
SELECT n.vec_id, n.code, n.error, CAST(l.label_error AS BIGINT) AS label_error, (SELECT sha256(string_agg(array_to_string(list_transform(w, lambda q: CAST(CAST(q AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, e)) FROM book{ROUNDS}) AS codebooks_sha256
FROM named n JOIN (SELECT label, sum(error) AS label_error FROM named GROUP BY label) l ON l.label IS NOT DISTINCT FROM n.label"""


#: Values are integers held in doubles, exact as long as sums stay under 2**53.
ORACLE_SQL = _oracle()
