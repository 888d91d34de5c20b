"""Packing of documents into sequences by length patterns.

The histogram of piece lengths has at most ``CAPACITY`` counters, whatever the size of the corpus. The driver
enumerates patterns of two to four lengths that fill a sequence, fits their repeat counts to the histogram by
non-negative least squares (coordinate descent), rounds them down to what the histogram can give, and packs what is
left best fit first, many equal sequences at a time. The plan says which ranks of each length go to which sequences;
Spark ranks the pieces of each length (in salted parts, so that a frequent length is not one group) and each task
looks its pieces up in the plan. The pieces carry their token ids, so the packed table holds the sequences themselves.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ._scratch import Scratch, shuffle_partitions
from .tokens import encoder, largest_id, share_tokenizer, text_groups

CAPACITY = 2048
END_ID = 0
#: Patterns enumerated for each longest length, and sweeps of the fit.
PATTERNS_PER_LENGTH, SWEEPS = 24, 12


def length_patterns(lengths: list[int], capacity: int) -> list[tuple[int, ...]]:
    """Patterns of one to four lengths, longest first, that fill a sequence exactly."""
    have = set(lengths)
    found = {(capacity,)} if capacity in have else set()
    for a in lengths:
        rest = capacity - a
        if rest in have and rest <= a:
            found.add((a, rest))
        seconds = lengths[bisect.bisect_left(lengths, -(-rest // 3)) : bisect.bisect_right(lengths, min(a, rest - 1))]
        step = max(1, len(seconds) // PATTERNS_PER_LENGTH)
        for b in seconds[::step]:
            c = rest - b
            if c in have and c <= b:
                found.add((a, b, c))
            third = lengths[bisect.bisect_left(lengths, -(-c // 2)) : bisect.bisect_right(lengths, min(b, c - 1))]
            for c1 in third[:: max(1, len(third) // 3)]:
                if c - c1 in have and c - c1 <= c1:
                    found.add((a, b, c1, c - c1))
    return sorted(found, reverse=True)


def fit_counts(patterns: list[tuple[int, ...]], counts: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 with least squared difference between the lengths used and ``counts``."""
    x = np.zeros(len(patterns))
    rest = counts.astype(float).tolist()
    uses = []
    for pattern in patterns:
        times: dict[int, int] = {}
        for length in pattern:
            times[length] = times.get(length, 0) + 1
        uses.append((tuple(times.items()), sum(n * n for n in times.values())))
    for _ in range(SWEEPS):
        for j, (items, norm) in enumerate(uses):
            gradient = 0.0
            for length, n in items:
                gradient += n * rest[length]
            new = x[j] + gradient / norm
            if new < 0:
                new = 0.0
            moved = new - x[j]
            if moved:
                x[j] = new
                for length, n in items:
                    rest[length] -= n * moved
    return x


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, how many such sequences) for all pieces of the histogram."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan: list[tuple[tuple[int, ...], int]] = []
    patterns = length_patterns([int(x) for x in np.flatnonzero(left)], capacity)
    x = fit_counts(patterns, left)
    for j in np.argsort(-x, kind="stable"):
        repeats = int(x[j])
        for length in set(patterns[j]):
            repeats = min(repeats, int(left[length]) // patterns[j].count(length))
        if repeats > 0:
            for length in patterns[j]:
                left[length] -= repeats
            plan.append((patterns[j], repeats))
    # best fit, longest first; sequences with the same content are one entry
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    spaces: list[int] = []

    def put(content: tuple[int, ...], n: int) -> None:
        space = capacity - sum(content)
        if space not in open_:
            open_[space] = []
            bisect.insort(spaces, space)
        open_[space].append((content, n))

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                each = capacity // length
                full, more = divmod(n, each)
                if full:
                    put((length,) * each, full)
                if more:
                    put((length,) * more, 1)
                break
            space = spaces[at]
            content, have = open_[space].pop()
            if not open_[space]:
                del open_[space], spaces[at]
            each = space // length
            used = min(have, n // each)
            if used:
                put(content + (length,) * each, used)
            n -= used * each
            if used < have:
                if n and n < each:
                    put(content + (length,) * n, 1)
                    n, used = 0, used + 1
                if used < have:
                    put(content, have - used)
    return plan + [entry for entries in open_.values() for entry in entries]


def _segments(plan: list[tuple[tuple[int, ...], int]]):
    """For each (length, from rank): first sequence and offset, as sorted arrays of key, sequence, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for content, repeats in plan:
        offset = 0
        for length in content:
            rows.append((length << 44 | used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + repeats
            offset += length
        sequence += repeats
    rows.sort()
    return tuple(np.array(column, dtype=np.int64) for column in zip(*rows)) if rows else (np.empty(0, np.int64),) * 3


def _widened(ids: pa.Array, width: int) -> pa.Array:
    """Ids of ``width`` bytes each as ids of four."""
    if width == 4:
        return ids
    _, offsets, data = ids.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int32)[ids.offset : ids.offset + len(ids) + 1]
    narrow = np.frombuffer(data, dtype="<u2")[cuts[0] // 2 : cuts[-1] // 2] if data is not None else np.empty(0, "<u2")
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(((cuts - cuts[0]) * 2).astype(np.int32)), pa.py_buffer(narrow.astype("<u4"))])


def _place(batches, shared, width):
    for batch in batches:
        keys, sequences, offsets = shared.value
        length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        wanted = length << 44 | rank
        at = np.searchsorted(keys, wanted, side="right") - 1
        columns = [_widened(c, width) if name == "ids" else c for name, c in zip(batch.schema.names, batch.columns) if name != "rank"]
        names = [c for c in batch.schema.names if c != "rank"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sequences[at] + wanted - keys[at]), pa.array(offsets[at])], names=[*names, "sequence_id", "offset"])


def pack(pieces: DataFrame, capacity: int = CAPACITY, carried: tuple[str, ...] = (), width: int = 4) -> DataFrame:
    """``pieces`` (with a column ``length`` from 1 to ``capacity``) with sequence_id and offset, then ``carried`` columns.

    A carried column ``ids`` has ids of ``width`` bytes and gets ids of four.

    The order of pieces of one length follows from the columns that are not ``carried``.
    ``pieces`` is read several times and must be stable: a written table. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    own = [c for c in pieces.columns if c not in carried]
    salts = 16 * shuffle_partitions(spark)
    keyed = pieces.withColumn("salt", F.pmod(F.xxhash64(*own), F.lit(salts)))
    counts = keyed.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    counts = Scratch(spark, "packing").save("counts", counts)
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    shared = spark.sparkContext.broadcast(_segments(plan_sequences(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy(*own)
    ranked = keyed.withColumn("nth", F.row_number().over(within)).join(first, ["length", "salt"])
    ranked = ranked.select(*pieces.columns, (F.col("before") + F.col("nth") - 1).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    placed = ranked.mapInArrow(lambda it: _place(it, shared, width), schema)
    return placed.select(*own, "sequence_id", "offset", *carried)


def _pieces(batches, tokenizer, capacity, width):
    end = np.array([END_ID], dtype="<u4").tobytes()
    for batch in batches:
        ids_of = encoder(tokenizer.value).encode
        for start, texts in text_groups(batch.column(1)):
            out: list[tuple] = []
            for i, ids in enumerate(ids_of(texts)):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                parts = (ids[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:]))
                out += [(start + i, k, a, len(part) // 4, zlib.crc32(part), part) for k, (a, part) in enumerate(zip(cuts, parts))]
            row, piece, begin, length, crc, part = zip(*out)
            if width == 2:
                part = [np.frombuffer(p, dtype="<u4").astype("<u2").tobytes() for p in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (begin, length, crc)), pa.array(part, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids (little-endian, 32 bits each).

    A document is its token ids and the end id 0; one longer than ``capacity`` is cut into pieces of that length, the
    first of which may be shorter. A null text is empty and has the end id alone. Rows without doc_id and repeated
    rows are packed like others; other columns are ignored; an empty table gives an empty result. ``tokenizer`` is the
    JSON text of a tokenizer file. Until they are placed, ids take two bytes if all of the vocabulary fit.
    """
    spark = docs.sparkSession
    shared = share_tokenizer(spark, tokenizer)
    width = 2 if largest_id(shared.value) < 1 << 16 else 4
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = rows.mapInArrow(lambda it: _pieces(it, shared, capacity, width), "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return pack(Scratch(spark, "pieces").save("pieces", pieces), capacity, ("ids",), width)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence of ``packed``: sequence_id, pieces (offset, doc_id, piece, start, length) in order, ids.

    A sequence has at most as many pieces as it has ids, so a group is bounded by the capacity. ``packed`` has no nulls;
    without rows there are no sequences.
    """
    place = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    groups = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(place)).alias("pieces"))
    ids = F.aggregate("pieces", F.lit(b""), lambda joined, p: F.concat(joined, p["ids"]))
    return groups.select("sequence_id", F.transform("pieces", lambda p: p.dropFields("ids")).alias("pieces"), ids.alias("ids"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows of ``docs`` with their places and ids, as ``pack_documents`` has them.

    Null and empty texts have the end id alone; columns of any name are ignored; an empty table gives an empty result.
    """
    return pack_documents(docs)
