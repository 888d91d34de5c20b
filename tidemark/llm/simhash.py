"""SimHash near-duplicates: anchors of a covering code bring similar fingerprints together.

The 64 bits fall into three blocks (22, 21 and 21 bits). Two fingerprints at distance 4 or less differ in at most two
bits within some two of the blocks together. In each block the words of the perfect Golay code of length 23 (blocks
padded with zeros) are the anchors; every point is within distance 3 of one. A pair at distance two on two blocks has
a point half way, at distance one from both, and the anchors of that point are within the covering radius plus that
half of the threshold of either. So each fingerprint is copied to all anchor pairs that are within the radius in both
blocks but for one more bit in one of them: about 29 copies over the three pairs of blocks. Fingerprints are compared
within an anchor pair only, each link gives an edge towards one member, and components are found by Spark joins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import _golay
from ._scratch import Scratch, shuffle_partitions
from ._skew import join_counted
from .components import connected_components

SHINGLE = 4
THRESHOLD = 4
SEED = 42
#: (shift, bits) of the blocks.
BLOCKS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of one anchor that one task compares; a larger anchor is dealt to a grid of tasks.
ANCHOR_CAP = 50_000
#: Runs up to this length are compared pair by pair, longer ones by breadth-first search.
SHORT_RUN = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles; zero for a text without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprints(batches):
    for batch in batches:
        texts = batch.column(1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.array([fingerprint(t.as_py()) for t in texts], dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"]
        )


def anchor_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor key, index into fps) of every copy."""
    near = [_golay.anchors((fps >> np.uint64(shift)).astype(np.int64) & ((1 << bits) - 1)) for shift, bits in BLOCKS]
    keys, index = [], []
    for table, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        (words_i, has_i), (words_j, has_j) = near[i], near[j]
        for a in range(words_i.shape[1]):
            for b in range(words_j.shape[1]) if a == 0 else (0,):
                at = np.flatnonzero(has_i[:, a] & has_j[:, b])
                keys.append(table << 46 | words_i[at, a] << 23 | words_j[at, b])
                index.append(at)
    return np.concatenate(keys), np.concatenate(index)


def _to_anchors(batches):
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        keys, index = anchor_keys(fps.view(np.uint64))
        for at in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 100_000]), pa.array(fps[index[at : at + 100_000]])], names=["anchor", "fp"])


def _link_run(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, root) that connect the fingerprints of a run as all links among them do."""
    a, b = [], []
    left = fps
    while len(left):
        root, left, front = left[0], left[1:], [left[0]]
        while front and len(left):
            close = np.bitwise_count(left ^ front.pop()) <= THRESHOLD
            if close.any():
                hits, left = left[close], left[~close]
                a.append(hits)
                b.append(np.full(len(hits), root))
                front.extend(hits)
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def _compare(batches, cap: int | None):
    """Edges among the sorted rows of each anchor; the rows of anchors above ``cap`` come back for a grid."""

    def edges_of(keys, fps):
        a, b = [], []
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        lengths = np.diff(np.r_[starts, len(keys)])
        length = np.repeat(lengths, lengths)
        for shift in range(1, SHORT_RUN):
            same = (keys[shift:] == keys[:-shift]) & (length[shift:] <= SHORT_RUN)
            at = np.flatnonzero(same)
            at = at[np.bitwise_count(fps[at] ^ fps[at + shift]) <= THRESHOLD]
            a.append(fps[at + shift])
            b.append(fps[at])
        for start, n in zip(starts[lengths > SHORT_RUN], lengths[lengths > SHORT_RUN]):
            x, y = _link_run(fps[start : start + n])
            a.append(x)
            b.append(y)
        return pack(np.concatenate(a), np.concatenate(b), -1)

    def pack(a, b, anchor):
        low, high = np.minimum(a.view(np.int64), b.view(np.int64)), np.maximum(a.view(np.int64), b.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(np.full(len(a), anchor, dtype=np.int64))], names=["a", "b", "anchor"])

    held_keys, held = np.empty(0, np.int64), np.empty(0, np.uint64)
    over = None
    for batch in batches:
        keys = np.concatenate([held_keys, batch.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([held, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        if over is not None:  # an anchor that is being passed on
            n = int(np.searchsorted(keys, over, side="right"))
            if n:
                yield pack(fps[:n], fps[:n], over)
            keys, fps, last = keys[n:], fps[n:], max(0, last - n)
            over = over if not len(keys) else None
        if last:
            yield edges_of(keys[:last], fps[:last])
        held_keys, held = keys[last:], fps[last:]
        if cap is not None and len(held) > cap:
            over = int(held_keys[0])
            yield pack(held, held, over)
            held_keys, held = held_keys[:0], held[:0]
    if len(held):
        yield edges_of(held_keys, held)


def link_fingerprints(fps: DataFrame, scratch: Scratch, cap: int = ANCHOR_CAP) -> DataFrame:
    """Edges (a, b) whose components are those of all links among the distinct fingerprints of column ``fp``."""
    parts = shuffle_partitions(fps.sparkSession)
    dealt = fps.select("fp").mapInArrow(_to_anchors, "anchor long, fp long").repartition(parts, "anchor").sortWithinPartitions("anchor", "fp")
    found = scratch.save("links", dealt.mapInArrow(lambda it: _compare(it, cap), "a long, b long, anchor long"))
    edges = found.where("anchor < 0").select("a", "b")
    over = found.where("anchor >= 0").select("anchor", F.col("a").alias("fp"))
    if not over.isEmpty():
        # every two parts of a large anchor meet in one cell of its grid
        grid = over.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / F.lit(cap)).cast("long").alias("parts"))
        cells = (
            over.join(grid, "anchor")
            .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select(F.xxhash64("anchor", F.least("part", "other"), F.greatest("part", "other")).alias("anchor"), "fp")
        )
        dealt = cells.repartition(parts, "anchor").sortWithinPartitions("anchor", "fp")
        more = scratch.save("grid", dealt.mapInArrow(lambda it: _compare(it, None), "a long, b long, anchor long"))
        edges = edges.unionByName(more.select("a", "b"))
    return edges.distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    A null or empty text has the fingerprint zero and links like any other. Components join fingerprints at 4 or
    fewer differing bits; component_id is the smallest doc_id of the component. A row without doc_id takes part and
    gets the component's id, which is null only if no row there has one. Long texts count with all their shingles. Repeated rows give repeated results, other
    columns are ignored, and an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")
    rows = scratch.save("rows", rows)
    distinct = scratch.save("fps", rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    roots = connected_components(link_fingerprints(distinct, scratch), scratch).withColumnRenamed("node", "fp")
    linked = distinct.join(roots, "fp", "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    linked = scratch.save("linked", linked.where("linked or n > 1").drop("linked"))
    firsts = scratch.save("firsts", linked.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")))
    ids = join_counted(linked.withColumnRenamed("n", "copies"), firsts, ["root"], linked.count(), ["fp"])
    ids = scratch.save("ids", ids.select("fp", "component_id", F.col("copies").alias("n")))
    # a fingerprint of one unlinked row needs no lookup
    return join_counted(rows, ids, ["fp"], rows.count(), ["doc_id"], "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, the one with the smallest doc_id; a row without doc_id stays if its component has no id.

    Null and empty texts have one fingerprint, so one of them stays; long texts count whole. Columns of any name are kept; an empty table gives
    an empty result.
    """
    found = near_duplicates(docs)
    same = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none")]
    kept = found.where(F.col("component_id").eqNullSafe(F.col("doc_id"))).select(*same).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct("*").alias("row")).select(*same, "row")
    return rows.join(kept, ["id", "none"], "left_semi").select("row.*")
