"""Exact deduplication through an extendible-hash index kept on shared files.

Rows are addressed by a 64-bit hash of the normalised text. The index directory maps the top bits of that hash to
buckets: it starts with one bucket and doubles, splitting every overfull bucket by its next bit, until each bucket
is within its capacity or the directory is at its full depth of 16 bits (a bucket that is still overfull there is
kept whole, with its rows in sorted order, as an overflow chain). Buckets in key order are dealt to owners, each with
a range of keys. An owner task walks the rows of each key, compares the bytes of every text with those in the key's
chain and puts a text that differs at its end; the chains say which rows are equal, which row stays and how many there
are. Owners write the index: a folder for each owner, whose rows hold their bucket, key, place in the chain and ids,
and the text at the head of each chain.

A key with much of the table is dealt over several tasks, and a key with more ids than a task should hold is not
resolved at once: the heads of their chains then meet once more, are compared by bytes, and give the rest its groups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._scratch import Scratch, shuffle_partitions

SPACES = "[\\x20\\x09-\\x0D]+"
DIRECTORY_BITS = 16
#: Rows of one key above this share of all rows make the key hot; fewer than 1/HOT_SHARE keys can be hot.
HOT_SHARE = 0.001
HOT_SALTS = 64
#: Ids of one key that an owner holds before it writes them without their group.
HELD_IDS = 65_536
INDEX = "owner int, bucket int, key long, salt int, place int, text string, sha string, min_id long, rows long, ids array<long>, keep_id long, group_size long"
NAMES = [f.split()[0] for f in INDEX.split(", ")]


def normalised(text: Column) -> Column:
    """Text with each run of ASCII white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def build_directory(histogram: dict[int, int], capacity: int, bits: int = DIRECTORY_BITS) -> np.ndarray:
    """Bucket number of each of the 2**bits hash prefixes.

    ``histogram`` has the rows under each prefix (at most 2**bits entries). Every round doubles the directory and
    splits the buckets that hold more than ``capacity`` rows; the others keep their depth.
    """
    counts = np.zeros(1 << bits, dtype=np.int64)
    for prefix, n in histogram.items():
        counts[prefix] = n
    buckets = np.zeros(1 << bits, dtype=np.int64)
    splitting = [0]
    for depth in range(bits):
        width = 1 << (bits - depth)
        over = [start for start in splitting if counts[start : start + width].sum() > capacity]
        if not over:
            break
        splitting = []
        for start in over:
            middle = start + width // 2
            buckets[middle : start + width] = middle
            splitting += [start, middle]
    return buckets


def _fold(batches):
    """One row for each distinct text of an Arrow batch, with the ids of the rows that have it."""
    for batch in batches:
        columns = batch.to_pydict()
        found: dict[tuple[int, str], list] = {}
        for doc_id, key, text, digest in zip(columns["doc_id"], columns["key"], columns["norm"], columns["sha"]):
            entry = found.setdefault((key, text), [digest, []])
            entry[1].append(doc_id)
        if found:
            ids = [e[1] for e in found.values()]
            known = [[i for i in x if i is not None] for x in ids]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array([k for k, _ in found], pa.int64()),
                    "norm": pa.array([t for _, t in found], pa.string()),
                    "sha": pa.array([e[0] for e in found.values()], pa.string()),
                    "min_id": pa.array([min(x, default=None) for x in known], pa.int64()),
                    "rows": pa.array([len(x) for x in ids], pa.int64()),
                    "ids": pa.array(ids, pa.list_(pa.int64())),
                }
            )


def owners_of(directory: np.ndarray, histogram: dict[int, int], n: int) -> np.ndarray:
    """Owner of each hash prefix: consecutive buckets, so that each of ``n`` owners has about as many rows."""
    counts = np.zeros(len(directory), dtype=np.int64)
    for prefix, rows in histogram.items():
        counts[prefix] = rows
    whole = np.bincount(directory, weights=counts, minlength=len(directory))
    before = np.cumsum(whole) - whole
    return (before[directory] * n // max(1, counts.sum())).astype(np.int64)


def _chains(rows, resolve: bool):
    """Tuples of INDEX from tuples (owner, bucket, key, salt, sha, min_id, rows, ids, text) with equal keys together.

    The chain of the current key is held, and of its ids ``HELD_IDS`` and those of one row more. Groups of salted keys
    and of keys beyond that come out without keep_id and group_size.
    """

    def least(a, b):
        return b if a is None else a if b is None else min(a, b)

    def close():
        whole = resolve and not spilled and current is not None and current[3] == 0
        groups = {place: (head[4], head[5]) for place, head in enumerate(chain.values())}
        for place, (text, head) in enumerate(zip(chain, chain.values())):
            ids, keep, size = head[6], *(groups[place] if whole else (None, None))
            yield (*current, place, text, head[3], head[4], head[5], ids, keep, size)

    current, chain, held, spilled = None, {}, 0, False
    for owner, bucket, key, salt, sha, min_id, n, ids, text in rows:
        if current is None or key != current[2] or salt != current[3]:
            yield from close()
            current, chain, held, spilled = (owner, bucket, key, salt), {}, 0, False
        head = chain.get(text)  # compares the bytes with those of the chain
        if head is None:
            head = chain[text] = [owner, bucket, key, sha, None, 0, [], len(chain)]
        head[4], head[5] = least(head[4], min_id), head[5] + n
        head[6] += ids
        held += len(ids)
        if held > HELD_IDS:
            for other in chain.values():
                if other[6]:
                    yield (*current, other[7], None, other[3], None, 0, other[6], None, None)
                    other[6] = []
            held, spilled = 0, True
    yield from close()


def _own(batches):
    """The index rows of an owner's key ranges; its rows come sorted by owner, bucket, key and salt."""

    def rows():
        for batch in batches:
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in ("owner", "bucket", "key", "salt", "sha", "min_id", "rows", "ids", "norm")}
            texts = columns.pop("norm")
            for *row, i in zip(*(c.to_pylist() for c in columns.values()), range(batch.num_rows)):
                yield *row, texts[i].as_buffer().to_pybytes()

    held, size = [], 0
    for row in _chains(rows(), True):
        held.append(row)
        size += len(row[5] or b"") + 8 * len(row[9])
        if size > 1 << 20 or len(held) == 10_000:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    columns[5] = columns[5].cast(pa.string())
    return pa.RecordBatch.from_arrays(columns, names=NAMES)


def _meet(batches):
    """Groups of the heads of unresolved chains: (key, salt, place, keep_id, group_size); heads come sorted by key and text."""
    waiting: list[tuple] = []
    last = None
    found: list[tuple] = []

    def close():
        keep = min((w[3] for w in waiting if w[3] is not None), default=None)
        size = sum(w[4] for w in waiting)
        found.extend((*w[:3], keep, size) for w in waiting)

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("key", "salt", "place", "min_id", "rows")]
        texts = batch.column(batch.schema.get_field_index("text"))
        for *row, i in zip(*(c.to_pylist() for c in columns), range(batch.num_rows)):
            this = (row[0], texts[i].as_buffer().to_pybytes())
            if this != last:  # the bytes differ from those before
                close()
                waiting, last = [], this
            waiting.append(tuple(row))
        if len(found) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _MET)], names=["key", "salt", "place", "keep_id", "group_size"])
            found.clear()
    close()
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _MET)], names=["key", "salt", "place", "keep_id", "group_size"])


_MET = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]


@dataclass
class ExactIndex:
    """A directory (bucket and owner of each hash prefix) and the index rows in a folder for each owner."""

    directory: np.ndarray
    owners: np.ndarray
    rows: DataFrame

    def lookup(self, text: str | None) -> DataFrame:
        """doc_id of the rows with an equal text: reads the bucket that the directory names, in its owner's folder only."""
        spark = self.rows.sparkSession
        wanted = spark.range(1).select(normalised(F.lit(text)).alias("norm")).select("norm", F.xxhash64("norm").alias("key")).first()
        prefix = (wanted.key >> (64 - DIRECTORY_BITS)) & ((1 << DIRECTORY_BITS) - 1)
        bucket = self.rows.where((F.col("owner") == int(self.owners[prefix])) & (F.col("bucket") == int(self.directory[prefix])) & (F.col("key") == wanted.key))
        heads = bucket.where(F.col("text") == wanted.norm).select("key", "salt", "place")
        return bucket.join(heads, ["key", "salt", "place"], "left_semi").select(F.explode("ids").alias("doc_id"))


def build_index(docs: DataFrame, scratch: Scratch, key: Column | None = None, capacity: int | None = None) -> ExactIndex:
    """Write the index of all rows of ``docs`` (doc_id, text). ``key`` and ``capacity`` as in ``dedup_exact``."""
    spark = docs.sparkSession
    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(docs["text"]).alias("norm"))
    keyed = norm.select("doc_id", (F.xxhash64("norm") if key is None else key).alias("key"), "norm")
    prefix = F.shiftrightunsigned("key", 64 - DIRECTORY_BITS).cast("int")
    keys = scratch.save("keys", keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["p"]: r["n"] for r in keys.groupBy(prefix.alias("p")).agg(F.sum("n").alias("n")).collect()}  # at most 2**DIRECTORY_BITS rows
    total = sum(histogram.values())
    parts = shuffle_partitions(spark)
    # no fewer than 16 buckets and 4 owners for a partition, so that whole key ranges spread evenly
    directory = build_directory(histogram, capacity or max(1, total // (16 * parts)))
    owners = owners_of(directory, histogram, 4 * parts)
    lookup = spark.createDataFrame([(int(p), int(directory[p]), int(owners[p])) for p in histogram], "prefix int, bucket int, owner int")
    hot = keys.where(F.col("n") > max(1, int(total * HOT_SHARE))).select("key", F.lit(True).alias("hot"))
    entries = keyed.select("doc_id", "key", "norm", F.sha2("norm", 256).alias("sha")).mapInArrow(_fold, "key long, norm string, sha string, min_id long, rows long, ids array<long>")
    salt = F.when(F.col("hot"), 1 + F.pmod(F.xxhash64("min_id", "rows", "sha"), F.lit(HOT_SALTS))).otherwise(F.lit(0)).cast("int")
    placed = (
        entries.withColumn("prefix", prefix)
        .join(F.broadcast(lookup), "prefix")  # at most 2**DIRECTORY_BITS rows
        .join(F.broadcast(hot), "key", "left")  # fewer than 1/HOT_SHARE rows
        .withColumn("salt", salt)
    )
    owned = placed.repartition(parts, "owner", "salt").sortWithinPartitions("owner", "bucket", "key", "salt")
    rows = owned.select("owner", "bucket", "key", "salt", "sha", "min_id", "rows", "ids", "norm").mapInArrow(_own, INDEX)
    return ExactIndex(directory, owners, scratch.save("index", rows, ("owner",)))


def groups_of(index: ExactIndex, scratch: Scratch) -> DataFrame:
    """(doc_id, keep_id, group_size, sha) of all rows of an index."""
    rows = index.rows
    open_ = rows.where("group_size is null")
    heads = open_.where("text is not null").select("key", "salt", "place", "text", "min_id", "rows")
    # one row for each task and text of a key that is hot or oversized
    met = heads.repartition(shuffle_partitions(rows.sparkSession), "key").sortWithinPartitions("key", "text").mapInArrow(_meet, "key long, salt int, place int, keep_id long, group_size long")
    met = scratch.save("met", met)
    rest = open_.where(F.size("ids") > 0).select("key", "salt", "place", "ids", "sha").join(met, ["key", "salt", "place"])
    columns = ["ids", "keep_id", "group_size", "sha"]
    return rows.where("group_size is not null").select(columns).unionByName(rest.select(columns)).select(F.explode("ids").alias("doc_id"), "keep_id", "group_size", "sha")


def dedup_exact(docs: DataFrame, key: Column | None = None, capacity: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space is replaced by one space; a null text counts
    as empty. Of equal texts the smallest doc_id stays. A row without doc_id belongs to its group and its size but is
    kept only if no row of the group has an id, and then keep_id is null; repeated rows with the kept doc_id are kept
    all alike. Long texts are compared whole, as they stand in one row. Other columns are ignored; an empty table gives
    an empty result. ``key`` replaces the 64-bit hash of
    the column ``norm`` (tests use a weak one to force chains); ``capacity`` is the rows a bucket may hold.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    found = groups_of(build_index(docs, scratch, key, capacity), scratch)
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of each group that stays, with all its columns; of repeated rows (same doc_id and text) one.

    Null texts count as empty, long ones are compared whole. Columns of any name are kept; an empty table gives an empty
    result.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    found = groups_of(build_index(docs, scratch), scratch).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    same = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none")]
    kept = scratch.save("kept", found.select(*same, "sha").distinct())
    scratch.drop("index", "met", "keys")  # the texts in the index are not needed any more
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(normalised(docs["text"]), 256).alias("sha"), F.struct("*").alias("row")).select(*same, "sha", "row")
    return rows.join(kept, ["id", "none", "sha"], "left_semi").dropDuplicates(["id", "none", "sha"]).select("row.*")


ORACLE_SQL = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, CAST(count(*) AS BIGINT) AS group_size FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g USING (norm)
"""
