"""Token files of directly addressable codes.

Token ids of documents, in ascending order of doc_id, are cut into segments. A segment splits each id into 8-bit
chunks: level 0 has the lowest chunk of every token; a continuation bitmap tells which tokens go on; level 1 has the
next chunk of those, and so forth. A rank directory (the ones before each block of 512 bits) finds a token's place on
the next level, so any token or stretch is read without decoding what stands before it. Segments are rows of Parquet
files in the shared folder, which Spark's writers and readers handle in any store.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._scratch import Scratch, shuffle_partitions
from .tokens import encoder, share_tokenizer, text_groups

END_ID = 2
CHUNK, BLOCK = 8, 512
SEGMENT_TOKENS = 1 << 18
FILE_SCHEMA = "part int, segment int, part_start long, doc_ids array<long>, lengths array<long>, n_tokens long, levels array<binary>, bitmaps array<binary>, ranks array<binary>"


def encode_levels(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """(levels, continuation bitmaps, rank directories) of unsigned 32-bit ids."""
    levels, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        levels.append(rest.astype(np.uint8).tobytes())
        rest = rest >> np.uint32(CHUNK)
        on = rest > 0
        bits = np.packbits(on, bitorder="little")
        bitmaps.append(bits.tobytes())
        blocks = np.pad(bits, (0, -len(bits) % (BLOCK // 8))).reshape(-1, BLOCK // 8)
        ranks.append(np.r_[0, np.cumsum(np.bitwise_count(blocks).sum(axis=1, dtype=np.int64))].astype("<u4").tobytes())
        rest = rest[on]
        if not len(rest):
            return levels, bitmaps, ranks


class Segment:
    """The levels, bitmaps and rank directories of a segment, of which any stretch is read by its own chunks."""

    def __init__(self, levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self._levels = [(np.frombuffer(level, dtype=np.uint8), np.frombuffer(bits, dtype=np.uint8), np.frombuffer(ranks_, dtype="<u4")) for level, bits, ranks_ in zip(levels, bitmaps, ranks)]

    @staticmethod
    def _rank(bits: np.ndarray, directory: np.ndarray, place: int) -> int:
        """Ones before ``place``: the directory's count and those of at most one block."""
        block = place // BLOCK
        first = block * BLOCK // 8
        whole = int(np.bitwise_count(bits[first : place // 8]).sum())
        more = int(bits[place // 8] & ((1 << place % 8) - 1)).bit_count() if place % 8 else 0
        return int(directory[block]) + whole + more

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids of tokens ``start`` to ``stop``."""
        out = np.zeros(max(0, stop - start), dtype=np.uint32)
        places = None
        for depth, (level, bits, directory) in enumerate(self._levels):
            if stop <= start:
                break
            chunk = level[start:stop].astype(np.uint32) << np.uint32(CHUNK * depth)
            if places is None:
                out |= chunk
            else:
                out[places] |= chunk
            on = np.flatnonzero(np.unpackbits(bits[start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start])
            start = self._rank(bits, directory, start)
            stop = start + len(on)
            places = on if places is None else places[on]
        return out


def read_tokens(levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes], start: int, stop: int) -> np.ndarray:
    """Ids of tokens ``start`` to ``stop`` of a segment, reading only their own chunks."""
    return Segment(levels, bitmaps, ranks).read(start, stop)


def _write_segments(batches, tokenizer, end_id, segment_tokens):
    part = TaskContext.get().partitionId()
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [f.split()[0] for f in FILE_SCHEMA.split(", ")]
    ids, lengths, held, size, segment, start_here = [], [], [], 0, 0, 0

    def flush():
        tokens = np.frombuffer(b"".join(held), dtype="<u4")
        levels, bitmaps, ranks = encode_levels(tokens)
        types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), *[pa.list_(pa.binary())] * 3]
        values = [part, segment, start_here, ids, lengths, len(tokens), levels, bitmaps, ranks]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    for batch in batches:
        ids_of = encoder(tokenizer.value).encode
        doc_ids = batch.column(0).to_pylist()
        for start, texts in text_groups(batch.column(1)):
            for i, tokens in enumerate(ids_of(texts)):
                ids.append(doc_ids[start + i])
                held.append(tokens + end)
                lengths.append(len(held[-1]) // 4)
                size += lengths[-1]
                if size >= segment_tokens:
                    yield flush()
                    ids, lengths, held, size, segment, start_here = [], [], [], 0, segment + 1, start_here + size
    if held:
        yield flush()


def _read_segments(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.cumsum(row["lengths"])
            begins = ends - row["lengths"]
            segment = Segment(row["levels"], row["bitmaps"], row["ranks"])
            # each document by its own stretch
            crcs = [zlib.crc32(segment.read(a, b).astype("<u4")) for a, b in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["first"] + begins, pa.int64()), pa.array(row["lengths"], pa.int64()), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def write_token_files(docs: DataFrame, scratch: Scratch, tokenizer: str | None = None, end_id: int = END_ID, segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Write the segments of all documents in ascending doc_id order and return them as read back.

    A null text is empty and has the end id alone. Rows without doc_id come first; rows with the same doc_id are
    ordered by a hash of their text and then as they come. A document is never split, so a long text makes a longer
    segment, of less than 2**31 tokens. Other columns are ignored; an empty table has no segment.
    """
    spark = docs.sparkSession
    shared = share_tokenizer(spark, tokenizer)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    dealt = rows.repartitionByRange(4 * shuffle_partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    return scratch.save("tokens", dealt.mapInArrow(lambda it: _write_segments(it, shared, end_id, segment_tokens), FILE_SCHEMA))


def _placed(files: DataFrame) -> DataFrame:
    """``files`` with ``first``, the tokens of the corpus before each segment."""
    spark = files.sparkSession
    totals = {r["part"]: r["n"] for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}  # a row for each range partition
    rows, first = [], 0
    for part in sorted(totals):
        rows.append((part, first))
        first += totals[part]
    bases = spark.createDataFrame(rows, "part int, base long")
    return files.join(F.broadcast(bases), "part").withColumn("first", F.col("base") + F.col("part_start")).drop("base")


def read_token_files(files: DataFrame) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32; without segments no rows."""
    return _placed(files).mapInArrow(_read_segments, "doc_id long, start long, n_tokens long, ids_crc32 long")


_CODES = ["levels", "bitmaps", "ranks"]


def _read_wanted(name: str):
    """A function of batches (wanted: list of structs with a, b and what names them, then the codes) that reads stretches of segments."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(*(row[c] for c in _CODES))
                found = [(w, segment.read(w["a"], w["b"])) for w in row["wanted"]]
                if name == "token":
                    columns, names = [pa.array([w["position"] for w, _ in found], pa.int64()), pa.array([int(x[0]) for _, x in found], pa.int64())], ["position", "token"]
                else:
                    fields = ("doc_id", "start", "stop")
                    columns, names = [*(pa.array([w[f] for w, _ in found], pa.int64()) for f in fields), pa.array([x.tolist() for _, x in found], pa.list_(pa.int64()))], [*fields, "tokens"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _documents(batches):
    """(part, segment, doc_id, begin, n) of the documents of segments."""
    for batch in batches:
        for row in batch.to_pylist():
            n = np.array(row["lengths"], dtype=np.int64)
            same = [pa.array(np.full(len(n), row[c], dtype=np.int32)) for c in ("part", "segment")]
            yield pa.RecordBatch.from_arrays([*same, pa.array(row["doc_ids"], pa.int64()), pa.array(np.cumsum(n) - n), pa.array(n)], names=["part", "segment", "doc_id", "begin", "n"])


def tokens_at(files: DataFrame, positions: DataFrame) -> DataFrame:
    """(position, token) of tokens of the corpus by their place in it (column ``position``, from 0), once each.

    Places meet segments by a number of ``SEGMENT_TOKENS`` places, which a segment shares with few others, and all that
    are wanted of a segment are read from it at once. Places that are null or beyond the corpus give no row.
    """
    index = _placed(files.select("part", "segment", "part_start", "n_tokens"))
    cells = F.sequence(F.floor(F.col("first") / SEGMENT_TOKENS), F.floor((F.col("first") + F.col("n_tokens") - 1) / SEGMENT_TOKENS))
    index = index.withColumn("cell", F.explode(cells)).drop("part_start")
    wanted = positions.select(F.col("position").cast("long").alias("position")).where("position >= 0").dropDuplicates()
    met = wanted.withColumn("cell", F.floor(F.col("position") / SEGMENT_TOKENS)).join(index, "cell").where((F.col("position") >= F.col("first")) & (F.col("position") < F.col("first") + F.col("n_tokens")))
    a = F.col("position") - F.col("first")
    by_segment = met.groupBy("part", "segment").agg(F.collect_list(F.struct(a.alias("a"), (a + 1).alias("b"), "position")).alias("wanted"))  # at most a segment's tokens
    return by_segment.join(files.select("part", "segment", *_CODES), ["part", "segment"]).select("wanted", *_CODES).mapInArrow(_read_wanted("token"), "position long, token long")


def document_tokens(files: DataFrame, stretches: DataFrame) -> DataFrame:
    """(doc_id, start, stop, tokens) of stretches of documents: tokens ``start`` to ``stop`` of each, cut at its end.

    Of documents with one doc_id each gives a row. Stretches of unknown documents, or with nulls, give none; those beyond
    a document's end or of no length have no tokens.
    """
    documents = files.select("part", "segment", "doc_ids", "lengths").mapInArrow(_documents, "part int, segment int, doc_id long, begin long, n long")
    wanted = stretches.select(*(F.col(c).cast("long").alias(c) for c in ("doc_id", "start", "stop"))).where("start >= 0 AND stop IS NOT NULL").dropDuplicates()
    met = wanted.join(documents, "doc_id")
    a, b = F.least("start", "n"), F.greatest(F.least("stop", "n"), F.least("start", "n"))
    place = F.struct((F.col("begin") + a).alias("a"), (F.col("begin") + b).alias("b"), "doc_id", "start", "stop")
    by_segment = met.groupBy("part", "segment").agg(F.collect_list(place).alias("wanted"))
    return by_segment.join(files.select("part", "segment", *_CODES), ["part", "segment"]).select("wanted", *_CODES).mapInArrow(_read_wanted("stretch"), "doc_id long, start long, stop long, tokens array<long>")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "dac")))
