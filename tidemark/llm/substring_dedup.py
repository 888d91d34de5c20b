"""Removal of passages that an earlier document has, by compacting the repeated part of a De Bruijn graph.

Edges of the graph are windows of 13 words. Only edges that occur in documents with different ids matter, so they are
found in passes whose tables stay small:

1. Whole texts that an earlier document has are set aside by their SHA-256. Each window of the others has a minimizer,
   the least hash of its 6-word pieces. Equal windows have equal minimizers, and a minimizer that only one document has
   cannot belong to a repeated edge.
2. Windows whose minimizer is left are the edge table: hash, document, place, and the hashes of the edges before and
   after it. Grouping it gives the repeated edges with their source (the least document, and its least place there) and
   the one edge that comes before, and after, all their occurrences, if it is one.
3. An edge follows another without a branch if each is the other's only neighbour at their node, in all documents. Such
   edges occur together everywhere, so they follow each other in their source too, and a run of them compacts into a
   path: first within blocks of source places, then from block to block by joins and pointer jumping. A path is known by
   its first edge and its length.
4. Documents meet paths by their first edges alone: where one occurs, all of its path does, and that is a span. Spans
   that follow each other along one source are one.
5. The words of every span are compared with those at its source place, in pieces that end at the same places of the
   source for all documents, by SHA-256. Where one differs, two windows share a hash: all windows with the hashes of
   that span are then told apart by the SHA-256 of their words.
"""

from __future__ import annotations

import hashlib
import operator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ._scratch import Scratch
from ._skew import join_counted
from ._words import Words, chunks, raw_texts

WINDOW = 13
PIECE = 6
#: Places of a source that are compacted as one group, and those that are compared as one stretch.
BLOCK, STRETCH = 64, 256
ROW = ["doc_id", "rid"]
SOURCE = ["src", "srid"]


def _minimizers(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(minimizer of each window, which windows lie in one row)."""
    inside = words.inside(WINDOW)
    if not len(inside):
        return np.empty(0, dtype=np.uint64), inside
    least = words.windows(PIECE)
    have, need = 1, WINDOW - PIECE + 1
    while have < need:
        step = min(have, need - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least, inside


def _changes(least: np.ndarray, inside: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places of windows inside a row whose minimizer differs from that of the window before."""
    at = np.flatnonzero(inside)
    if not len(at):
        return at
    new = np.ones(len(at), dtype=bool)
    new[1:] = (least[at[1:]] != least[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
    return at[new]


def _shas(batches):
    """SHA-256 of the words of each row, joined by one space."""
    for batch in batches:
        found = [hashlib.sha256(b" ".join(raw.split())).digest() for raw in raw_texts(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=[*ROW, "sha"])


def _minimizers_of_rows(batches):
    for batch in batches:
        ids, rids = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for start, _, words in chunks(batch.column(2)):
            least, inside = _minimizers(words)
            at = _changes(least, inside, words.row)
            row = start + words.row[at]
            yield pa.RecordBatch.from_arrays([pa.array(least[at].view(np.int64)), pa.array(ids[row]), pa.array(rids[row])], names=["m", *ROW])


def _edge_rows(batches):
    for batch in batches:
        ids, rids = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        marks = batch.column(3)
        for start, to, words in chunks(batch.column(2)):
            least, inside = _minimizers(words)
            if not len(least):
                continue
            wanted = marks.slice(start, to - start)
            flat = wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            rows = np.repeat(np.arange(to - start), wanted.value_lengths().to_numpy(zero_copy_only=False))
            order = np.lexsort((flat, rows))
            flat, rows = flat[order], rows[order]
            keep = np.zeros(len(least), dtype=bool)
            bounds = np.searchsorted(rows, np.arange(to - start + 1))
            for r in np.flatnonzero(bounds[1:] > bounds[:-1]):
                first, count = words.first[r], words.count[r]
                if count >= WINDOW:
                    mine = least[first : first + count - WINDOW + 1]
                    have = flat[bounds[r] : bounds[r + 1]]
                    place = np.minimum(np.searchsorted(have, mine), len(have) - 1)
                    keep[first : first + len(mine)] = have[place] == mine
            at = np.flatnonzero(keep & inside)
            row = words.row[at]
            own = words.windows(WINDOW).view(np.int64)
            pos = at - words.first[row]
            # the windows beside it, where its row has them
            ends = pos == words.count[row] - WINDOW
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own[at]),
                    pa.array(ids[start + row]),
                    pa.array(rids[start + row]),
                    pa.array(pos.astype(np.int32)),
                    pa.array(own[np.maximum(at - 1, 0)], mask=pos == 0),
                    pa.array(own[np.minimum(at + 1, len(own) - 1)], mask=ends),
                ],
                names=["h", *ROW, "pos", "prev", "next"],
            )


def _digests(batches):
    """128 bits of the SHA-256 of the words ``start`` to ``start + len`` of a row, for each of its ``asked`` stretches."""
    for batch in batches:
        asked = batch.column(1)
        flat, counts = asked.flatten(), asked.value_lengths().to_pylist()
        starts, lengths = (flat.field(i).to_numpy(zero_copy_only=False).tolist() for i in (0, 1))
        found, at = [], 0
        for raw, n in zip(raw_texts(batch.column(0)), counts):
            joined = b" ".join(raw.split())
            ends = np.append(np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 0x20), len(joined)).tolist()
            for i in range(at, at + n):
                a = starts[i]
                found.append(hashlib.sha256(joined[ends[a - 1] + 1 if a else 0 : ends[a + lengths[i] - 1]]).digest()[:16])
            at += n
        halves = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([flat.field(2), pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["key", "d1", "d2"])


def _cut(batches):
    for batch in batches:
        columns = batch.select(["text", "copied", "spans"]).to_pydict()
        n_words, n_removed, kept = [], [], []
        for text, copy, spans in zip(columns["text"], columns["copied"], columns["spans"]):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            n_words.append(len(words))
            if copy and len(words) >= WINDOW:
                n_removed.append(len(words))
                words = []
            elif spans:
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                spans = np.array([(s["start"], s["stop"]) for s in spans])
                np.add.at(edge, spans[:, 0], 1)
                np.add.at(edge, spans[:, 1], -1)
                covered = np.cumsum(edge[:-1]) > 0
                n_removed.append(int(covered.sum()))
                words = [words[i] for i in np.flatnonzero(~covered)]
            else:
                n_removed.append(0)
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        carried = [batch.column(i) for i in range(4, batch.num_columns)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), *carried],
            names=["doc_id", "n_words", "n_removed", "kept_text", *batch.schema.names[4:]],
        )


def compact_paths(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Paths (h of the first edge, src, srid, srcpos, edges, n) of repeated edges (h, src, srid, srcpos, prev, next, n).

    ``prev`` and ``next`` are the only edges before and after all occurrences of an edge, else null. Two edges are linked
    if each is the other's; they then have neighbouring places in one source, so a path rises along its places there.
    """
    # within a block: the part of a path that lies in it, named by its first place
    block = Window.partitionBy(*SOURCE, F.floor(F.col("srcpos") / BLOCK)).orderBy("srcpos")
    before = {c: F.lag(c).over(block) for c in ("h", "next", "srcpos")}
    linked = F.coalesce((before["h"] == F.col("prev")) & (before["next"] == F.col("h")) & (before["srcpos"] + 1 == F.col("srcpos")), F.lit(False))
    placed = edges.withColumn("begins", ~linked).withColumn("part", F.max(F.when(F.col("begins"), F.col("srcpos"))).over(block))
    parts = placed.groupBy(*SOURCE, "part").agg(
        F.max("srcpos").alias("last"), F.max_by(F.struct("h", "next"), "srcpos").alias("tail"), F.min_by(F.struct("h", "prev", "n"), "srcpos").alias("head")
    )
    parts = scratch.save("parts", parts)
    # from block to block: a part that is linked to the one that ends just before it points to that one
    ends = parts.select(*SOURCE, F.col("part").alias("before"), (F.col("last") + 1).alias("part"), F.col("tail").alias("end"))
    goes_on = (F.col("head.prev") == F.col("end.h")) & (F.col("end.next") == F.col("head.h"))
    heads = scratch.save("heads-0", parts.where(F.col("part") % BLOCK == 0).join(ends, [*SOURCE, "part"]).where(goes_on).select(*SOURCE, "part", F.col("before").alias("head")))
    n = 0
    while True:
        further = heads.select(*SOURCE, F.col("part").alias("head"), F.col("head").alias("next"))
        joined = heads.join(further, [*SOURCE, "head"], "left")
        n += 1
        heads = scratch.save(f"heads-{n}", joined.select(*SOURCE, "part", F.coalesce("next", "head").alias("head"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(f"heads-{n - 1}")
        if heads.where("moved").limit(1).isEmpty():
            break
        heads = heads.drop("moved")
    first = heads.select(*SOURCE, "part", F.col("head").alias("first"))
    whole = parts.join(first, [*SOURCE, "part"], "left").withColumn("first", F.coalesce("first", "part"))
    paths = whole.groupBy(*SOURCE, "first").agg(F.max("last").alias("last"), F.min_by("head", "part").alias("head"))
    return paths.select("head.h", *SOURCE, F.col("first").alias("srcpos"), (F.col("last") - F.col("first") + 1).cast("int").alias("edges"), "head.n")


def _met(edges: DataFrame, paths: DataFrame, total: int) -> DataFrame:
    """Spans (doc_id, rid, start, stop, src, srid, shift): occurrences of the first edges of paths in later documents than their source."""
    found = join_counted(edges.select("h", *ROW, "pos"), paths, ["h"], total, [*ROW, "pos"]).where("doc_id > src")
    return found.select(*ROW, F.col("pos").alias("start"), (F.col("pos") + F.col("edges") - 1 + WINDOW).alias("stop"), *SOURCE, (F.col("srcpos") - F.col("pos")).alias("shift"))


def _merged(spans: DataFrame) -> DataFrame:
    """Spans of one row that follow each other along one source become one.

    Where many documents differ in many places paths are short, and a document meets most of them in turn.
    """
    row = Window.partitionBy(*ROW).orderBy("start", "stop")  # bounded by the words of a row
    same = [F.lag(c).over(row) == F.col(c) for c in (*SOURCE, "shift")]
    goes_on = reduce(operator.and_, same, F.col("start") + WINDOW - 1 <= F.lag("stop").over(row))  # a repeated row has each span twice
    runs = spans.withColumn("run", F.sum(F.when(goes_on, 0).otherwise(1)).over(row))
    return runs.groupBy(*ROW, "run", *SOURCE, "shift").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def _pieces(spans: DataFrame) -> DataFrame:
    """Spans with the stretches of their source, which end at the same places for all spans: ``at`` and ``len``."""
    a, b = F.col("start") + F.col("shift"), F.col("stop") + F.col("shift")
    cut = spans.select("*", F.explode(F.sequence(F.floor(a / STRETCH), F.floor((b - 1) / STRETCH))).alias("nth"))
    begin, end = F.greatest(a, F.col("nth") * STRETCH), F.least(b, (F.col("nth") + 1) * STRETCH)
    return cut.select(*ROW, *SOURCE, "start", "stop", "shift", begin.cast("int").alias("at"), (end - begin).cast("int").alias("len"))


def _compare(known: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, d1, d2) of the stretches ``asked`` (doc_id, rid, start, len, key) for."""
    rows = asked.groupBy(*ROW).agg(F.collect_list(F.struct("start", "len", "key")).alias("asked"))
    key = asked.schema["key"].dataType.simpleString()
    return known.join(rows, ROW).select("text", "asked").mapInArrow(_digests, f"key {key}, d1 long, d2 long")


def _verified(known: DataFrame, spans: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``spans`` (doc_id, rid, start, stop, src, srid, shift) whose words are those of the source, and what is right instead of the others."""
    key = F.struct(*SOURCE, "at", "len")
    cut = _pieces(spans)
    own = cut.select(*ROW, (F.col("at") - F.col("shift")).alias("start"), "len", key.alias("key"))
    # the stretches within STRETCH places bound what is asked of a source by its length, whatever the number of spans
    there = cut.select(F.col("src").alias("doc_id"), F.col("srid").alias("rid"), F.col("at").alias("start"), "len", key.alias("key")).distinct()
    seen = _compare(known, own.unionByName(there)).select("key.*", "d1", "d2").groupBy(*SOURCE, "at", "len")
    differ = seen.agg(*(f(c).alias(f"{n}_{c}") for c in ("d1", "d2") for n, f in (("min", F.min), ("max", F.max)))).where("min_d1 <> max_d1 or min_d2 <> max_d2")
    differ = scratch.save("differ", differ.select(*SOURCE, "at", "len"))
    if differ.isEmpty():
        return spans
    span = [*ROW, *SOURCE, "start", "stop", "shift"]
    wrong = scratch.save("wrong", _pieces(spans).join(differ, [*SOURCE, "at", "len"], "left_semi").select(span).distinct())
    places = wrong.select(*ROW, F.explode(F.sequence("start", F.col("stop") - WINDOW)).alias("pos"))
    hashes = edges.join(places, [*ROW, "pos"], "left_semi").select("h").distinct()
    windows = edges.join(hashes, "h", "left_semi").select(*ROW, F.col("pos").alias("start"), F.lit(WINDOW).alias("len"), F.struct("h", *ROW, "pos").alias("key"))
    told = scratch.save("told", _compare(known, windows).select("key.*", "d1", "d2"))
    first = told.groupBy("h", "d1", "d2").agg(F.min("doc_id").alias("src"), F.min_by("rid", "doc_id").alias("srid"), F.min_by("pos", "doc_id").alias("at"))
    singly = told.join(first, ["h", "d1", "d2"]).where("doc_id > src")
    singly = singly.select(*ROW, *SOURCE, F.col("pos").alias("start"), (F.col("pos") + WINDOW).alias("stop"), (F.col("at") - F.col("pos")).alias("shift"))
    return spans.join(wrong, span, "left_anti").select(span).unionByName(singly)


def repeated_spans(known: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Of rows (doc_id, text, rid): spans (doc_id, rid, start, stop, src, srid, shift) and the rows (doc_id, rid) of whole copies."""
    shas = scratch.save("shas", known.select(*ROW, "text").mapInArrow(_shas, "doc_id long, rid long, sha binary"))
    firsts = shas.groupBy("sha").agg(F.min("doc_id").alias("src"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")).where("src < last").drop("last")
    firsts = scratch.save("firsts", firsts)
    copies = join_counted(shas, firsts, ["sha"], shas.count(), ROW).where("doc_id > src").select(ROW).distinct()
    copies = scratch.save("copies", copies)
    scratch.drop("shas", "firsts")

    single = known.join(copies, ROW, "left_anti").select(*ROW, "text")
    minimizers = scratch.save("minimizers", single.mapInArrow(_minimizers_of_rows, "m long, doc_id long, rid long"))
    shared = minimizers.groupBy("m").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")).where("first < last").select("m", "n")
    shared = scratch.save("shared", shared)
    marks = join_counted(minimizers, shared, ["m"], minimizers.count(), ROW).groupBy(*ROW).agg(F.collect_list("m").alias("marks"))
    marks = scratch.save("marks", marks)
    scratch.drop("minimizers", "shared")

    marked = known.join(marks, ROW).select(*ROW, "text", "marks")
    edges = scratch.save("edges", marked.mapInArrow(_edge_rows, "h long, doc_id long, rid long, pos int, prev long, next long"))
    scratch.drop("marks")
    only = lambda c: F.when((F.count(c) == F.count(F.lit(1))) & (F.min(c) == F.max(c)), F.min(c)).alias(c)
    repeated = (
        edges.groupBy("h")
        .agg(F.min(F.struct(*ROW, "pos")).alias("place"), F.max("doc_id").alias("last"), only("prev"), only("next"), F.count(F.lit(1)).alias("n"))
        .where("place.doc_id < last")
        .select("h", F.col("place.doc_id").alias("src"), F.col("place.rid").alias("srid"), F.col("place.pos").alias("srcpos"), "prev", "next", "n")
    )
    repeated = scratch.save("repeated", repeated)
    paths = scratch.save("paths", compact_paths(repeated, scratch))
    scratch.drop("repeated", "parts")
    spans = scratch.save("spans", _merged(_met(edges, paths, edges.count())))
    scratch.drop("paths")
    spans = scratch.save("verified", _verified(known, spans, edges, scratch))
    scratch.drop("edges", "spans")
    return spans, copies


def dedup_substrings(docs: DataFrame, carry: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text (kept words joined by one space).

    Each word is removed that lies in a window of 13 words which also starts in a document with a smaller doc_id. Null
    and empty texts have no words; texts under 13 words lose nothing. A row without doc_id has no place in the order:
    it loses nothing and takes nothing from others. Rows that repeat a doc_id lose nothing to each other. Very long
    texts are treated whole. Other columns are ignored, whatever their names, or with ``carry`` come along in a struct
    ``row`` with all input columns; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "substrings")
    carried = [F.struct("*").alias("row")] if carry else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("rid"), *carried)
    spans, copies = repeated_spans(rows.where(F.col("doc_id").isNotNull()).select("doc_id", "text", "rid"), scratch)
    marks = spans.groupBy(*ROW).agg(F.collect_list(F.struct("start", "stop")).alias("spans")).join(copies.withColumn("copied", F.lit(True)), ROW, "full")
    ready = rows.join(marks, ROW, "left").select("doc_id", "text", "copied", "spans", *(["row"] if carry else []))
    schema = "doc_id long, n_words long, n_removed long, kept_text string"
    return ready.mapInArrow(_cut, f"{schema}, row {ready.schema['row'].dataType.simpleString()}" if carry else schema)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns of ``docs``; a text that loses words becomes its kept words (and n_chars their length), and a row that loses all goes.

    Null, empty and short texts stay as they are. Columns of any name are kept; an empty table gives an empty result.
    """
    found = dedup_substrings(docs, carry=True).where("n_words = 0 or n_removed < n_words")
    cut = F.col("n_removed") > 0
    fields = {c: F.col("row").getField(c) for c in docs.columns}
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return found.select(*(F.when(cut, changed[c]).otherwise(v).alias(c) if c in changed else v.alias(c) for c, v in fields.items()))
