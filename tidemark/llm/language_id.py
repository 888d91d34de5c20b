"""Language identification by prediction by partial matching.

For each language a byte context tree of order 3 is learned: how often each byte follows each context of up to three
bytes. A byte's code length under a language uses the longest context that the language has; a byte that was not seen
there costs an escape and is coded by the next shorter context among the bytes that the longer one does not have
(method C with exclusion), down to a uniform code over all 256 bytes. Statistics are frozen, so the code length of a
byte depends on the last three bytes alone: a task per language tabulates it for every string that the language has,
with the cost of the escape for every context, and scoring sums table entries over all bytes of a text. The language
with the shortest code wins.

No context, byte or language is left out of the trees. What is bounded is the training text: ``SAMPLE_BYTES`` of each
language or one text if it is longer, whole texts drawn by a hash, which bounds the tables of a language. Languages are
held in blocks with a joint table each; all blocks score a text in one pass, and their results are merged exactly.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._scratch import Scratch
from ._skew import join_counted

ORDER = 3
#: Bytes of training text expected of each language, cells of a joint table, and of all tables unless each has one language.
SAMPLE_BYTES, MAX_CELLS, ALL_CELLS = 32 << 20, 1 << 24, 1 << 26
#: Languages whose sizes are broadcast.
MOST_BROADCAST = 10_000
_PAD = b"\n" * ORDER
#: Kinds of table rows: code lengths after one, two and three bytes, costs of the escape from two and three bytes.
AFTER_1, AFTER_2, AFTER_3, ESCAPE_2, ESCAPE_3 = range(5)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _runs(texts: pa.Array, size: int = 1 << 18):
    """(rows, bytes of their texts, each after a pad) in runs of about ``size`` bytes; empty texts are left out."""
    rows, parts, n = [], [], 0
    for row, text in enumerate(texts):
        raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
        if raw:
            rows.append(row)
            parts += [_PAD, raw]
            n += len(raw)
        if n >= size:
            yield rows, parts
            rows, parts, n = [], [], 0
    if rows:
        yield rows, parts


def _grams(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(each byte of the texts with the three before it as one number, first place of each text)."""
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    lengths = np.array([len(p) for p in parts[1::2]])
    begins = np.cumsum(lengths + ORDER) - lengths
    real = np.ones(len(data), dtype=bool)
    for k in range(1, ORDER + 1):
        real[begins - k] = False
    wide = data.astype(np.uint32)
    code = wide.copy()
    for k in range(1, ORDER + 1):
        code[k:] |= wide[:-k] << np.uint32(8 * k)
    return code[real], np.cumsum(lengths) - lengths


def _count(batches):
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        for lang in set(langs.tolist()):
            texts = batch.column(1).take(pa.array(np.flatnonzero(langs == lang)))
            for _, parts in _runs(texts, 1 << 20):
                gram, n = np.unique(_grams(parts)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])


def learn_counts(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(lang, gram, n): the four-byte strings of each language over a sample of ``docs`` (doc_id, lang, text).

    A text is drawn if its hash is below the share of its language's bytes that ``sample_bytes`` makes up, or is the
    least of its language, so no language is without a text, however large its texts are.
    """
    known = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 62)).alias("draw"))
    sizes = known.groupBy("lang").agg(F.sum(F.octet_length("text").cast("double")).alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("draw").alias("least"))
    sizes = Scratch(docs.sparkSession, "languages").save("sizes", sizes)  # a row for each language
    n_languages, n_rows = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # texts never meet by their language: there are few, and one may have most of the rows
    sized = known.join(F.broadcast(sizes.drop("n")), "lang") if n_languages <= MOST_BROADCAST else join_counted(known, sizes, ["lang"], n_rows, ["doc_id"])
    return sized.where(drawn(F.col("draw"), F.col("bytes"), F.col("least"), sample_bytes)).select("lang", "text").mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def drawn(draw: Column, bytes_: Column, least: Column, sample_bytes: int) -> Column:
    """Whether a text with the hash ``draw`` (below 2**62) is in the sample of its language; in doubles, for any size."""
    return (draw.cast("double") / float(1 << 62) * bytes_ < F.lit(float(sample_bytes))) | (draw == least)


def _mixed(counts: np.ndarray, shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(byte), its factor to ``shorter`` for a byte that was not seen) for contexts with ``counts``; unseen ones have that of ``shorter``."""
    seen = counts > 0
    total, kinds = counts.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
    left = np.where(seen, 0, shorter).sum(axis=1, keepdims=True)
    kinds = np.where(left > 0, kinds, 0)
    factor = np.where(total > 0, kinds / np.maximum(total + kinds, 1) / np.where(left > 0, left, 1), 1.0)
    return np.where(seen, counts / np.maximum(total + kinds, 1), factor * shorter), factor[:, 0]


def _bits(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, -np.log2(np.where(p > 0, p, 1)), 0.0)


def _sum_by(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, weights=n, minlength=len(found))


def tabulate(gram: np.ndarray, n: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, codes, bits) of one language from its four-byte strings and their counts."""
    dense = lambda keys, weights, rows: np.bincount(keys, weights=weights, minlength=256 * rows).reshape(rows, 256)
    p0, _ = _mixed(dense(gram & 0xFF, n, 1), np.full((1, 256), 1 / 256))
    p1, _ = _mixed(dense(gram & 0xFFFF, n, 256), np.repeat(p0, 256, axis=0))
    out = [(AFTER_1, np.arange(1 << 16), _bits(p1).ravel())]

    def order(codes, counts, shorter_of, after, escape, keep):
        """Contexts in chunks, so that their dense rows take little memory; ``keep`` holds those of the next order."""
        contexts, place = np.unique(codes >> 8, return_inverse=True)
        bits, costs = np.empty(len(codes)), np.empty(len(contexts))
        by_context = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[by_context], np.arange(0, len(contexts) + 4096, 4096))
        for k, first in enumerate(range(0, len(contexts), 4096)):
            at = by_context[bounds[k] : bounds[k + 1]]
            rows = min(4096, len(contexts) - first)
            key = (place[at] - first) * 256 + (codes[at] & 0xFF)
            p, factor = _mixed(dense(key, counts[at], rows), shorter_of(contexts[first : first + rows]))
            bits[at], costs[first : first + rows] = _bits(p.ravel()[key]), _bits(factor)
            if keep is not None:
                keep.append(p)
        out.extend([(after, codes, bits), (escape, contexts, costs)])
        return contexts

    kept: list[np.ndarray] = []
    pairs = order(*_sum_by(gram & 0xFFFFFF, n), lambda c: p1[c & 0xFF], AFTER_2, ESCAPE_2, kept)
    p2 = np.concatenate(kept) if kept else np.empty((0, 256))
    order(gram, n, lambda c: p2[np.searchsorted(pairs, c & 0xFFFF)], AFTER_3, ESCAPE_3, None)
    return out


def _tabulate(key: tuple[Any, ...], counts: pd.DataFrame) -> pd.DataFrame:
    tables = tabulate(counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.float64))
    kind = np.repeat([k for k, _, _ in tables], [len(c) for _, c, _ in tables])
    return pd.DataFrame({"lang": key[0], "kind": kind.astype(np.int32), "code": np.concatenate([c for _, c, _ in tables]), "bits": np.concatenate([b for _, _, b in tables]).astype(np.float32)})


class _Places:
    """Place of each of some 32-bit codes in an array of distinct ones, by open addressing."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes.astype(np.uint32)
        self._deal()

    def __getstate__(self):
        return self.codes

    def __setstate__(self, codes: np.ndarray):
        self.codes = codes
        self._deal()

    def _deal(self) -> None:
        codes = self.codes
        self.shift = np.uint32(32 - max(4, int(2 * len(codes)).bit_length()))
        self.slots = np.full(1 << (32 - int(self.shift)), -1, dtype=np.int32)
        rest = np.arange(len(codes), dtype=np.int32)
        slot = self._slot(self.codes)
        while len(rest):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = rest[free]
            missed = self.slots[slot] != rest
            rest, slot = rest[missed], (slot[missed] + 1) % len(self.slots)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint32(2654435761)) >> self.shift).astype(np.int64)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """-1 for a code that is not there."""
        codes = codes.astype(np.uint32)
        slot = self._slot(codes)
        found = self.slots[slot]
        if not len(self.codes):
            return found
        rest = np.flatnonzero((found >= 0) & (self.codes[found] != codes))
        while len(rest):
            slot[rest] = (slot[rest] + 1) % len(self.slots)
            found[rest] = self.slots[slot[rest]]
            rest = rest[(found[rest] >= 0) & (self.codes[found[rest]] != codes[rest])]
        return found


class Model:
    """Code lengths in bits under some languages, from the tables of each: kind -> (codes, bits)."""

    def __init__(self, tables: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]]):
        self.languages = sorted(tables)
        shape = lambda n: np.zeros((n, len(self.languages)), dtype=np.float32)
        joint = lambda kind: _Places(np.unique(np.concatenate([t[kind][0] for t in tables.values()])) if tables else np.empty(0, np.uint32))

        def put(table, kind, places):
            for i, lang in enumerate(self.languages):
                codes, bits = tables[lang][kind]
                table[places(codes), i] = bits

        def filled(places, of):
            table = shape(len(places.codes))
            for at in range(0, len(table), 1 << 16):
                table[at : at + (1 << 16)] = of(places.codes[at : at + (1 << 16)].astype(np.int64))
            return table

        self.after_1, self.escape_2 = shape(1 << 16), shape(1 << 16)
        put(self.after_1, AFTER_1, lambda c: c)
        put(self.escape_2, ESCAPE_2, lambda c: c)
        self.triples = joint(AFTER_2)
        self.after_2 = filled(self.triples, self._shorter)
        put(self.after_2, AFTER_2, self.triples.of)
        self.contexts = joint(ESCAPE_3)
        self.escape_3 = shape(len(self.contexts.codes) + 1)  # the last row is for contexts that no language has
        put(self.escape_3, ESCAPE_3, self.contexts.of)
        self.strings = joint(AFTER_3)
        self.after_3 = filled(self.strings, self._escaped)
        put(self.after_3, AFTER_3, self.strings.of)

    def _shorter(self, triple: np.ndarray) -> np.ndarray:
        return self.escape_2[triple >> 8] + self.after_1[triple & 0xFFFF]

    def _escaped(self, code: np.ndarray) -> np.ndarray:
        """Code lengths after three bytes where the string is in no language's table."""
        triple = code & 0xFFFFFF
        place = self.triples.of(triple)
        rest = np.where((place >= 0)[:, None], self.after_2[place], self._shorter(triple)) if len(self.after_2) else self._shorter(triple)
        return self.escape_3[self.contexts.of(code >> 8)] + rest

    def code_lengths(self, parts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        code, first = _grams(parts)
        place = self.strings.of(code)
        entries = self.after_3[place] if len(self.after_3) else np.zeros((len(code), len(self.languages)), np.float32)
        new = np.flatnonzero(place < 0)
        if len(new):
            entries[new] = self._escaped(code[new].astype(np.int64))
        return np.add.reduceat(entries, first, axis=0, dtype=np.float64)


def has_letter(text: str) -> bool:
    """Whether a character has one of the Unicode categories L*."""
    return any(map(str.isalpha, text))


def _predict(batches, shared):
    """The columns of a batch before its last, the text, with lang_pred, bits, and ``mass``: the sum of 2**(bits - bits of a language)."""
    for batch in batches:
        models = [block.value for block in shared]
        lang = np.full(batch.num_rows, None, dtype=object)
        least, mass = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        for rows, parts in _runs(batch.column(batch.num_columns - 1)):
            letters = [has_letter(raw.decode("utf-8", "surrogatepass")) for raw in parts[1::2]]
            rows, parts = [r for r, ok in zip(rows, letters) if ok], [p for raw, ok in zip(parts[1::2], letters) if ok for p in (_PAD, raw)]
            if not rows:
                continue
            best, own, sums = np.full(len(rows), None, dtype=object), np.full(len(rows), np.inf), np.zeros(len(rows))
            for model in models:  # in order of the languages, so a tie stays with the first
                bits = model.code_lengths(parts)
                found = bits.min(axis=1)
                names = np.array(model.languages, dtype=object)[bits.argmin(axis=1)]
                lower = np.minimum(own, found)
                sums = sums * np.exp2(np.maximum(lower - own, -1000)) + np.exp2(np.maximum(lower[:, None] - bits, -1000)).sum(axis=1)
                best, own = np.where(found < own, names, best), lower
            least[rows], mass[rows], lang[rows] = own, sums, best
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(least), pa.array(mass)], names=[*batch.schema.names[:-1], "lang_pred", "bits", "mass"]
        )


def train(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """The tables (lang, kind, code, bits) of the languages of ``docs`` (doc_id, lang, text), written to the shared folder.

    A task tabulates one language, whose distinct strings ``sample_bytes`` bounds, or its one text if that is longer. Rows
    with a null lang or text teach nothing; without others there are no tables.
    """
    counts = learn_counts(docs, sample_bytes)
    return Scratch(docs.sparkSession, "languages").save("tables", counts.groupBy("lang").applyInPandas(_tabulate, "lang string, kind int, code long, bits float"))


def blocks_of(tables: DataFrame, max_cells: int = MAX_CELLS, all_cells: int = ALL_CELLS) -> list[list[str]]:
    """Languages in blocks: strings of a block's languages times their number is at most ``max_cells``, or it has one language.

    Where the blocks together have more than ``all_cells``, smaller blocks are made, down to a language each; so what a
    task holds grows with the strings of all languages and no faster.
    """
    sizes = {r["lang"]: r["count"] for r in tables.where(F.col("kind") == AFTER_3).groupBy("lang").count().collect()}  # a row for each language
    while True:
        blocks, cells, strings = [], 0, 0
        for lang in sorted(sizes):
            if blocks and (strings + sizes[lang]) * (len(blocks[-1]) + 1) <= max_cells:
                cells += (strings + sizes[lang]) * (len(blocks[-1]) + 1) - strings * len(blocks[-1])
                blocks[-1].append(lang)
                strings += sizes[lang]
            else:
                blocks.append([lang])
                strings = sizes[lang]
                cells += strings
        if cells <= all_cells or len(blocks) == len(sizes):
            return blocks
        max_cells //= 2


def _model(tables: DataFrame, languages: list[str]) -> Model:
    """The model of one block of languages, read one after the other."""
    found = {}
    for lang in languages:
        rows = tables.where(F.col("lang") == lang).select("kind", "code", "bits").toArrow()
        kind, code, bits = (rows.column(i).to_numpy() for i in range(3))
        found[lang] = {k: (code[kind == k].astype(np.uint32), bits[kind == k]) for k in range(ESCAPE_3 + 1)}
    return Model(found)


def identify(docs: DataFrame, tables: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (the posterior share of that language, all equally likely before).

    ``und`` with score 0 for a null or empty text, one without a letter (Unicode categories L*), or tables without
    languages. Ties go to the first language by name. Whole texts are scored, in one pass under all languages; a long
    text is scored in one run of its own. Repeated rows and rows without doc_id are predicted like others; other columns
    are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = blocks_of(tables, max_cells)
    if not blocks:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = [spark.sparkContext.broadcast(_model(tables, block)) for block in blocks]
    found = rows.mapInArrow(lambda it: _predict(it, shared), "doc_id long, lang_pred string, bits double, mass double")
    score = F.when(F.col("lang_pred").isNotNull(), 1 / F.col("mass")).otherwise(0.0).alias("score")
    return found.select("doc_id", F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"), score)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = train(docs.where("doc_id is not null").where(~held_out(F.col("doc_id"))))
    return identify(docs, tables).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
