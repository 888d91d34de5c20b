"""Toxicity of documents behind a noisy channel.

A writer who hides a word replaces letters by look-alikes, spaces letters out or repeats them. Spans of a text that may
hide words become lattices: each run of equal characters is read as it stands, as a letter it looks like, as fewer
repeats, or, for separators, as nothing, each at a cost. A character language model of all documents prices the words
that come out, and Viterbi finds the cheapest reading, exactly, since a state is the model's whole context. Words of the
restored text then give evidence: those that labelled toxic documents have and others have not, summed and calibrated.
"""

from __future__ import annotations

import math
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._scratch import Scratch, spread
from ._words import Words
from .quality_classifier import _FOLD, _curve

#: Labelled documents that the evidence is fitted on, at most; those with the least hash of their id.
SAMPLE_ROWS = 50_000
#: Symbols of the language model: word boundary, a to z, other letters, digits and signs, punctuation.
SYMBOLS, BOUNDARY, OTHER, SIGN, MARK = 30, 0, 27, 28, 29
ORDER = 4
CONTEXTS = SYMBOLS ** (ORDER - 1)
#: Costs of the channel in nats: a letter written as a look-alike, a repeat, a separator put between letters. Words are
#: spelled with pairs of equal letters, so one letter of a pair costs more than one of a longer run.
LOOKS, REPEAT, PAIR, GAP = 0.7, 0.5, 2.0, 1.0
#: Letters that a character may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = ".-_*~/\\,:;^=#"
#: Single characters that stand alone in a row before they are read as one word.
SPACED = 3
#: A word counts if its share of toxic documents is that unlikely by chance (e**-CHANCE over all words), and mostly toxic.
MIN_DOCS, CHANCE, PURITY_Z, MIN_PURITY, SMOOTH = 5, 1.0, 2.0, 0.5, 0.5
MOST, BINS = 20.0, 400
#: Readings of spans that a worker remembers, and the longest span it remembers one for.
REMEMBERED, LONGEST = 200_000, 64
_SPACES = "\t\n\x0b\x0c\r "
_PUNCTUATION = ".,;:!?\"'()[]{}«»„“”’-"
_POINTS = 0x3000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(lower case, symbol) of each code point below ``_POINTS``."""
    lower, symbol = np.arange(_POINTS, dtype=np.uint32), np.full(_POINTS, SIGN, dtype=np.uint8)
    for point in range(_POINTS):
        char = chr(point).lower()
        char = char if len(char) == 1 else chr(point)
        lower[point] = ord(char)
        base = unicodedata.normalize("NFD", char)[0]
        if char in _SPACES:
            symbol[point] = BOUNDARY
        elif "a" <= base <= "z":
            symbol[point] = ord(base) - 96
        elif char.isalpha() or unicodedata.category(char)[0] == "M":
            symbol[point] = OTHER
        elif char in _PUNCTUATION:
            symbol[point] = MARK
    return lower, symbol


_LOWER, _SYMBOL = _tables()


def _mask(chars: str) -> np.ndarray:
    out = np.zeros(_POINTS, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


_LOOKS, _SEPARATES = _mask("".join(LOOK_ALIKES)), _mask(SEPARATORS)
_STRONG = _mask("0123456789@$€")


def _of(table: np.ndarray, points: np.ndarray, beyond) -> np.ndarray:
    if len(points) and points.max() >= _POINTS:
        return np.where(points < _POINTS, table[np.minimum(points, _POINTS - 1)], beyond).astype(table.dtype)
    return table[points]


class Chunk:
    """Texts side by side, with a line feed after each: code points in lower case, symbols, tokens and their rows."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        self.points = np.where(points < _POINTS, _LOWER[np.minimum(points, _POINTS - 1)], points).astype("<u4")
        self.symbols = _of(_SYMBOL, points, OTHER)
        self.offsets = np.r_[0, np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))]
        solid = np.r_[False, self.symbols != BOUNDARY, False]
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]

    def contexts(self) -> np.ndarray:
        """The context (the three symbols before, none from before a word's start) at each place."""
        s = self.symbols.astype(np.int64)
        one = np.r_[0, s[:-1]]
        two = np.where(one, np.r_[0, 0, s[:-2]][: len(s)], 0)
        three = np.where(two, np.r_[0, 0, 0, s[:-3]][: len(s)], 0)
        return (three * SYMBOLS + two) * SYMBOLS + one


def _grams(texts: list[str]) -> np.ndarray:
    """Numbers of the four-symbol grams of the texts' words; a boundary counts once after each word."""
    chunk = Chunk(texts)
    grams = chunk.contexts() * SYMBOLS + chunk.symbols
    return grams[(grams % (SYMBOLS * SYMBOLS)) != 0]  # not a boundary after a boundary


def _texts(column: pa.Array, size: int = 1 << 19):
    """(from, texts) for runs of rows of about ``size`` characters; null is empty."""
    start, held, n = 0, [], 0
    for i, text in enumerate(column):
        held.append(text.as_py() or "")
        n += len(held[-1])
        if n >= size:
            yield start, held
            start, held, n = i + 1, [], 0
    if held:
        yield start, held


def _count_grams(batches):
    n = np.zeros(CONTEXTS * SYMBOLS, dtype=np.int64)
    for batch in batches:
        for _, texts in _texts(batch.column(0)):
            found = np.bincount(_grams(texts))
            n[: len(found)] += found
    some = np.flatnonzero(n)
    for at in range(0, len(some), 1 << 16):
        part = some[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(n[part])], names=["gram", "n"])


def gram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n) over all documents; a task gives each gram once."""
    return spread(docs.select("text")).mapInArrow(_count_grams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_costs(grams: np.ndarray, n: np.ndarray) -> np.ndarray:
    """-log P(symbol | three symbols before) at each gram number: Witten and Bell's interpolation down to a uniform."""
    counts = np.zeros(CONTEXTS * SYMBOLS)
    counts[grams] = n
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(ORDER):
        # contexts of fewer symbols sum over what stands before them
        own = counts.reshape(-1, SYMBOLS**order, SYMBOLS).sum(axis=0)
        kinds = (own > 0).sum(axis=1, keepdims=True)
        lower = np.tile(p.reshape(-1, SYMBOLS), (SYMBOLS if order else 1, 1))
        total = own.sum(axis=1, keepdims=True) + kinds
        p = np.where(total > 0, (own + kinds * lower) / np.maximum(total, 1), lower)
    return -np.log(p).ravel().astype(np.float32)


def _symbol(char: str) -> int:
    return int(_SYMBOL[ord(char)]) if ord(char) < _POINTS else OTHER


def readings(char: str, n: int) -> list[tuple[str, float]]:
    """What a run of n equal characters may stand for, and the channel's cost."""
    out = [(char * n, 0.0)]
    symbol = _symbol(char)
    if char in LOOK_ALIKES:
        for letter in LOOK_ALIKES[char]:
            out.append((letter, LOOKS + REPEAT * (n - 1)))
            if n > 1:
                out.append((2 * letter, 2 * LOOKS + REPEAT * (n - 2)))
    elif 1 <= symbol <= OTHER and n > 1:
        out.append((char, PAIR if n == 2 else REPEAT * (n - 1)))
        if n > 2:
            out.append((2 * char, REPEAT * (n - 2)))
    if char in SEPARATORS or symbol == BOUNDARY:
        out.append(("", GAP + REPEAT * (n - 1)))
    return out


def runs(span: str) -> list[tuple[str, int]]:
    out, at = [], 0
    while at < len(span):
        to = at + 1
        while to < len(span) and span[to] == span[at]:
            to += 1
        out.append((span[at], to - at))
        at = to
    return out


class Decoder:
    """Viterbi over the lattices of spans under a table of gram costs."""

    def __init__(self, costs: np.ndarray):
        self.table, self.costs = costs, costs.tolist()
        self._known: dict[str, str] = {}

    def price(self, reading: str, context: int) -> tuple[float, int]:
        """(cost, context after) of a reading."""
        costs, cost = self.costs, 0.0
        for char in reading:
            symbol = _symbol(char)
            if symbol:
                at = context * SYMBOLS + symbol
                cost += costs[at]
                context = at % CONTEXTS
            elif context:
                cost += costs[context * SYMBOLS]
                context = 0
        return cost, context

    def decode(self, span: str) -> str:
        """The cheapest reading of a span in lower case; of equal ones the one that comes first in ``readings``."""
        states = {0: (0.0, None)}
        for char, n in runs(span):
            options, after = readings(char, n), {}
            for context, (cost, path) in states.items():
                for reading, own in options:
                    more, then = self.price(reading, context)
                    total = cost + own + more
                    best = after.get(then)
                    if best is None or total < best[0]:
                        after[then] = (total, (path, reading))
            states = after
        best = min(((cost + (self.costs[context * SYMBOLS] if context else 0.0), path) for context, (cost, path) in states.items()), key=lambda x: x[0])
        out, path = [], best[1]
        while path:
            path, reading = path
            out.append(reading)
        return "".join(reversed(out))

    def _remember(self, span: str) -> str:
        found = self._known.get(span)
        if found is None:
            found = self.decode(span)
            if len(span) <= LONGEST:
                if len(self._known) >= REMEMBERED:
                    self._known.clear()
                self._known[span] = found
        return found

    def spans(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of what may hide a word.

        These are tokens with three equal letters or more; with two equal letters of which one would be better left out,
        all else as it stands; with a look-alike or a separator between letters; with a digit, ``@``, ``$`` or a euro sign
        beside a letter; and rows of single characters.
        """
        s, points = chunk.symbols, chunk.points
        starts, ends = chunk.starts, chunk.ends
        if not len(starts):
            return starts, ends
        letter = (s >= 1) & (s <= OTHER)
        looks, separates, strong = (_of(t, points, False) for t in (_LOOKS, _SEPARATES, _STRONG))
        suspect = np.zeros(len(s), dtype=bool)
        equal = (points[1:] == points[:-1]) & letter[1:]
        suspect[:-2] |= equal[1:] & equal[:-1]
        # two equal letters: their grams with both and with one
        at = np.flatnonzero(equal)
        c = chunk.contexts()
        own = self.table[c * SYMBOLS + s]
        own[(c == 0) & (s == 0)] = 0
        far = np.r_[s, [0, 0]]
        second = far[at + 2].astype(np.int64)
        third = np.where(second > 0, far[at + 3], 0).astype(np.int64)
        shrunk = c[at] * SYMBOLS + s[at]  # the symbols up to the first of the two
        one = shrunk % CONTEXTS * SYMBOLS + second
        two = np.where(second > 0, one % CONTEXTS * SYMBOLS + third, 0)
        after = np.r_[own, np.zeros(3, dtype=own.dtype)]
        gain = after[at + 1] + after[at + 2] + np.where(second > 0, after[at + 3], 0) - self.table[one] - np.where(second > 0, self.table[two], 0)
        suspect[at[gain > PAIR]] = True
        # signs inside and beside words
        letters = np.r_[0, np.cumsum(letter)]
        signs = np.flatnonzero(looks | separates)
        token = np.searchsorted(starts, signs, side="right") - 1
        inside = (letters[signs] > letters[starts[token]]) & (letters[ends[token]] > letters[signs])
        suspect[signs[inside]] = True
        suspect[:-1] |= strong[:-1] & letter[1:]
        suspect[1:] |= strong[1:] & letter[:-1]
        sums = np.r_[0, np.cumsum(suspect)]
        flagged = sums[ends] > sums[starts]
        # rows of single characters
        single = (ends - starts == 1) & (letter | looks)[starts]
        row = np.searchsorted(chunk.offsets, starts, side="right")
        joins = single[1:] & single[:-1] & (starts[1:] == ends[:-1] + 1) & (row[1:] == row[:-1])
        edges = np.flatnonzero(np.diff(np.r_[False, joins, False].astype(np.int8)))
        first, last = edges[::2], edges[1::2]  # tokens first to last, both included
        wide = last - first + 1 >= SPACED
        first, last = first[wide], last[wide]
        spaced = np.zeros(len(starts) + 1, dtype=np.int64)
        np.add.at(spaced, first, 1)
        np.add.at(spaced, last + 1, -1)
        alone = flagged & (np.cumsum(spaced)[:-1] == 0)
        out = np.r_[starts[alone], starts[first]], np.r_[ends[alone], ends[last]]
        order = np.argsort(out[0], kind="stable")
        return out[0][order], out[1][order]

    def restore(self, texts: list[str]) -> tuple[list[str], list[int]]:
        """(texts with hidden words restored, spans that changed in each)."""
        chunk = Chunk(texts)
        lower = chunk.points.tobytes().decode("utf-32-le")
        starts, ends = self.spans(chunk)
        rows = np.searchsorted(chunk.offsets, starts, side="right") - 1
        out, changed = list(texts), [0] * len(texts)
        pieces: dict[int, list[str]] = {}
        upto: dict[int, int] = {}
        for a, b, row in zip(starts.tolist(), ends.tolist(), rows.tolist()):
            span = lower[a:b]
            read = self._remember(span)
            if read != span:
                base = int(chunk.offsets[row])
                pieces.setdefault(row, []).extend((texts[row][upto.get(row, 0) : a - base], read))
                upto[row] = b - base
                changed[row] += 1
        for row, parts in pieces.items():
            out[row] = "".join(parts) + texts[row][upto[row] :]
        return out, changed


class Toxicity:
    """Gram costs, words that speak for toxicity (hashes, ascending) with their weights, and the curve of their sum."""

    def __init__(self, costs: np.ndarray, words: np.ndarray, weights: np.ndarray, curve: tuple[float, float]):
        order = np.argsort(words.view(np.uint64))
        self.costs, self.words, self.weights, self.curve = costs, words.view(np.uint64)[order], weights[order], curve

    def sums(self, words: Words, rows: int) -> np.ndarray:
        """Weights of each row's distinct words."""
        out = np.zeros(rows)
        if len(self.words) and len(words.hash):
            place = np.minimum(np.searchsorted(self.words, words.hash), len(self.words) - 1)
            hit = self.words[place] == words.hash
            key = np.unique(words.row[hit] * len(self.words) + place[hit])
            np.add.at(out, key // len(self.words), self.weights[key % len(self.words)])
        return out

    def scores(self, sums: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.minimum(sums, MOST), -30, 30)))


_decoders: dict[int, Decoder] = {}


def _decoder(shared) -> Decoder:
    """One decoder for a Python worker and table."""
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) else id(shared)
    if key not in _decoders:
        _decoders.clear()
        _decoders[key] = Decoder(shared.value)
    return _decoders[key]


def _words_of(texts: list[str]) -> Words:
    raw = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))]
    return Words(_FOLD[np.frombuffer(b"".join(raw), dtype=np.uint8)], offsets)


def _restored(column: pa.Array, decoder: Decoder):
    """(from, restored texts, changes, words) for runs of rows. Words are compared in lower case."""
    for start, texts in _texts(column):
        texts, changed = decoder.restore(texts)
        yield start, texts, changed, _words_of([t.lower() for t in texts])


def _count_words(shared):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for start, _, _, words in _restored(batch.column(1), _decoder(shared)):
                key = np.unique(np.stack([words.row.astype(np.uint64), words.hash], axis=1), axis=0) if len(words.hash) else np.empty((0, 2), dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[start + key[:, 0].astype(np.int64)]), pa.array(key[:, 1].view(np.int64))], names=["doc_id", "word"])

    return run


def _score(shared, model):
    def run(batches):
        for batch in batches:
            for start, texts, changed, words in _restored(batch.column(1), _decoder(shared)):
                sums = model.value.sums(words, len(texts))
                columns = [batch.column(0).slice(start, len(texts)), pa.array(texts, pa.string()), pa.array(changed, pa.int64()), pa.array(sums), pa.array(model.value.scores(sums))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "restored", "n_restored", "evidence", "score"])

    return run


def held_out():
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Toxicity:
    """The language model of all ``docs`` and the evidence of at most ``sample_rows`` labelled ones.

    Labels whose crc32(doc_id) mod 5 is 0 are not used; those of remainder 1 give the curve, the others the words. Null
    labels say nothing, and of several labels of one document the greatest counts. Copies of a text count once.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    counts = gram_counts(docs).toPandas()  # a row for each gram of 30 symbols
    costs = gram_costs(counts["gram"].to_numpy(dtype=np.int64), counts["n"].to_numpy(dtype=float))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = scratch.save("sample", sample.withColumn("curve", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")  # at most ``sample_rows`` rows
    texts = spread(scratch.save("texts", texts))  # bounded by the sample
    firsts = texts.where("not curve").groupBy(F.xxhash64("text").alias("h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    fitting = texts.where("not curve").join(firsts, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    shared = spark.sparkContext.broadcast(costs)
    totals = fitting.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    yes, no = totals["toxic"], totals["docs"] - totals["toxic"]
    words = np.empty(0, dtype=np.int64)
    weights = np.empty(0)
    if yes and no:
        rate = yes / totals["docs"]
        found = fitting.select("doc_id", "text").mapInArrow(_count_words(shared), "doc_id long, word long").join(F.broadcast(sample), "doc_id")
        counted = scratch.save("words", found.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k")).where(F.col("n") >= MIN_DOCS))
        n, k = F.col("n").cast("double"), F.col("k").cast("double")
        part = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(F.lit(0.0))
        surprise = part(k, n * rate) + part(n - k, n * (1 - rate))  # Chernoff's bound of the share's chance
        share = k / n
        bound = (share + PURITY_Z**2 / (2 * n) - PURITY_Z * F.sqrt(share * (1 - share) / n + PURITY_Z**2 / (4 * n * n))) / (1 + PURITY_Z**2 / n)
        chosen = counted.where((share > rate) & (surprise >= math.log(max(1, counted.count())) + CHANCE) & (bound >= MIN_PURITY))
        weight = F.log((k + SMOOTH) / (yes + 2 * SMOOTH)) - F.log((n - k + SMOOTH) / (no + 2 * SMOOTH))
        table = chosen.select("word", weight.alias("weight")).toPandas()  # bounded by the sample
        words, weights = table["word"].to_numpy(dtype=np.int64), table["weight"].to_numpy(dtype=float)
    model = Toxicity(costs, words, weights, (0.0, 1.0))
    interim = spark.sparkContext.broadcast(model)
    scored = texts.where("curve").select("doc_id", "text").mapInArrow(_score(shared, interim), SCORED).join(F.broadcast(sample), "doc_id")
    place = F.round(F.least("evidence", F.lit(MOST)) * (BINS / MOST))
    binned = scored.groupBy(place.alias("bin")).agg(F.sum(F.col("toxic")).alias("yes"), F.count(F.lit(1)).alias("n")).toPandas()
    if len(binned):
        model.curve = _curve(binned["bin"].to_numpy(dtype=float) * (MOST / BINS), binned["yes"].to_numpy(dtype=float), binned["n"].to_numpy(dtype=float))
    else:
        model.curve = (math.log((yes + 1) / (no + 1)) if totals["docs"] else -1.0, 1.0)
    interim.unpersist()
    return model


SCORED = "doc_id long, restored string, n_restored long, evidence double, score double"


def score_toxicity(docs: DataFrame, model: Toxicity) -> DataFrame:
    """doc_id, restored text, n_restored (spans read otherwise than they stand), evidence, score of every row.

    A null text is read as empty; texts without words have the score of no evidence. Long texts are read whole, a run of
    about half a million characters at a time or a longer text alone. Repeated rows and rows without doc_id are scored
    like others; columns other than doc_id and text are ignored; an empty table gives an empty result.
    """
    context = docs.sparkSession.sparkContext
    shared, sent = context.broadcast(model.costs), context.broadcast(model)  # 810,000 costs, and words of the sample
    return spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(_score(shared, sent), SCORED)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score_toxicity(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
