"""Fill-in-middle over seekable compressed frames.

A text is stored as independent zstandard frames, each with the line feeds and code points that stand before it. A cut
after k lines lies in one frame, which the counts name; only that frame is decompressed and cut. The transformed text
is again a list of frames: markers, the frames of the text that no cut meets, taken over as they are, and the pieces of
those that were cut. Digests decompress one frame after another in order, so no text is held whole after it was stored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from ._scratch import Scratch, spread
from ._words import raw_slices

#: Bytes of text in a frame, at most.
FRAME = 1 << 16
SEED = 7
#: Shares in percent: texts that are transformed, and those of them whose suffix comes first.
FIM_RATE, SPM_RATE = 100, 50
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
STORED = "doc_id long, n long, n_chars long, marked boolean, lines array<long>, chars array<long>, frames array<binary>"
OUTPUTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, frames array<binary>"
DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
#: Bytes of frames in one Arrow batch.
BATCH = 1 << 24
_TYPES = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _batches(rows, schema: str):
    """Rows whose last value may be a list of frames, as batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + sum(map(len, row[-1] or ())) if isinstance(row[-1], list) else 200
        if size >= BATCH:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _code_points(text: bytes) -> int:
    return int((np.frombuffer(text, dtype=np.uint8) & 0xC0 != 0x80).sum())


def cut_frames(text, size: int = FRAME):
    """Pieces of at most ``size`` bytes (or one code point) that end between code points."""
    at, end = 0, len(text)
    while at < end:
        to = min(end, at + max(size, 4))
        while to < end and text[to] & 0xC0 == 0x80:
            to -= 1
        yield bytes(text[at:to])
        at = to


def _stored(doc_id, text, press, size: int) -> tuple:
    frames, lines, chars, feeds, points = [], [], [], 0, 0
    tail, marked, last = b"", False, b""
    for piece in cut_frames(text, size):
        lines.append(feeds)
        chars.append(points)
        frames.append(press(piece))
        feeds += piece.count(b"\n")
        points += _code_points(piece)
        seam = tail + piece  # a marker may stand across two frames
        marked = marked or any(m in seam for m in (PREFIX, SUFFIX, MIDDLE))
        tail, last = piece[-2:], piece[-1:]
    return doc_id, feeds + (last not in (b"", b"\n")), points, marked, lines, chars, frames


def store_frames(docs: DataFrame, scratch: Scratch, frame: int = FRAME) -> DataFrame:
    """One row per document, written to the shared folder: its frames, counts before each, and its units (lines) ``n``.

    A null text is empty and has no frame; long texts have as many frames as they need. Rows without doc_id and repeated
    rows are kept as they are; columns other than doc_id and text are ignored; an empty table gives an empty result.
    """

    def run(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            ids = batch.column(0).to_pylist()
            yield from _batches((_stored(i, text, press, frame) for i, text in zip(ids, raw_slices(batch.column(1)))), STORED)

    return scratch.save("frames", spread(docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")).mapInArrow(run, STORED))


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """h1 to h4; a row without doc_id draws as if its number were empty."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


class Frames:
    """The frames of one text with the line feeds and code points before each; frames are decompressed when asked for."""

    def __init__(self, n: int, n_chars: int, lines: list[int], chars: list[int], frames: list[bytes]):
        self.n, self.n_chars, self.lines, self.chars, self.frames = n, n_chars, lines, chars, frames
        self._open, self._press = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=3).compress
        self._last = (-1, b"")
        #: Frames that were decompressed.
        self.opened: list[int] = []

    def text(self, k: int) -> bytes:
        if self._last[0] != k:
            self._last = (k, self._open(self.frames[k]))
            self.opened.append(k)
        return self._last[1]

    def place(self, units: int) -> tuple[int, int, int]:
        """(frame, byte in it, code points before) of the place after so many units."""
        if units <= 0:
            return 0, 0, 0
        if units >= self.n:
            return len(self.frames), 0, self.n_chars
        k = bisect_left(self.lines, units) - 1  # the last frame with fewer line feeds before it
        text = self.text(k)
        at = int(np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10)[units - self.lines[k] - 1]) + 1
        return k, at, self.chars[k] + _code_points(text[:at])

    def between(self, a: tuple[int, int, int], b: tuple[int, int, int]) -> list[bytes]:
        """Frames of the text from one place to another; those that neither place cuts are taken over."""
        (fa, at, _), (fb, to, _) = a, b
        if fa == fb:
            return [self._press(self.text(fa)[at:to])] if at < to else []
        out = []
        if at:
            rest = self.text(fa)[at:]
            out += [self._press(rest)] if rest else []
            fa += 1
        out += self.frames[fa:fb]
        return out + ([self._press(self.text(fb)[:to])] if to else [])


def transform(doc_id: int | None, text: Frames, marked: bool, seed: int = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> tuple:
    """(form, prefix_chars, middle_chars, frames of the output)."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text.n or marked or h3 % 100 >= fim_rate:
        return "plain", None, None, text.frames
    first, second = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
    start, a, b, end = text.place(0), text.place(first), text.place(second), text.place(text.n)
    form = "spm" if h4 % 100 < spm_rate else "psm"
    pieces = {PREFIX: (start, a), MIDDLE: (a, b), SUFFIX: (b, end)}
    frames = []
    for mark in ORDER[form]:
        frames += [text._press(mark), *text.between(*pieces[mark])]
    return form, a[2], b[2] - a[2], frames


def fill_in_middle(stored: DataFrame, seed: int = SEED, fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the ``frames`` of the transformed text, one row per stored text.

    Empty texts and texts that hold a marker stay plain; so do those beyond ``fim_rate``. A text of a single line has
    two places to be cut, its start and its end, so pieces may be empty.
    """

    def rows(batch):
        for r in batch.to_pylist():
            text = Frames(r["n"], r["n_chars"], r["lines"], r["chars"], r["frames"])
            yield (r["doc_id"], r["n"], *transform(r["doc_id"], text, r["marked"], seed, fim_rate, spm_rate))

    return stored.mapInArrow(lambda batches: (out for batch in batches for out in _batches(rows(batch), OUTPUTS)), OUTPUTS)


class Output:
    """An output's frames as a stream of bytes, of which any stretch is read by the frames that hold it."""

    def __init__(self, frames: list[bytes]):
        self.frames, self._open = frames, zstandard.ZstdDecompressor().decompress
        self.ends: list[int] = []

    def scan(self, marks: tuple[bytes, ...], digest) -> list[int]:
        """Feed all bytes in order to ``digest``; places of the marks, each the first after the one before."""
        self.ends, found, at, tail = [], [], 0, b""
        for frame in self.frames:
            piece = self._open(frame)
            digest.update(piece)
            seam, base = tail + piece, at - len(tail)
            while len(found) < len(marks):
                from_ = found[-1] + len(marks[len(found) - 1]) - base if found else 0
                place = seam.find(marks[len(found)], max(0, from_))
                if place < 0:
                    break
                found.append(base + place)
            at += len(piece)
            tail = seam[-2:]
            self.ends.append(at)
        return found

    def stream(self, start: int, stop: int):
        """The bytes from ``start`` to ``stop``, after a scan, frame by frame."""
        k = bisect_right(self.ends, start)
        while start < stop:
            piece = self._open(self.frames[k])
            base = self.ends[k] - len(piece)
            yield piece[start - base : stop - base]
            start = self.ends[k]
            k += 1

    def restored(self, form: str, places: list[int]):
        """The text that an output was made of, in pieces, from the output and its form alone."""
        end = self.ends[-1] if self.ends else 0
        if form == "plain":
            yield from self.stream(0, end)
            return
        marks = ORDER[form]
        spans = {m: (p + len(m), q) for m, p, q in zip(marks, places, [*places[1:], end])}
        for mark in (PREFIX, MIDDLE, SUFFIX):
            yield from self.stream(*spans[mark])


def digests(outputs: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with the SHA-256 of each output, and of the text that is rebuilt from it."""

    def rows(batch):
        for r in batch.to_pylist():
            output, whole, again = Output(r["frames"]), hashlib.sha256(), hashlib.sha256()
            places = output.scan(ORDER.get(r["form"], ()), whole)
            for piece in output.restored(r["form"], places):
                again.update(piece)
            yield r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], whole.hexdigest(), again.hexdigest()

    return outputs.mapInArrow(lambda batches: (out for batch in batches for out in _batches(rows(batch), DIGESTS)), DIGESTS)


def output_texts(outputs: DataFrame) -> DataFrame:
    """doc_id, form, output, restored: the transformed texts and those rebuilt from them, as strings."""
    schema = "doc_id long, form string, output string, restored string"

    def rows(batch):
        for r in batch.to_pylist():
            output, whole = Output(r["frames"]), hashlib.sha256()
            places = output.scan(ORDER.get(r["form"], ()), whole)
            end = output.ends[-1] if output.ends else 0
            yield r["doc_id"], r["form"], b"".join(output.stream(0, end)).decode(), b"".join(output.restored(r["form"], places)).decode()

    return outputs.mapInArrow(lambda batches: (_batch([row], schema) for batch in batches for row in rows(batch)), schema)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(fill_in_middle(store_frames(docs, Scratch(spark, "fim"))))


ORACLE_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT *, CAST(len(units) AS BIGINT) AS n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM f),
p AS (SELECT doc_id, n, form, t, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid, array_to_string(units[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""
