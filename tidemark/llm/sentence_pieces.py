"""SentencePiece encoding and decoding with the pieces of a model file and their log scores.

A file of the Unigram kind holds log scores. One of the BPE kind holds merge ranks, which are no logarithms of anything;
their log scores follow from the ranks by the law of Zipf and Mandelbrot, P(piece) = c / (rank + 2.7), with c such that
the probabilities of all pieces sum to one. Nothing is trained.

Pieces stand in a double-array trie over bytes. The best segmentation has the greatest sum of log scores (Viterbi, in
32-bit floats as the library has them); a character that no piece covers alone may be left unknown at a penalty and is
then written as byte pieces. White space
is the marker U+2581, also before the text. If no piece has a marker after another character, no piece crosses the
start of a marked word, so words are segmented one by one and each distinct word of a task only once; distinct words
of one length are segmented together, one numpy step for all.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tokens import text_groups

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: The constant of Mandelbrot's form of the law.
RANK_SHIFT = 2.7
#: Distinct words whose ids a task keeps at a time; longer words (in bytes) are segmented one by one.
CACHE_ENTRIES, LONG_WORD = 500_000, 64
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class DoubleArray:
    """Trie over bytes: state ``t = base[s] + byte`` follows ``s`` if ``check[t] == s``; ``value[t]`` is a piece or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        keys = sorted(keys)
        size = 256 + 4 * sum(len(k) for k, _ in keys) + 1024
        self.base = np.zeros(size, dtype=np.int32)
        self.check = np.full(size, -1, dtype=np.int32)
        self.value = np.full(size, -1, dtype=np.int32)
        free = np.ones(size, dtype=bool)
        free[0] = False
        lowest = 1
        stack = [(0, 0, len(keys), 0)]
        top = 256
        while stack:
            state, lo, hi, depth = stack.pop()
            if lo < hi and len(keys[lo][0]) == depth:
                self.value[state] = keys[lo][1]
                lo += 1
            if lo == hi:
                continue
            groups, start = [], lo
            for i in range(lo + 1, hi + 1):
                if i == hi or keys[i][0][depth] != keys[start][0][depth]:
                    groups.append((keys[start][0][depth], start, i))
                    start = i
            labels = np.array([g[0] for g in groups])
            while not free[lowest]:
                lowest += 1
            at, base = lowest, None
            while base is None:
                spots = np.flatnonzero(free[at : at + 4096]) + at - labels[0]
                spots = spots[(spots >= 0) & (spots < len(free) - 256)]
                good = free[spots[:, None] + labels].all(axis=1)
                if good.any():
                    base = int(spots[good.argmax()])
                at += 4096
                if at >= len(free):
                    self.base, self.check, self.value = (np.r_[x, np.full(size, fill, np.int32)] for x, fill in ((self.base, 0), (self.check, -1), (self.value, -1)))
                    free = np.r_[free, np.ones(size, dtype=bool)]
            self.base[state] = base
            free[base + labels] = False
            self.check[base + labels] = state
            top = max(top, base + 256)
            stack += [(base + label, a, b, depth + 1) for label, a, b in groups]
        self.base, self.check, self.value = (x[: top + 256].copy() for x in (self.base, self.check, self.value))


def rank_scores(pieces: list[tuple[str, float, str]]) -> list[tuple[str, float, str]]:
    """``pieces`` with log probabilities instead of the merge ranks of normal ones; the others keep theirs."""
    mass = math.log(sum(1 / (RANK_SHIFT - score) for _, score, kind in pieces if kind == "normal"))
    return [(text, -math.log(RANK_SHIFT - score) - mass if kind == "normal" else score, kind) for text, score, kind in pieces]


class PieceModel:
    """What encoding and decoding need of a model file; its size is that of the vocabulary."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        """``pieces``: (text, score, kind) by id; kinds are normal, byte, control and unknown."""
        normal = [(text.encode(), i) for i, (text, _, kind) in enumerate(pieces) if kind == "normal" and text]
        self.trie = DoubleArray(normal)
        self.score = np.array([score for _, score, _ in pieces], dtype=np.float32)
        self.byte_id = [-1] * 256
        self.surface: list[bytes] = []
        for i, (text, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.byte_id[int(text[3:5], 16)] = i
            self.surface.append(bytes([int(text[3:5], 16)]) if kind == "byte" else text.replace(MARK, " ").encode() if kind == "normal" else b"")
        self.unknown_id = next((i for i, p in enumerate(pieces) if p[2] == "unknown"), 0)
        self.unknown_score = np.float32(min((self.score[i] for _, i in normal), default=0.0)) - np.float32(UNKNOWN_PENALTY)
        self.by_word = not any(MARK in pieces[i][0].lstrip(MARK) for _, i in normal)
        self._cache: dict[str, bytes] = {}

    def __getstate__(self):
        return self.__dict__ | {"_cache": {}}

    @staticmethod
    def read(path: str, ranked: bool = True) -> PieceModel:
        """``ranked``: the file's scores are merge ranks (0, -1, -2, ...), as those of a BPE model."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: "byte" if model.is_byte(i) else "control" if model.is_control(i) else "unknown" if model.is_unknown(i) else "normal"
        pieces = [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]
        return PieceModel(rank_scores(pieces) if ranked else pieces)

    def _ids(self, raw: bytes, cuts: list[tuple[int, int, int]]) -> bytes:
        out = []
        for start, end, piece in cuts:
            if piece >= 0:
                out.append(piece)
            elif self.byte_id[raw[start]] >= 0:
                out += [self.byte_id[b] for b in raw[start:end]]
            else:
                out.append(self.unknown_id)
        return np.array(out, dtype="<u4").tobytes()

    def segment(self, raw: bytes) -> bytes:
        """Ids of one stretch by Viterbi; of equal sums the one whose last piece starts first wins."""
        base, check, value, score = self.trie.base, self.trie.check, self.trie.value, self.score
        n = len(raw)
        best, back = np.full(n + 1, -np.inf, dtype=np.float32), [(0, -1)] * (n + 1)
        best[0] = 0
        for i in range(n):
            if best[i] == float("-inf"):
                continue
            width = _width(raw[i])
            state, alone = 0, False
            for j in range(i, n):
                t = int(base[state]) + raw[j]
                if check[t] != state:
                    break
                state = t
                piece = int(value[t])
                if piece >= 0:
                    alone = alone or j + 1 == i + width
                    if best[i] + score[piece] > best[j + 1]:
                        best[j + 1], back[j + 1] = best[i] + score[piece], (i, piece)
            end = min(n, i + width)
            if not alone and best[i] + self.unknown_score > best[end]:
                best[end], back[end] = best[i] + self.unknown_score, (i, -1)
        cuts, end = [], n
        while end:
            start, piece = back[end]
            cuts.append((start, end, piece))
            end = start
        return self._ids(raw, cuts[::-1])

    def _segment_all(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of one length."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        n, length = len(words), len(words[0])
        text = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(n, length).astype(np.int32)
        best = np.full((n, length + 1), -np.inf, dtype=np.float32)
        start = np.zeros((n, length + 1), dtype=np.int32)
        piece = np.full((n, length + 1), -1, dtype=np.int32)
        best[:, 0] = 0
        width = 1 + (text >= 0xC0) + (text >= 0xE0) + (text >= 0xF0)
        for i in range(length):
            live = np.flatnonzero(best[:, i] > -np.inf)
            if not len(live):
                continue
            alone = np.zeros(n, dtype=bool)
            rows, state = live, np.zeros(len(live), dtype=np.int32)
            for j in range(i, length):
                t = base[state] + text[rows, j]
                ok = check[t] == state
                rows, state = rows[ok], t[ok]
                if not len(rows):
                    break
                found = value[state]
                hit = found >= 0
                to, found = rows[hit], found[hit]
                alone[to[j + 1 == i + width[to, i]]] = True
                sums = best[to, i] + self.score[found]
                better = sums > best[to, j + 1]
                to = to[better]
                best[to, j + 1], start[to, j + 1], piece[to, j + 1] = sums[better], i, found[better]
            rest = live[~alone[live]]
            end = np.minimum(length, i + width[rest, i])
            sums = best[rest, i] + self.unknown_score
            better = sums > best[rest, end]
            rest, end = rest[better], end[better]
            best[rest, end], start[rest, end], piece[rest, end] = sums[better], i, -1
        out = []
        for raw, starts, pieces in zip(words, start.tolist(), piece.tolist()):
            cuts, end = [], length
            while end:
                cuts.append((starts[end], end, pieces[end]))
                end = starts[end]
            out.append(self._ids(raw, cuts[::-1]))
        return out

    def _learn(self, words: set[str]) -> None:
        if len(self._cache) + len(words) > CACHE_ENTRIES:
            self._cache.clear()
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            if len(raw) > LONG_WORD:
                self._cache[word] = self.segment(raw)
            else:
                by_length.setdefault(len(raw), []).append((word, raw))
        for group in by_length.values():
            for at in range(0, len(group), 20_000):
                part = group[at : at + 20_000]
                self._cache.update(zip((w for w, _ in part), self._segment_all([r for _, r in part])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        words = []
        for text in texts:
            marked = MARK + text.replace(" ", MARK) if text else ""
            if not self.by_word:
                words.append([marked] if marked else [])
            elif MARK + MARK in marked or marked[-1:] == MARK:
                words.append(_WORD.findall(marked))
            else:
                words.append([MARK + w for w in marked.split(MARK)[1:]] if marked else [])
        need = set().union(*words)
        missing = need.difference(self._cache)
        if len(self._cache) + len(missing) > CACHE_ENTRIES:
            missing = need
        self._learn(missing)
        get = self._cache.__getitem__
        return [b"".join(map(get, w)) for w in words]

    def decode(self, ids: bytes) -> str:
        """The text of ids: byte pieces give bytes, markers give spaces, and the marker before the text goes."""
        raw = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def _width(first: int) -> int:
    return 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encode(batches, shared):
    model = shared.value
    for batch in batches:
        for start, texts in text_groups(batch.column(1), 1 << 20):
            ids = model.encode(texts)
            decoded = [model.decode(x) for x in ids]
            offsets = np.r_[0, np.cumsum([len(x) // 4 for x in ids])].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, len(texts)), lists, pa.array(decoded, pa.string()), pa.array([a == b for a, b in zip(texts, decoded)])],
                names=["doc_id", "ids", "decoded", "round_trip"],
            )


def encode_pieces(docs: DataFrame, model: PieceModel | None = None) -> DataFrame:
    """One row per input row: doc_id, ids (array), decoded (the text of the ids), round_trip (whether that is the text).

    Null and empty texts have no ids and decode to an empty text. Literal U+2581 characters decode to spaces, so
    they do not come back. Whole texts are encoded, whatever their length. Repeated rows and rows without doc_id are
    treated like others; other columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or PieceModel.read(model_path()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda it: _encode(it, shared), "doc_id long, ids array<int>, decoded string, round_trip boolean")


def decode_pieces(encoded: DataFrame, model: PieceModel | None = None) -> DataFrame:
    """doc_id and text of rows (doc_id, ids), in their number; null ids are none and give an empty text, and no rows give none."""
    shared = encoded.sparkSession.sparkContext.broadcast(model or PieceModel.read(model_path()))

    def run(batches):
        for batch in batches:
            texts = [shared.value.decode(np.array(x or [], dtype="<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"))
