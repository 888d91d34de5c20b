"""Token ids of whole texts from a public tokenizer file, inside Spark tasks."""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Distinct stretches and split parts whose ids a task keeps at a time.
STRETCHES, PARTS = 600_000, 100_000
#: New words that are encoded as one text.
TOGETHER = 1000
#: Ids that the operators put at the end of a document are at most this.
END_IDS = 2
_CUT = re.compile(r"(?<=\S) (?=\S)")
_STEM = re.compile(r"\n?[^\W\d_]+")
_RARE = re.compile(r"[^\S \n]")
_RARE_LATIN = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
#: Stretches whose split parts the pattern below gives: of these characters it knows the letters and the digits.
_PLAIN = re.compile("[\x21-\x7e\xc0-\xff\n]+")
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")


def tokenizer_json(name: str = "byte_bpe_50k.json") -> str:
    """The text of a tokenizer file that is installed with the public tokenizers."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def largest_id(json_text: str) -> int:
    spec = json.loads(json_text)
    return max([END_IDS, *spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))])


def _trim(known: dict, most: int) -> None:
    """Of too many entries drop the later half: what is frequent came early."""
    if len(known) > most:
        for key in list(islice(reversed(known), len(known) // 2)):
            del known[key]


class _Parts(dict):
    """Ids of split parts, each asked of the library once."""

    def __init__(self, tokenizer):
        self._encode = tokenizer.encode

    def __missing__(self, part: str) -> bytes:
        ids = self[part] = array("I", self._encode(part, add_special_tokens=False).ids).tobytes()
        return ids


class _Stretches(dict):
    """Ids of stretches that follow a space; words among them are held here and nowhere else."""

    def __init__(self, tokenizer, parts: _Parts, added: list[str]):
        self._parts = parts
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self._bytes = np.zeros(1 + max(tokenizer.get_vocab().values(), default=0), dtype=np.int64)
        self._bytes[list(vocabulary.values())] = list(map(len, vocabulary))  # a character of a piece stands for a byte
        self._batch = tokenizer.encode_batch_fast
        self._encode, self._part, self._plain, self._split = tokenizer.encode, parts.__getitem__, _PLAIN.fullmatch, _SPLIT.findall
        self._added = re.compile("|".join(map(re.escape, added)) or r"(?!)").search

    def learn(self, stretches: list[str]) -> None:
        """Ask the library for the new words that ``stretches`` begin with, many in one text.

        A word of letters after a space is one split part, and so is one after a line feed, so each word of the text has
        tokens of its own, which the bytes of the tokens tell.
        """
        fresh = [s for s in stretches if s not in self]
        words = dict.fromkeys(s for s in fresh if s.isalpha())
        stems = dict.fromkeys(m.group() for s in fresh if not s.isalpha() and (m := _STEM.match(s)))
        words.update(dict.fromkeys(w for w in stems if w[0] != "\n" and w not in self))
        self._ask(list(words), " ", self)
        parts = self._parts
        self._ask([w[1:] for w in stems if w[0] == "\n" and w[1:] not in parts], "\n", parts)

    def _ask(self, words: list[str], before: str, known: dict) -> None:
        skipped = len(before.lstrip(" "))  # a line feed is a part of its own, a space belongs to its word
        lengths = pc.binary_length(pa.array(words, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            ids = self._batch([before + before.join(some)], add_special_tokens=False)[0].ids
            raw = array("I", ids).tobytes()
            ends = np.cumsum(self._bytes[np.frombuffer(raw, dtype="<u4")])
            stops = np.cumsum(lengths[at : at + TOGETHER])
            starts = np.r_[0, stops[:-1]] + skipped
            first, last = (np.searchsorted(ends, x, side="right") for x in (starts, stops))
            whole = np.r_[0, ends]
            # where words do not begin and end with a token, which an added token may cause, they are asked one by one
            if np.array_equal(whole[first], starts) and np.array_equal(whole[last], stops):
                known.update(zip(some, [raw[a:b] for a, b in zip((4 * first).tolist(), (4 * last).tolist())]))

    def __missing__(self, stretch: str) -> bytes:
        if stretch.isalpha():
            ids = array("I", self._encode(" " + stretch, add_special_tokens=False).ids).tobytes()
        elif stretch[-1:] in (",", ".") and stretch[:-1].isalpha():
            ids = self[stretch[:-1]] + self._part(stretch[-1])
        else:
            whole = stretch if stretch[:1] == "\n" else " " + stretch
            if self._plain(stretch) and not self._added(stretch):
                ids = b"".join([self[p[1:]] if p[:1] == " " and p[1:].isalpha() else self._part(p) for p in self._split(whole)])
            else:
                ids = self._part(whole)
        self[stretch] = ids
        return ids


def _rare(text: str) -> bool:
    """Whether a text has white space other than spaces and line feeds."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _RARE.search(text) is not None
    return any(c in text for c in _RARE_LATIN)  # much faster than the regular expression


def _even(text: str) -> bool:
    """Whether every space, and every line feed, is white space that stands alone between two other characters."""
    return not ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or _rare(text))


def stretches(texts: list[str]) -> tuple[list[str], pa.Array, np.ndarray]:
    """(each text up to its first cut, the stretches after the cuts of all texts, how many of them each text has).

    A text is cut at spaces and before line feeds that stand alone between two other characters; a stretch follows a
    space or begins with a line feed.
    """
    heads, rests, odd = [], [], {}
    for i, text in enumerate(texts):
        if _even(text):
            head, _, rest = text.replace("\n", " \n").partition(" ")
            rests.append(rest or None)
        else:
            head, *odd[i] = _CUT.split(text)
            rests.append(None)
        heads.append(head)
    lists = pc.split_pattern(pa.array(rests, pa.string()), " ")
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    flat = lists.flatten()
    if odd:  # texts with other white space: their stretches go in between
        parts, at, last = [], 0, 0
        for i, found in odd.items():
            n = int(counts[last:i].sum())
            parts += [flat.slice(at, n), pa.array(found, pa.string())]
            at, last, counts[i] = at + n, i + 1, len(found)
        flat = pa.concat_arrays([*parts, flat.slice(at)])
    return heads, flat, counts


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer of the tokenizers library, as little-endian 32-bit bytes.

    Such a tokenizer splits a text before it merges, and no split part holds a space that stands between two other
    characters except as its first character. So a text can be cut before each such space, and a stretch of Latin
    characters into its split parts. The ids of every distinct part come from the library once and are joined.
    """

    def __init__(self, json_text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(json_text)
        split = spec.get("pre_tokenizer") or {}
        if split.get("type") != "ByteLevel" or not split.get("use_regex", True) or split.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("a byte-level tokenizer without a normalizer or a prefix space is needed")
        tokenizer = Tokenizer.from_str(json_text)
        self._parts = _Parts(tokenizer)
        self._inner = _Stretches(tokenizer, self._parts, [t["content"] for t in spec.get("added_tokens", [])])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; each distinct stretch of ``texts`` is looked up once."""
        _trim(self._inner, STRETCHES)
        _trim(self._parts, PARTS)
        heads, flat, counts = stretches(texts)
        coded = flat.dictionary_encode()
        found = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._inner.learn(found)
        ids = list(map(self._inner.__getitem__, found))
        pieces = list(map(ids.__getitem__, coded.indices.to_numpy().tolist()))
        cuts = np.r_[0, np.cumsum(counts)].tolist()
        return [self._parts[head] + b"".join(pieces[a:b]) for head, a, b in zip(heads, cuts, cuts[1:])]


_encoders: dict[int, Encoder] = {}


def encoder(json_text: str) -> Encoder:
    """One encoder for a Python worker and tokenizer."""
    found = _encoders.get(hash(json_text))
    if found is None:
        _encoders.clear()
        found = _encoders[hash(json_text)] = Encoder(json_text)
    return found


def text_groups(texts: pa.Array, size: int = 1 << 22):
    """(from, texts) for runs of rows of about ``size`` characters; null is empty."""
    start, held, n = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.as_py() or "")
        n += len(held[-1])
        if n >= size:
            yield start, held
            start, held, n = i + 1, [], 0
    if held:
        yield start, held


def share_tokenizer(spark: SparkSession, json_text: str | None):
    """The tokenizer's text as a broadcast variable; its size is that of the vocabulary."""
    return spark.sparkContext.broadcast(json_text or tokenizer_json())
