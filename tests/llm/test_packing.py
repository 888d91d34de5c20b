import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import packing, tokens
from tidemark.llm.packing import fit_counts, pack_documents, plan_sequences
from tidemark.llm.tokens import Encoder, tokenizer_json

ODD = ["", " ", "  a", "a  b", "x\n\ny", "a \n b", "end ", "\tq", "it's   we'll don't", "<|endoftext|> a <|endoftext|>", "é ü  z", "a\x1c b \x1dc", "1 234  5", "word.\nNext word", "a then, they'll (now) ×2÷ª º¹ x's.\nIt", "a \x85b \xa0c b\x1fc", "日本 語 "]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(tokenizer_json())


def test_encoder_equals_the_library(tokenizer):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("abs' \n\t.é1,") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in Encoder(tokenizer_json()).encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_with_a_full_cache(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "STRETCHES", 5)
    monkeypatch.setattr(tokens, "PARTS", 3)
    e = Encoder(tokenizer_json())
    for text in ["a b c", "a b c d e f g h i", "h i j a"]:
        assert np.frombuffer(e.encode([text])[0], dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=64))
def test_plan_uses_each_piece_once(histogram):
    used = defaultdict(int)
    for content, n in plan_sequences(histogram, 64):
        assert sum(content) <= 64 and n > 0
        for length in content:
            used[length] += n
    assert dict(used) == histogram


def test_plan_is_close_to_the_least():
    rng = np.random.default_rng(0)
    lengths, n = np.unique(np.clip(rng.lognormal(6.5, 0.9, 200_000).astype(int), 1, 2048), return_counts=True)
    plan = plan_sequences(dict(zip(lengths.tolist(), n.tolist())))
    least = -(-int((lengths * n).sum()) // 2048)
    assert sum(k for _, k in plan) <= least * 1.002


def test_fit_is_not_negative_and_fits():
    counts = np.zeros(11, dtype=np.int64)
    counts[[7, 3, 5]] = 30, 30, 40
    assert np.allclose(fit_counts([(7, 3), (5, 5)], counts), [30, 20])


def test_documents(docs_of, tokenizer):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "of", "Zq9"]) for _ in range(rng.choice([3, 50, 700, 900])))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "of " * 5000), (None, "x y"), (3, rows[3][1]), (503, "a" * 40_000)]
    got = pack_documents(docs_of(rows).withColumns({"length": F.lit(1), "rank": F.lit(2), "salt": F.lit(3)})).collect()
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        cut = [0, len(ids)] if len(ids) <= 2048 else [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for k, (a, b) in enumerate(zip(cut, cut[1:]))]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    spaces = []
    for length in sorted((r.length for r in got), reverse=True):
        fits = [x for x in spaces if x >= length]
        if fits:
            spaces.remove(min(fits))
        spaces.append(min(fits, default=2048) - length)
    assert len(by) <= len(spaces)
    assert pack_documents(docs_of([])).count() == 0


def test_sequences_hold_the_ids(docs_of, tokenizer):
    rows = [(i, "alpha of Zq9 " * n) for i, n in enumerate([1, 40, 300, 900, 2500])] + [(9, None), (None, "x y"), (None, "x y")]
    packed = pack_documents(docs_of(rows))
    got = packing.sequences(packed).collect()
    docs = defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == sum(p.length for p in r.pieces) <= 2048
        for p in r.pieces:
            docs[p.doc_id].append((p.piece, ids[p.offset : p.offset + p.length]))
    whole = {i: [x for _, part in sorted(parts) for x in part] for i, parts in docs.items()}
    assert whole.pop(None) == 2 * (tokenizer.encode("x y", add_special_tokens=False).ids + [0])
    assert whole == {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows if i is not None}
