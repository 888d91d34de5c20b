import random
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm._scratch import Scratch
from tidemark.llm.token_files import encode_levels, read_token_files, read_tokens, write_token_files
from tidemark.llm.tokens import tokenizer_json


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.data())
def test_any_stretch_reads_back(ids, data):
    parts = encode_levels(np.array(ids, dtype=np.uint32))
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert read_tokens(*parts, a, b).tolist() == ids[a:b]
    assert read_tokens(*parts, 0, len(ids)).tolist() == ids


def test_round_trip_of_documents(spark, docs_of):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json())
    rng = random.Random(6)
    rows = [(i * 7 % 211, " ".join(rng.choice(["alpha", "of", "Zq9é"]) for _ in range(rng.randint(0, 300)))) for i in range(200)]
    rows += [(900, None), (901, ""), (None, "first"), (902, "of " * 90_000)]
    extra = docs_of(rows, 6).withColumns({"part": F.lit(1), "tie": F.lit(2), "first": F.lit(3)})
    got = sorted(map(tuple, read_token_files(write_token_files(extra, Scratch(spark, "t"), segment_tokens=2000)).collect()), key=lambda r: r[1])
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert read_token_files(write_token_files(docs_of([]), Scratch(spark, "e"))).count() == 0


def test_any_token_and_any_stretch_of_the_files(spark, docs_of):
    from tokenizers import Tokenizer

    from tidemark.llm.token_files import document_tokens, tokens_at

    tokenizer = Tokenizer.from_str(tokenizer_json())
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["alpha", "of", "Zq9é"]) for _ in range(rng.randint(0, 200)))) for i in range(120)] + [(500, "of " * 40_000), (7, "twice")]
    files = write_token_files(docs_of(rows, 6), Scratch(spark, "t"), segment_tokens=3000)
    assert files.count() > 5
    everything, by_doc = [], {}
    for row in sorted(read_token_files(files).collect(), key=lambda r: r.start):
        texts = [t for i, t in rows if i == row.doc_id]
        ids = next(x for t in texts if len(x := tokenizer.encode(t, add_special_tokens=False).ids + [2]) == row.n_tokens)
        everything += ids
        by_doc.setdefault(row.doc_id, []).append(ids)
    wanted = [rng.randrange(len(everything)) for _ in range(300)] + [0, len(everything) - 1]
    frame = spark.createDataFrame([(p,) for p in [*wanted, wanted[0], len(everything), -1, 10**15]] + [(None,)], "position long")
    assert {r.position: r.token for r in tokens_at(files, frame).collect()} == {p: everything[p] for p in wanted}
    stretches = [(i, a, a + rng.randint(0, 50)) for i in (0, 5, 7, 60, 119) for a in (0, 1, 17, 190)] + [(500, 39_000, 39_900), (500, 79_990, 10**6), (999, 0, 5), (None, 0, 1), (3, None, 4), (3, -1, 4), (3, 5, 2)]
    got = sorted((r.doc_id, r.start, r.stop, r.tokens) for r in document_tokens(files, spark.createDataFrame(stretches, "doc_id long, start long, stop long")).collect())
    want = sorted((i, a, b, ids[a:b]) for i, a, b in stretches if i is not None and a is not None and a >= 0 for ids in by_doc.get(i, []))
    assert got == want
    none = write_token_files(docs_of([]), Scratch(spark, "e"))
    assert tokens_at(none, frame).count() == 0 and document_tokens(none, spark.createDataFrame(stretches, "doc_id long, start long, stop long")).count() == 0
