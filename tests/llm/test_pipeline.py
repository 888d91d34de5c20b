import random
import zlib

import corpus_pipeline
import numpy as np
from test_quality_rules import plain_counts, plain_rules
from test_simhash import plain_components, plain_fingerprint
from test_substring_dedup import kept_words

from tokenizers import Tokenizer

from tidemark.llm import quality_rules
from tidemark.llm.tokens import tokenizer_json


def make():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = [word() for _ in range(30)]
    rows = []
    for i in range(160):
        w = [word() for _ in range(rng.randint(30, 400))]
        if i % 9 == 0:
            w[10:10] = passage
        rows.append((i, " ".join(w)))
    rows += [(200 + i, rows[i][1].replace(" ", "\n", 3)) for i in range(0, 60, 3)]
    rows += [(300 + i, rows[i][1] + " tail end") for i in range(1, 60, 3)]
    rows += [(400, None), (401, ""), (402, "### " * 100), (403, rows[0][1] + " " + " ".join(passage))]
    return rows


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_run(rows, labels):
    kept = {r[0] for r in plain_rules([(i, t, "en") for i, t in rows], labels, quality_rules.ALPHA, quality_rules.DELTA) if r[7]}
    docs = [(i, t) for i, t in rows if i in kept]
    first = {}
    for i, t in sorted(docs):
        first.setdefault(" ".join(t.split(" ")).replace("\n", " "), (i, t))
    docs = sorted(first.values())
    fps = {i: signed(plain_fingerprint(t)) for i, t in docs}
    roots = plain_components(sorted(set(fps.values())))
    one = {}
    for i, t in docs:
        one.setdefault(roots[fps[i]], (i, t))
    docs = sorted(one.values())
    texts = {i: t for i, t in docs}
    return {i: " ".join(x for p, x in enumerate(w) if p not in gone) if gone else texts[i] for i, w, gone in kept_words(docs) if not w or len(gone) < len(w)}


def test_run_against_plain_stages(spark, tmp_path):
    rows = make()
    labels = [(i, 1) for i, _ in rows if i < 160]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = plain_run(rows, labels)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(want)
    assert all(plain_counts(t)[0] >= 50 for i, t in rows if i in want)
    # the ids of each document are those of its text after the stages, and the sequences hold them
    tokenizer = Tokenizer.from_str(tokenizer_json())
    pieces = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(pieces.get(r.doc_id, ())) and r.length * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        pieces[r.doc_id] = [*pieces.get(r.doc_id, ()), *np.frombuffer(r.ids, dtype="<u4").tolist()]
    assert pieces == {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in want.items()}
    assert any(t != dict(rows)[i] for i, t in want.items())
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0
    rows = spark.createDataFrame([(None, " ".join(f"w{i}" for i in range(80)), None, None, None), (1, " ".join(f"v{i}" for i in range(80)), "en", "s", 3)], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, str(tmp_path))
        assert rows.columns == docs.columns and rows.count() == 2
