import hashlib
import random
import re

import duckdb

from tidemark.llm import fill_in_middle as fim
from tidemark.llm._scratch import Scratch

SF = "/root/testdata/sf0.01"


def plain(doc_id, text, seed=7, fim_rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= fim_rate:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    form = "spm" if h4 % 100 < spm_rate else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, form, len(pre), len(mid), out, text


def digested(row):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (*row[:5], sha(row[5]), sha(row[6]))


def odd_rows():
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab é\n\n<PSM>😀") for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "\n"), (503, "\n\n\n"), (504, "x"), (505, "a<P>b\n"), (506, "<M>"), (507, "<\nP>\n<S\n>"), (None, "no\nid\n"), (None, "no\nid\n"), (3, "again\n"), (508, "😀" * 50)]
    rows += [(600 + i, "".join(rng.choice("lorem é\n") for _ in range(5000))) for i in range(5)]
    return rows


def test_against_plain_strings_with_small_frames(spark, docs_of):
    rows = odd_rows()
    for size in (1, 7, 64, fim.FRAME):
        stored = fim.store_frames(docs_of(rows), Scratch(spark, "t"), size)
        got = sorted((tuple(r) for r in fim.digests(fim.fill_in_middle(stored)).collect()), key=str)
        assert got == sorted((digested(plain(*r)) for r in rows), key=str)


def test_rates_and_real_texts(spark, docs_of):
    rows = odd_rows()
    outputs = fim.fill_in_middle(fim.store_frames(docs_of(rows), Scratch(spark, "t"), 16), seed=11, fim_rate=60, spm_rate=20)
    got = sorted((tuple(r) for r in fim.output_texts(outputs).collect()), key=str)
    want = [plain(*r, 11, 60, 20) for r in rows]
    assert got == sorted(((w[0], w[2], w[5], w[6]) for w in want), key=str)
    assert len({w[2] for w in want}) == 3


def test_only_cut_frames_are_opened():
    text = "".join(f"line {i} of a long text\n" for i in range(20_000)).encode()
    import zstandard

    row = fim._stored(9, text, zstandard.ZstdCompressor().compress, 1 << 12)
    frames = fim.Frames(row[1], row[2], *row[4:])
    form, _, _, out = fim.transform(9, frames, row[3])
    assert form != "plain" and len(frames.frames) > 100 and len(frames.opened) <= 4
    assert len(set(out) & set(row[6])) >= len(row[6]) - 2
    whole = hashlib.sha256()
    output = fim.Output(out)
    places = output.scan(fim.ORDER[form], whole)
    assert b"".join(output.restored(form, places)) == text


def test_frames_are_one_zstandard_stream(spark, docs_of):
    import io

    import zstandard

    stored = fim.store_frames(docs_of([(1, "a\nbé\n" * 100)]), Scratch(spark, "t"), 32)
    frames = stored.collect()[0].frames
    assert len(frames) > 10
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(b"".join(frames)), read_across_frames=True)
    assert stream.read().decode() == "a\nbé\n" * 100


def test_empty_table_and_clashing_columns(spark, docs_of):
    assert fim.digests(fim.fill_in_middle(fim.store_frames(docs_of([]), Scratch(spark, "t")))).count() == 0
    from pyspark.sql import functions as F

    docs = docs_of([(1, "a\nb")]).withColumns({"n": F.lit("x"), "frames": F.lit(1), "form": F.lit(None)})
    assert tuple(fim.digests(fim.fill_in_middle(fim.store_frames(docs, Scratch(spark, "t")))).first()) == digested(plain(1, "a\nb"))


def test_query_against_sql(spark):
    documents = duckdb.sql(f"SELECT * FROM '{SF}/documents.parquet'")  # noqa: F841
    found = duckdb.sql(fim.ORACLE_SQL)
    got = fim.op13_fill_in_middle(spark, SF)
    assert got.columns == [c[0] for c in found.description]
    assert sorted(map(tuple, got.collect())) == sorted(found.fetchall())
