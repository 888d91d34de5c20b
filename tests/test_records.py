"""Records of CSV files against Python's reader, over splits of any size."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import catalogs, records


def splits(spark, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    return before


def found(spark, path, size):
    before = splits(spark, size)
    try:
        return sorted((r.file.rpartition("/")[2], r.record, r.text) for r in records.csv_records(spark, str(path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def cells(text):
    return next(csv.reader(io.StringIO(text, newline="")), [])


@pytest.mark.parametrize("size", [40, 300, 10_000_000])
def test_records_against_the_standard_reader(spark, tmp_path, size):
    rng = random.Random(size)
    texts = {}
    for name in ("a", "b", "c"):
        rows = [[rng.choice(["", "x", 'say "hi"', "a,b", "line\nbreak", '\n"\n', ',"\n",', "long " * 5, 'mid"quote']) for _ in range(rng.randint(1, 4))] for _ in range(60)]
        out = io.StringIO(newline="")
        for row in rows:
            end = rng.choice(["\n", "\r\n"])
            csv.writer(out, lineterminator=end, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])).writerow(row)
            if rng.random() < 0.2:
                out.write(end)
            if rng.random() < 0.3:
                out.write(rng.choice(['mid"quote,b"\n', 'x,"closed"tail,y\n', '"a"b"c,d\n', 'p,q"",r\n']))
        texts[name] = out.getvalue()
        (tmp_path / f"{name}.csv").write_bytes(texts[name].encode())
    got = found(spark, tmp_path, size)
    for name, text in texts.items():
        want = list(csv.reader(io.StringIO(text, newline="")))
        own = [(n, cells(t)) for f, n, t in got if f == f"{name}.csv"]
        assert [n for n, _ in own] == list(range(1, len(want) + 1))
        assert [[c.replace("\r\n", "\n") for c in row] for _, row in own] == [[c.replace("\r\n", "\n") for c in row] for row in want]


def test_problems_name_their_rows_over_splits(spark, tmp_path):
    rows, want = [], {}
    for i in range(2, 2000):
        note = "break\n" * (i % 4)
        bad = {5: ("", "a.wav", "1"), 6: ("x", " ", "1"), 7: ("x", "a.wav", "ten"), 8: ("x", "a.wav", "-1"), 9: ("x", "file:odd", "1")}.get(i % 100)
        rows.append([note, *(bad or (str(i), "a b.wav", str(i)))])
        if bad:
            want[i] = ("blank_id", "blank_audio", "bad_duration", "bad_duration", "bad_uri")[i % 100 - 5]
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\n").writerows([["note", "id", "audio", "seconds"], *rows])
    (tmp_path / "list.csv").write_text("﻿" + out.getvalue())
    before = splits(spark, 500)
    try:
        got = catalogs.csv_catalog(spark, str(tmp_path / "list.csv"), "n", "id", "audio", "seconds").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.row: r.problem for r in got if r.problem} == want
    assert sorted((r.row, r.value, r.audio_uri, r.duration_seconds) for r in got if not r.problem) == [(i, str(i), f"file://{tmp_path}/a%20b.wav", float(i)) for i in range(2, 2000) if i not in want]


def test_headers(spark, tmp_path):
    for name, text in (("none", "\n"), ("twice", "id,audio,id\n1,a,2\n"), ("missing", "id,other\n1,a\n")):
        (tmp_path / f"{name}.csv").write_text(text)
        with pytest.raises(catalogs.CatalogRefused):
            catalogs.csv_catalog(spark, str(tmp_path / f"{name}.csv"), "n", "id", "audio")
    for name, head in (("p", "id,audio"), ("q", "audio,id")):
        (tmp_path / "many").mkdir(exist_ok=True)
        (tmp_path / "many" / f"{name}.csv").write_text(f"{head}\n1,/a\n")
    with pytest.raises(catalogs.CatalogRefused, match="different headers"):
        catalogs.csv_catalog(spark, str(tmp_path / "many"), "n", "id", "audio")
    (tmp_path / "wide.csv").write_text('"the\nid",audio\n"1\n2",s3://b/k\n')
    row = catalogs.csv_catalog(spark, str(tmp_path / "wide.csv"), "n", "the\nid", "audio").first()
    assert (row.row, row.value, row.audio_uri, row.problem) == (2, "1\n2", "s3://b/k", None)


def test_states_compose(spark):
    rng = random.Random(1)
    maps = [(rng.random() < 0.5, rng.random() < 0.5) for _ in range(300)]
    rows = spark.createDataFrame([(i // 50, i, a, b) for i, (a, b) in enumerate(maps)], "g int, i int, out0 boolean, out1 boolean")
    got = {r.i: (r.in0, r.in1, r.all0, r.all1) for r in records.composed(rows, ["g"], ["i"]).collect()}
    for g in range(6):
        for start in (False, True):
            state = start
            for i in range(50 * g, 50 * g + 50):
                assert got[i][start] == state
                state = maps[i][state]
                assert got[i][2 + start] == state
