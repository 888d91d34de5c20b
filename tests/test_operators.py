import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import accept, coverage, embeddings, geometry, lineage, paging, retention
from tidemark.sources import artifacts, catalogs, manifests


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_top_k_with_ties_against_a_full_sort(spark):
    rng = random.Random(0)
    labels = [f"L{i}" for i in rng.sample(range(100), 30)]
    rows = [("n", "v", float(w), float(w + 3), label, rng.choice([0, 0.25, 0.5, 0.75, 1])) for w in range(40) for label in labels]
    scores = spark.createDataFrame([tuple(map(float, r[2:4])) + r[4:5] + (float(r[5]),) + r[:2] for r in rows], "window_start_s double, window_end_s double, label string, score double, namespace string, value string")
    arrays = spark.createDataFrame([("n", "v", float(w), float(w + 3), [float(r[5]) for r in rows if r[2] == w]) for w in range(40)], "namespace string, value string, window_start_s double, window_end_s double, scores array<double>")
    for k in (1, 2, 5, 9, 30):
        got = {(r.window_start_s, r.label) for r in retention.retain_top_k(scores, k, 0.25).collect()}
        by_array = {(r.window_start_s, r.label) for r in retention.retain_top_k_array(arrays, F.array(*map(F.lit, labels)), k, 0.25).collect()}
        want = set()
        for w in range(40):
            mine = sorted((-r[5], r[4]) for r in rows if r[2] == w and r[5] >= 0.25)[:k]
            want |= {(float(w), label) for _, label in mine}
        assert got == by_array == want


@pytest.mark.parametrize("duration, win, overlap, pad, n", [(30, 3, 0, "drop", 10), (30, 3, 1, "drop", 14), (1.5, 3, 0, "drop", 0), (1.5, 3, 0, "centre_crop_end_pad", 1), (9.0, 3, 0, "time_scaled", 3), (9.1, 3, 0, "time_scaled", 4), (0.3 * 7, 0.3, 0, "drop", 7), (None, 3, 0, "drop", None)])
def test_window_count(spark, duration, win, overlap, pad, n):
    column = geometry.window_count(F.lit(duration).cast("double"), F.lit(float(win)), F.lit(float(overlap)), F.lit(pad))
    assert one(spark, column) == n


def test_exact_grid(spark):
    assert one(spark, geometry.on_exact_grid(F.lit(0.5), 2)) and not one(spark, geometry.on_exact_grid(F.lit(0.1), 2))


def test_first_failing_check_wins(spark):
    schema = "namespace string, value string, arrival long, window_start_s double, window_end_s double, scores array<double>, embedding array<float>, duration_seconds double"
    fine = ([0.5, 0.5], [1.0])
    rows = [
        ("n", "good", 0, 0.0, 3.0, *fine, 9.0), ("n", "good", 1, 3.0, 6.0, *fine, 9.0),
        ("n", "nan", 0, 0.0, 3.0, [math.nan, 2.0], [1.0], 9.0),
        ("n", "order", 0, 3.0, 6.0, *fine, 9.0), ("n", "order", 1, 0.0, 3.0, [9.0], [1.0], 9.0), ("n", "order", 2, 0.0, 3.0, *fine, 9.0),
        ("n", "inf", 0, 0.0, math.inf, *fine, 9.0), ("n", "width", 0, 0.0, 3.0, [0.5, 0.5], [1.0, 2.0], None), ("n", "none", 0, 0.0, 3.0, [0.5, 0.5], None, 9.0),
        ("n", "short", 0, 0.0, 3.0, [0.5], [1.0], 9.0), ("n", "out", 0, 9.0, 12.0, *fine, 9.0), ("n", "emb", 0, 0.0, 3.0, [0.5, 0.5], [math.nan], 9.0),
    ]
    coded = accept.window_codes(spark.createDataFrame(rows, schema), 3.0, 3.0, True, 2, 1)
    got = {r.value: (r.code, r.arrival) for r in accept.recording_failures(coded).collect()}
    assert got == {
        "nan": ("score_out_of_domain", 0), "order": ("window_out_of_order", 1), "inf": ("window_bounds_invalid", 0), "width": ("malformed_embedding", 0), "none": ("malformed_embedding", 0),
        "short": ("incomplete_full_scores", 0), "out": ("window_outside_recording", 0), "emb": ("embedding_not_finite", 0),
    }
    assert {r.value for r in accept.accepted(coded).collect()} == {"good"}


def test_versions_order(spark):
    rows = [(0, {"a": 9}), (1, {"a": 1, "b": 1}), (2, {"bb": 1, "a": 1}), (3, {"a": 10}), (4, {})]
    frame = spark.createDataFrame(rows, "i int, v map<string,bigint>")
    assert [r.i for r in frame.orderBy(lineage.versions_key(F.col("v"))).collect()] == [4, 0, 3, 1, 2]


def test_pages_are_stable_and_cursors_are_bound(spark):
    rows = spark.range(25).select(F.col("id"), (F.col("id") % 4).alias("k"))
    seen, cursor = [], None
    while True:
        page, cursor = paging.next_page(rows, ["k", "id"], "rows", {"x": 1}, 7, cursor)
        seen += [(r.k, r.id) for r in page]
        if cursor is None:
            break
    assert seen == sorted((i % 4, i) for i in range(25))
    _, cursor = paging.next_page(rows, ["k", "id"], "rows", {"x": 1}, 7)
    for list_name, filters, given in (("rows", {"x": 2}, cursor), ("other", {"x": 1}, cursor), ("rows", {"x": 1}, "%%%"), ("rows", {"x": 1}, "é")):
        with pytest.raises(paging.PageRefused):
            paging.next_page(rows, ["k", "id"], list_name, filters, 7, given)
    place = paging.Cursor("rows", {})
    key = [None, -5, 0.1, "é|", datetime.datetime(2024, 1, 2, 3, 4, 5, 6), datetime.date(2024, 1, 2)]
    assert place.read(place.write(key), 6) == key
    for broken in (place.write(key)[:-2], place.write(key)[:-1] + "x", "02" + place.write(key)[2:], ""):
        with pytest.raises(paging.PageRefused):
            place.read(broken, 6)
    for limit in (0, 1001):
        with pytest.raises(paging.PageRefused):
            paging.keyset_page(rows, ["id"], limit)
    with pytest.raises(paging.PageRefused):
        paging.recordings_filter(rows, state="unknown")


def test_times_need_a_zone(spark):
    for kind in ("timestamp_ntz", "timestamp"):
        runs = spark.createDataFrame([("2024-01-01T00:30:00",), ("2023-12-31T22:59:59",)], "t string").select((F.col("t") if kind == "timestamp_ntz" else F.concat("t", F.lit("Z"))).cast(kind).alias("created_at"))
        assert paging.runs_filter(runs, created_after="2024-01-01T01:00:00+02:00").count() == 1
        for text in ("2024-01-01T01:00:00", "yesterday"):
            with pytest.raises(paging.PageRefused):
                paging.runs_filter(runs, created_after=text)


def test_head_takes_any_vector(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (1, None), (2, [1.0]), (3, [0.0, None]), (4, [])], "i int, embedding array<float>")
    got = {r.i: (r.logits, r.code) for r in embeddings.linear_head(rows, [[1.0], [10.0]], [0.5], ["i"]).collect()}
    assert got[0] == ([21.5], None) and got[3] == ([None], None)
    assert got[1] == (None, "embedding_missing") and got[2] == got[4] == (None, "head_input_width_mismatch")


def test_strict_lines(spark, tmp_path):
    good = '"namespace":"n","value":"v","audio_uri":"s3://a/b"'
    lines = {
        "{%s}" % good: None, "{%s,\"duration_seconds\":2}" % good: None, "{%s,\"duration_seconds\":null}" % good: None, " {%s} " % good: None, '{"namespace":"\\ud83d\\ude00","value":"v","audio_uri":"s3://a/b"}': None,
        '{"namespace":5,"value":"v","audio_uri":"s3://a/b"}': "not_text", '{"namespace":"n","value":["x"],"audio_uri":"s3://a/b"}': "not_text", '{"namespace":"n","value":null,"audio_uri":"s3://a/b"}': "missing_text",
        "{%s} tail" % good: "not_an_object", "{%s}{}" % good: "not_an_object", "{%s},{}" % good: "not_an_object", "{%s}] {}" % good: "not_an_object", "{%s}} {" % good: "not_an_object", "[{%s}]" % good: "not_an_object",
        "{%s,\"duration_seconds\":\"60\"}" % good: "bad_duration", "{%s,\"duration_seconds\":true}" % good: "bad_duration", "{%s,\"duration_seconds\":1e400}" % good: "bad_duration", "{%s,\"duration_seconds\":0}" % good: "bad_duration",
        '{"namespace":"\\ud800","value":"v","audio_uri":"s3://a/b"}': "lone_surrogate", '{"namespace":"\\u0000","value":"v","audio_uri":"s3://a/b"}': "missing_text", "   ": "blank_line", "{%s,\"embeddings\":1}" % good: "unknown_key",
    }
    raw = "\n".join(lines).encode() + b"\n\xff\xfe{}\n"
    (tmp_path / "list.jsonl").write_bytes(raw)
    got = {r.line: r.problem for r in manifests.recordings_jsonl(spark, str(tmp_path / "list.jsonl")).collect()}
    assert got == {**dict(enumerate(lines.values(), 1)), len(lines) + 1: "not_utf8"}
    (tmp_path / "bom.jsonl").write_bytes(b"\xef\xbb\xbf{%s}" % good.encode())
    assert [r.problem for r in manifests.recordings_jsonl(spark, str(tmp_path / "bom.jsonl")).collect()] == ["byte_order_mark"]


def test_wrong_tables_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([("n", "v", 0.0, 3.0, "a", 0.5)], artifacts.SCORES)
    read = lambda *a, **k: artifacts.read_scores(spark, *a, form="table", **k)
    artifacts.write_scores(rows, f"{tmp_path}/s")
    assert read(f"{tmp_path}/s").count() == 1
    sums = catalogs.file_checksums(spark, f"{tmp_path}/s", "*.parquet").select("path", "checksum").cache()
    assert read(f"{tmp_path}/s", sums).count() == 1
    for wrong, code in ((sums.withColumn("checksum", F.lit("sha256:0")), "artifact_checksum_mismatch"), (sums.unionByName(sums.withColumn("path", F.concat("path", F.lit("x")))), "artifact_unreadable")):
        with pytest.raises(artifacts.ArtifactRefused, match=code):
            read(f"{tmp_path}/s", wrong)
    rows.drop("score").write.parquet(f"{tmp_path}/t")
    with pytest.raises(artifacts.ArtifactRefused, match="artifact_schema_invalid"):
        read(f"{tmp_path}/t")
    assert read(f"{tmp_path}/t", refuse=False).count() == 0
    rows.withColumn("score", F.lit(None).cast("double")).write.parquet(f"{tmp_path}/u")
    with pytest.raises(artifacts.ArtifactRefused, match="artifact_malformed: nulls in score"):
        read(f"{tmp_path}/u")


def test_empty_registries_are_refused(spark, tmp_path):
    for name, text in (("a", "class_index,label,label_kind\n"), ("b", "class_index,label,label,label_kind\n0,x,y,unresolved\n"), ("c", "label\nx\n")):
        (tmp_path / f"{name}.csv").write_text(text)
        with pytest.raises(catalogs.CatalogRefused):
            catalogs.registry_csv(spark, str(tmp_path / f"{name}.csv"))


def test_empty_lists_are_refused(spark, tmp_path):
    (tmp_path / "none.jsonl").write_text("\n\n")
    with pytest.raises(manifests.ManifestRefused):
        manifests.manifest_problems(manifests.recordings_jsonl(spark, str(tmp_path / "none.jsonl")))
    with pytest.raises(manifests.ManifestRefused):
        manifests.manifest_problems(manifests.uri_list(spark, str(tmp_path / "none.jsonl"), "n"))
    (tmp_path / "blank.jsonl").write_text("  \n")
    assert [r.problem for r in manifests.manifest_problems(manifests.recordings_jsonl(spark, str(tmp_path / "blank.jsonl"))).collect()] == ["blank_line"]


def test_registries_have_the_fingerprint_of_their_bytes(spark, tmp_path):
    import hashlib

    (tmp_path / "r.csv").write_text("class_index,label,label_kind\n0,x,non_taxonomic\n1,é,non_taxonomic\n")
    got = {r.fingerprint for r in catalogs.registry_csv(spark, str(tmp_path / "r.csv")).collect()}
    assert got == {"sha256:" + hashlib.sha256((tmp_path / "r.csv").read_bytes()).hexdigest()}
    (tmp_path / "s.csv").write_text("class_index,label,label_kind\n0,x,non_taxonomic\n")
    with pytest.raises(catalogs.CatalogRefused):
        catalogs.registry_csv(spark, str(tmp_path))


def test_results_need_their_requests(spark):
    results = spark.createDataFrame([(1, "u", "f", "s", "d"), (2, "u", None, None, None), (3, None, None, None, None), (4, None, "f", "s", None), (5, None, None, None, None)], "task_id long, registry_uri string, registry_fingerprint string, resolved_scores_request string, resolved_detection_policy string")
    artifacts_ = spark.createDataFrame([(1, "scores"), (1, "detections"), (2, "embeddings"), (3, "scores"), (3, "scores"), (4, "detections")], "task_id long, kind string")
    got = sorted(map(tuple, coverage.request_problems(results, artifacts_).collect()))
    assert got == [(2, "half_registry_binding"), (3, "scores_without_request"), (4, "detections_without_policy"), (4, "half_registry_binding")]


def test_versions_meet_in_a_map_or_in_a_join(spark, monkeypatch):
    results = spark.createDataFrame([(1, "n", "a", {"m": 1, "h": 2}), (2, "n", "b", {"m": 2}), (3, "n", "c", {})], "run_id long, namespace string, value string, output_versions map<string,bigint>")
    highest = spark.createDataFrame([("m", 2)], "version_id string, highest bigint")
    for most in (1000, 0):
        monkeypatch.setattr(lineage, "MOST_IDS", most)
        assert {r.run_id: r.up_to_date for r in lineage.up_to_date(results, highest).collect()} == {1: False, 2: True, 3: True}


def test_chunks_number_a_run_over_parts(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("run_id"), F.lit("n").alias("namespace"), F.lpad(F.col("id").cast("string"), 5, "0").alias("value"))
    got = sorted((r.run_id, r.value, r.task) for r in lineage.task_chunks(rows, 7).collect())
    assert [g[2] for g in got] == [i // 7 for i in range(500)] * 2


def test_text_functions(spark):
    assert one(spark, T.percent_encode(F.lit("a b/~*é+%"))) == "a%20b%2F~%2A%C3%A9%2B%25"
    for given, uri in (("/a b", "file:///a%20b"), ("file:///a%20b", "file:///a%20b"), ("file:///a b", None), ("S3://x", "S3://x"), ("rel", None)):
        assert one(spark, T.audio_uri(F.lit(given))) == uri
    assert one(spark, T.audio_uri(F.lit("x/y.wav"), F.lit("/base/"))) == "file:///base/x/y.wav"
    for number in (0.0, -0.0, 1.0, 0.1, 12345.678, 1e7, 123456789.0, 3.0e15, -2.5e8 // 1):
        assert one(spark, T.double_text(F.lit(number))) == repr(number + 0.0)
    assert one(spark, T.json_text(F.lit('a"\\é\n'))) == '"a\\"\\\\é\\n"'
    assert not one(spark, T.storable(F.lit("a\x00"))) and not one(spark, T.storable(F.lit(None).cast("string")))
    for uri, below in (("s3://b/r/x", True), ("s3://b/r", False), ("s3://b/r/../x", False), ("s3://c/r/x", False), ("s3://b/r//x", False)):
        assert one(spark, T.under_root(F.lit(uri), F.lit("s3://b/r/"))) is below
    with pytest.raises(ValueError):
        T.selection_test(F.col("a"), 3)
    with pytest.raises(ValueError):
        T.canonical_number(math.inf)


def test_half_precision(spark):
    rows = spark.createDataFrame([([1.0, 65519.0],), ([65520.0],), ([float("inf")],), ([1e-9],)], "e array<double>")
    codes = [r[0] for r in rows.select(embeddings.narrow_code(F.col("e"), half=True)).collect()]
    assert [c is not None for c in codes] == [False, True, False, False]
    assert [r[0] for r in rows.select(embeddings.narrow_half(F.col("e"))).collect()] == [[1.0, 65504.0], [math.inf], [math.inf], [0.0]]
    rng = np.random.default_rng(0)
    wide = np.r_[rng.normal(size=300), rng.normal(size=100) * 1e-6, rng.normal(size=100) * 2e4, 0.0, -0.0, 2.0**-24, 2.0**-25, 3 * 2.0**-25, 65504.0]
    (got,) = spark.createDataFrame([(wide.tolist(),)], "e array<double>").select(embeddings.narrow_half(F.col("e"))).first()
    assert np.array_equal(np.array(got), wide.astype(np.float16).astype(np.float64))
    assert [r[0] is not None for r in spark.createDataFrame([([1e39],), ([1e38],)], "e array<double>").select(embeddings.narrow_code(F.col("e"), half=False)).collect()] == [True, False]


def test_sigmoids(spark):
    logits = [-800.0, -20.0, 0.0, 3.0, 800.0]
    column = F.array(*map(F.lit, logits))
    assert np.allclose(one(spark, embeddings.sigmoid(column)), [0, 1 / (1 + math.exp(20)), 0.5, 1 / (1 + math.exp(-3)), 1])
    assert np.allclose(one(spark, embeddings.sigmoid(column, 15.0))[:2], [1 / (1 + math.exp(15))] * 2)


def test_folder_templates():
    regex, fields = catalogs.template_regex("{site}/{day}/x.{site}.wav")
    assert regex == r"^([^/]+)/([^/]+)/x\.\1\.wav$" and fields == ["site", "day"]


def test_catalog_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,audio,id\n1,x,2\n")
    with pytest.raises(catalogs.CatalogRefused):
        catalogs.csv_catalog(spark, str(tmp_path / "a.csv"), "n", "id", "audio")
    (tmp_path / "b.csv").write_text("﻿id,audio,secs\n1,x,\n2,y,1.5\n3\n")
    got = [(r.row, r.value, r.audio_uri, r.duration_seconds, r.problem) for r in catalogs.csv_catalog(spark, str(tmp_path / "b.csv"), "n", "id", "audio", "secs").collect()]
    assert got == [(2, "1", f"file://{tmp_path}/x", None, None), (3, "2", f"file://{tmp_path}/y", 1.5, None), (4, "3", "", None, "blank_audio")]


def test_line_numbers_hold_over_splits(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("".join(f"line {i}\r\n" for i in range(1, 20_001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        wrong = manifests.numbered_lines(spark, str(tmp_path / "lines.txt")).where("text <> concat('line ', line)").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert wrong == 0


def test_publishing_twice_is_refused(spark, tmp_path):
    rows = spark.createDataFrame([("n", "v", 0.0, 3.0, "a", 0.5)], artifacts.SCORES)
    artifacts.write_scores(rows, f"{tmp_path}/s")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        artifacts.write_scores(rows, f"{tmp_path}/s")


def test_unknown_models_are_named(spark):
    with pytest.raises(KeyError, match="no model"):
        embeddings.run_model("none/1", spark.range(1), "id long")


def test_detail_is_cut(spark):
    rows = spark.createDataFrame([("n", "v", "c", "infer", 0.0, "x" * 5000)], "namespace string, value string, code string, stage string, window_start_s double, detail string")
    assert len(coverage.failure_rows(rows).first().detail) == 2000


def test_recordings_of_a_large_task_are_not_compared_pair_by_pair(spark):
    import time

    kind = "array<struct<namespace:string,value:string>>"
    n = 60_000
    ids = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(F.lit("n").alias("namespace"), i.cast("string").alias("value")))
    odd = [("n", None), (None, None), ("n", 'a"b\\'), ("é\n", "\u2028 "), None]
    more = F.array(*(F.lit(None).cast(kind[6:-1]) if r is None else F.struct(F.lit(r[0]).cast("string").alias("namespace"), F.lit(r[1]).cast("string").alias("value")) for r in odd))
    row = lambda recordings: spark.range(1).select(F.col("id").alias("task_id"), F.lit("f").alias("work_file_digest"), F.lit("w").alias("work_digest"), recordings.cast(kind).alias("recordings"), F.lit(True).alias("under_root"))
    began = time.monotonic()
    tasks, results = row(F.concat(ids, more, more)), row(F.filter(ids, lambda r: r["value"] != "7"))
    (found,) = coverage.task_result_problem(results, tasks).collect()
    (other,) = coverage.task_result_problem(tasks, results.drop("under_root")).collect()
    assert time.monotonic() - began < 25  # pairs take minutes
    text = lambda rows: sorted(str(None if r is None else tuple(r)) for r in rows)
    want = sorted(str(r) for r in [("n", "7"), *odd])
    assert (found.problem, text(found.missing), found.extra) == ("other_recordings", want, []) and (other.missing, text(other.extra)) == ([], want)
    assert coverage.task_result_problem(tasks, tasks.drop("under_root")).count() == 0
