"""Files of one recording: footers, row groups, publication, and everything that readers refuse."""

import glob
import hashlib
import os
import subprocess

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.sources import artifact_files as A, ranged
from tidemark.sources.artifacts import header_problems, read_embeddings, read_scores

VECTORS = "namespace string, value string, window_start_s double, window_end_s double, embedding array<float>"
SCORES = "namespace string, value string, window_start_s double, window_end_s double, label string, score double"


def header(kind, namespace="n", value="v", **more):
    keys = {"scores": A.FILE_KEYS + A.REGISTRY_KEYS + A.SCORE_KEYS, "embeddings": A.FILE_KEYS + A.EMBEDDING_KEYS, "detections": A.FILE_KEYS + A.REGISTRY_KEYS + A.DETECTION_KEYS}[kind]
    own = dict.fromkeys(keys, "x") | {"contract": A.CONTRACTS[kind].id, "recording_namespace": namespace, "recording_value": value, "score_retention": "full", "embedding_dim": "3", "embedding_storage_dtype": "float32"} | more
    return {A.PREFIX + k: v for k, v in own.items() if v is not None and (k in keys or k in more)}


def headers_of(spark, *rows):
    return spark.createDataFrame(list(rows), "namespace string, value string, header map<string,string>")


def put(path, table, schema, head):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(table.cast(schema), path, store_schema=True) if head is None else pq.write_table(pa.Table.from_arrays(table.columns, schema=schema.with_metadata({k.encode(): v if isinstance(v, bytes) else v.encode() for k, v in head.items()})), path)


def codes(spark, path, kind, *a, **k):
    return {os.path.basename(r.path): r for r in A.verified_files(spark, str(path), kind, *a, **k).collect()}


def test_both_storage_types_come_back_as_written(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = {(v, w): rng.normal(size=3).astype(np.float16 if v % 2 else np.float32) for v in range(4) for w in range(7)}
    rows = spark.createDataFrame([("n/=", f"é {v}", float(w), w + 1.0, [float(x) for x in e]) for (v, w), e in vectors.items()], VECTORS)
    heads = headers_of(spark, *(("n/=", f"é {v}", header("embeddings", "n/=", f"é {v}", embedding_storage_dtype="float16" if v % 2 else "float32")) for v in range(5)))
    A.write_artifacts(rows, heads, str(tmp_path), "embeddings")
    got = {(int(r.value[2:]), int(r.window_start_s)): (r.storage_dtype, r.embedding) for r in read_embeddings(spark, str(tmp_path)).collect()}
    assert set(got) == set(vectors)
    for (v, w), (storage, embedding) in got.items():
        assert storage == ("float16" if v % 2 else "float32") and np.array_equal(np.array(embedding, dtype=np.float32), vectors[v, w].astype(np.float32))
    files = glob.glob(f"{tmp_path}/embeddings/*/*/embeddings.parquet")
    assert len(files) == 5  # a recording without windows has a file too
    fields = [pq.read_schema(f).field("embedding") for f in files]
    assert all(f.type in (pa.list_(pa.float16(), 3), pa.list_(pa.float32(), 3)) and not f.nullable for f in fields) and len({str(f.type) for f in fields}) == 2


def test_embedding_codes(spark, tmp_path):
    def table(kind, width, null=False):
        return pa.schema([pa.field("window_start_s", pa.float64(), False), pa.field("window_end_s", pa.float64(), False), pa.field("embedding", pa.list_(kind, width) if width else pa.list_(kind), null)])

    f32 = table(pa.float32(), 3)
    data = lambda s: pa.Table.from_arrays([pa.array([0.0]), pa.array([1.0]), pa.array([[1, 2, 3][: getattr(s.field(2).type, "list_size", 3)]], s.field(2).type)], schema=s)
    cases = {
        "good": (f32, header("embeddings"), None), "half": (table(pa.float16(), 3), header("embeddings", embedding_storage_dtype="float16"), None),
        "width": (f32, header("embeddings", embedding_dim="4"), "artifact_schema_invalid"), "type": (f32, header("embeddings", embedding_storage_dtype="float16"), "artifact_schema_invalid"),
        "list": (table(pa.float32(), None), header("embeddings"), "artifact_schema_invalid"), "double": (table(pa.float64(), 3), header("embeddings"), "artifact_schema_invalid"),
        "nullable": (table(pa.float32(), 3, True), header("embeddings"), "artifact_schema_invalid"), "dim": (f32, header("embeddings", embedding_dim="²"), "artifact_schema_invalid"),
        "zero": (f32, header("embeddings", embedding_dim="0"), "artifact_schema_invalid"), "huge": (f32, header("embeddings", embedding_dim="2147483648"), "artifact_schema_invalid"),
        "other_type": (f32, header("embeddings", embedding_storage_dtype="int8"), "artifact_schema_invalid"), "contract": (f32, header("embeddings", contract="scores.parquet/1"), "artifact_contract_unexpected"),
        "no_backbone": (f32, header("embeddings", backbone_ref=None), "artifact_metadata_incomplete"), "half_registry": (f32, header("embeddings", registry_uri="u"), "artifact_metadata_incomplete"),
        "registry": (f32, header("embeddings", registry_uri="u", registry_fingerprint="f"), None), "bytes": (f32, header("embeddings") | {A.PREFIX + "recipe": b"\xff"}, "artifact_malformed"),
        "foreign_bytes": (f32, header("embeddings") | {"other.recipe": b"\xff"}, None),
    }
    for name, (schema, head, _) in cases.items():
        put(f"{tmp_path}/{name}.parquet", data(schema), schema, head)
    (tmp_path / "text.parquet").write_text("no parquet")
    put(f"{tmp_path}/bare.parquet", data(f32), f32, {})
    got = codes(spark, tmp_path, "embeddings")
    assert {n[:-8]: r.code for n, r in got.items()} == {n: c for n, (_, _, c) in cases.items()} | {"text": "artifact_malformed", "bare": "artifact_contract_unexpected"}
    with pytest.raises(A.ArtifactRefused, match="artifact_schema_invalid"):
        read_embeddings(spark, str(tmp_path))
    assert read_embeddings(spark, str(tmp_path), refuse=False).count() == 4


def test_score_codes_by_retention(spark, tmp_path):
    schema = A.file_schema("scores", {})
    data = pa.Table.from_arrays([pa.array([0.0, 0.0]), pa.array([1.0, 1.0]), pa.array(["a", "b"]), pa.array([0.5, 0.25])], schema=schema)
    cases = {
        "full": (header("scores"), None), "floor": (header("scores", score_retention="thresholded", score_floor="0.1"), None), "top": (header("scores", score_retention="top_k", score_floor="0.0", score_top_k="5"), None),
        "no_floor": (header("scores", score_retention="thresholded"), "score_floor"), "no_k": (header("scores", score_retention="top_k", score_floor="0"), "score_top_k"), "neither": (header("scores", score_retention="top_k"), "score_floor, score_top_k"),
        "no_registry": (header("scores", registry_uri=None, registry_fingerprint=None), "registry_uri, registry_fingerprint"), "no_domain": (header("scores", score_domain=None), "score_domain"),
    }
    for name, (head, _) in cases.items():
        put(f"{tmp_path}/{name}.parquet", data, schema, head)
    put(f"{tmp_path}/some.parquet", data, schema, header("scores", score_retention="some"))
    nullable = pa.schema([*list(schema)[:3], pa.field("score", pa.float64())])
    put(f"{tmp_path}/nullable.parquet", data.cast(nullable), nullable, header("scores"))
    wide = pa.schema([pa.field("extra", pa.int8()), *list(schema)[::-1]])
    put(f"{tmp_path}/wide.parquet", pa.Table.from_arrays([pa.array([1, 2], pa.int8()), *data.columns[::-1]], schema=wide), wide, header("scores"))
    twice = pa.schema([*schema, schema.field("label")])
    put(f"{tmp_path}/twice.parquet", pa.Table.from_arrays([*data.columns, data.column("label")], schema=twice), twice, header("scores"))
    got = {n[:-8]: (r.code, r.detail) for n, r in codes(spark, tmp_path, "scores").items()}
    for name, (_, missing) in cases.items():
        assert got[name] == ((None, None) if missing is None else ("artifact_metadata_incomplete", missing)), name
    assert got["wide"] == (None, None) and {got[n][0] for n in ("some", "nullable", "twice")} == {"artifact_schema_invalid"}
    rows = read_scores(spark, str(tmp_path), refuse=False)
    assert rows.count() == 8 and {tuple(r)[:2] for r in rows.collect()} == {("n", "v")}


def test_only_footers_are_read(spark, tmp_path):
    n = 400_000
    schema = A.file_schema("scores", {})
    data = pa.Table.from_arrays([pa.array(np.arange(n) * 1.0), pa.array(np.arange(n) + 1.0), pa.array([f"l{i}" for i in range(n)]), pa.array(np.random.default_rng(1).random(n))], schema=schema)
    put(f"{tmp_path}/big.parquet", data, schema, header("scores"))
    row = codes(spark, tmp_path, "scores")["big.parquet"]
    assert row.code is None and row.rows == n and row.length > 5_000_000 and row.bytes_read < 200_000
    digest = "sha256:" + hashlib.sha256((tmp_path / "big.parquet").read_bytes()).hexdigest()
    expected = spark.createDataFrame([(row.path, digest), (row.path + ".gone", digest)], "path string, checksum string")
    both = codes(spark, tmp_path, "scores", expected)
    assert both["big.parquet"].code is None and both["big.parquet"].bytes_read < row.length + 200_000 and both["big.parquet.gone"].code == "artifact_unreadable"
    assert codes(spark, tmp_path, "scores", expected.withColumn("checksum", F.lit("sha256:0")))["big.parquet"].code == "artifact_checksum_mismatch"
    assert codes(spark, tmp_path, "scores", hashed=True)["big.parquet"].checksum == digest
    # nulls of what Spark wrote come from statistics, and from the column where a file has none
    table = pa.table({"namespace": ["n"] * n, "value": ["v"] * n, "window_start_s": data.column(0), "window_end_s": data.column(1), "label": data.column(2), "score": pa.array([None, *range(1, n)], pa.float64())})
    for name, stats in (("with", True), ("without", False)):
        pq.write_table(table, f"{tmp_path}/{name}.parquet", write_statistics=stats)
    got = codes(spark, tmp_path, "scores", form="table")
    assert {got[f"{x}.parquet"].detail for x in ("with", "without")} == {"nulls in score"} and got["with.parquet"].bytes_read < 200_000


def test_footers_have_entries_and_groups(spark, tmp_path):
    rows = spark.range(150_000).select(
        F.lit("n").alias("namespace"), F.lit("v").alias("value"), F.floor(F.col("id") / 7).cast("double").alias("window_start_s"), (F.floor(F.col("id") / 7) + 1).cast("double").alias("window_end_s"), F.lit("l").alias("label"),
        F.lit("taxon").alias("label_kind"), F.lit(0.5).alias("score"), (F.col("id") % 7 + 1).cast("int").alias("rank"), F.lit(None).cast("string").alias("scientific_name"), F.lit("c").alias("common_name"), F.lit(3).cast("long").alias("gbif_taxon_key"),
    )
    head = header("detections")
    A.write_artifacts(rows, headers_of(spark, ("n", "v", head)), str(tmp_path), "detections")
    file = pq.ParquetFile(f"{tmp_path}/{A.artifact_path('detections', 'n', 'v')}")
    assert {k.decode(): v.decode() for k, v in file.schema_arrow.metadata.items()} == head
    groups = [file.metadata.row_group(i).num_rows for i in range(file.metadata.num_row_groups)]
    assert sum(groups) == 150_000 and len(groups) == 3 and all(0 <= g - 65_536 < 7 for g in groups[:-1]) and all(g % 7 == 0 for g in groups[:-1])
    assert A.read_artifacts(spark, str(tmp_path), "detections").count() == 150_000
    found = A.footer_headers(A.verified_files(spark, str(tmp_path), "detections"))
    assert found.first().header == head and header_problems(found, tuple(A.PREFIX + k for k in (*A.FILE_KEYS, "none"))).first().problem == f"missing {A.PREFIX}none"
    many = spark.range(300_000).select(F.lit("n").alias("namespace"), F.lit("w").alias("value"), F.col("id").cast("double").alias("window_start_s"), (F.col("id") + 1).cast("double").alias("window_end_s"), F.array(*[F.lit(1.0)] * 3).alias("embedding"))
    A.write_artifacts(many, headers_of(spark, ("n", "w", header("embeddings", value="w"))), str(tmp_path), "embeddings")
    meta = pq.read_metadata(f"{tmp_path}/{A.artifact_path('embeddings', 'n', 'w')}")
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [87381, 87381, 87381, 37857]


def scores(spark, n=4, score=0.5):
    return spark.createDataFrame([("n", str(i), float(w), w + 1.0, "a", score) for i in range(n) for w in range(3)], SCORES)


def every(root):
    return {os.path.relpath(os.path.join(d, x), root): hashlib.sha256(open(os.path.join(d, x), "rb").read()).hexdigest() for d, _, names in os.walk(root) for x in names}


def test_replay_and_conflict(spark, tmp_path):
    root = str(tmp_path)
    heads = headers_of(spark, *(("n", str(i), header("scores", value=str(i))) for i in range(4)))
    A.write_artifacts(scores(spark), heads, root, "scores")
    before = every(root)
    stamps = {f: os.stat(f"{root}/{f}").st_mtime_ns for f in before}
    assert len(before) == 4
    A.write_artifacts(scores(spark).repartition(7), heads, root, "scores")
    assert every(root) == before and {f: os.stat(f"{root}/{f}").st_mtime_ns for f in before} == stamps
    # one file differs and one is new: nothing is published
    more = headers_of(spark, ("n", "3", header("scores", value="3")), ("n", "new", header("scores", value="new")))
    with pytest.raises(Exception, match="artifact_publication_failed"):
        A.write_artifacts(scores(spark).withColumn("score", F.lit(0.25)).where("value = '3'"), more, root, "scores")
    assert every(root) == before and os.listdir(root) == ["scores"]


def test_killed_tasks_leave_no_file(spark, tmp_path):
    heads = headers_of(spark, *(("n", str(i), header("scores", value=str(i))) for i in range(4)))
    bad = scores(spark).withColumn("score", F.when((F.col("value") == "2") & (F.col("window_start_s") == 2), F.raise_error(F.lit("lost executor"))).otherwise(F.col("score")))
    with pytest.raises(Exception, match="lost executor"):
        A.write_artifacts(bad, heads, str(tmp_path), "scores")
    assert every(tmp_path) == {} and not [x for x in os.listdir(tmp_path) if x.startswith(".staged")]
    A.write_artifacts(scores(spark), heads, str(tmp_path), "scores")
    assert len(every(tmp_path)) == 4


def test_a_faster_writer_wins_or_is_the_same(tmp_path):
    final = tmp_path / A.artifact_path("scores", "n", "v")
    final.parent.mkdir(parents=True)
    final.write_bytes(b"other")
    staged = tmp_path / "staged"
    staged.write_bytes(b"mine")
    file = {"kind": "scores", "key": ("n", "v"), "place": str(staged), "checksum": "sha256:" + hashlib.sha256(b"mine").hexdigest(), "there": None}
    with pytest.raises(A.ArtifactRefused, match="other bytes"):
        A.publish([file], str(tmp_path))
    assert final.read_bytes() == b"other"
    final.write_bytes(b"mine")
    assert A.publish([file], str(tmp_path)) == {"new": 0, "replay": 1}


def test_the_sink_refuses_what_readers_would(spark, tmp_path):
    for head, match in ((header("scores", score_domain=None), "artifact_metadata_incomplete"), (header("scores", value="other"), "another recording"), (header("embeddings"), "artifact_contract_unexpected")):
        with pytest.raises(Exception, match=match):
            A.write_artifacts(scores(spark, 1).withColumn("value", F.lit("v")), headers_of(spark, ("n", "v", head)), str(tmp_path), "scores")
    with pytest.raises(Exception, match="no header"):
        A.write_artifacts(scores(spark, 2), headers_of(spark, ("n", "0", header("scores", value="0"))), str(tmp_path), "scores")
    with pytest.raises(Exception, match="one header"):
        A.write_artifacts(scores(spark, 1), headers_of(spark, *[("n", "0", header("scores", value="0"))] * 2), str(tmp_path), "scores")
    for vector, dtype, match in (([1.0, 2.0], "float32", "not 3 wide"), (None, "float32", "null or not"), ([1e6, 0.0, 0.0], "float16", "out_of_storage_dtype_range")):
        rows = spark.createDataFrame([("n", "v", 0.0, 1.0, vector)], VECTORS)
        with pytest.raises(Exception, match=match):
            A.write_artifacts(rows, headers_of(spark, ("n", "v", header("embeddings", embedding_storage_dtype=dtype))), str(tmp_path), "embeddings")
    assert every(tmp_path) == {}


def test_files_of_any_size_are_hashed(spark, tmp_path):
    big = tmp_path / "big file é.bin"
    with open(big, "wb") as file:  # sparse
        file.seek(3 << 30)
        file.write(b"end")
    for i in range(1, 21):
        (tmp_path / f"{i}.txt").write_bytes(b"x" * i)
    got = {os.path.basename(r.path): (r.length, r.checksum) for r in ranged.file_checksums(spark, str(tmp_path)).collect()}
    assert len(got) == 21 and got[big.name] == ((3 << 30) + 3, "sha256:" + subprocess.run(["sha256sum", big], capture_output=True, text=True).stdout.lstrip("\\").split()[0])
    assert all(got[f"{i}.txt"] == (i, "sha256:" + hashlib.sha256(b"x" * i).hexdigest()) for i in range(1, 21))


def test_tasks_get_about_the_same_bytes(spark):
    rng = np.random.default_rng(2)
    files = spark.createDataFrame([(f"f{i}", int(x)) for i, x in enumerate(rng.lognormal(10, 1.5, 2000))], "path string, length long")
    found = ranged.dealt(files, 8).select("path", "length", F.spark_partition_id().alias("task")).collect()
    assert len({r.path for r in found}) == 2000
    loads = [sum(r.length for r in found if r.task == t) for t in range(8)]
    assert max(loads) < 1.5 * min(loads)
    assert all(a.length >= b.length for a, b in zip(found, found[1:]) if a.task == b.task)


def test_places():
    assert ranged.file_system("file:/a b/c")[1] == "/a b/c" and ranged.file_system("/x:y/z")[1] == "/x:y/z" and ranged.file_system("file:///a%20b")[1] == "/a%20b"
    assert not ranged.opens_in_tasks("viewfs://store/in")


def tasks_of(spark, action):
    """What ``action`` returns and the most tasks that one of its stages has."""
    group = f"tasks-{id(action)}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds]
    return out, [s.numTasks for s in stages if s]


def test_a_tree_is_written_by_many_tasks(spark):
    from tidemark.plans.files import _write_tree

    recordings = spark.range(2000).coalesce(1).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("s/%"), F.col("id") % 3)).alias("namespace"), F.col("id").cast("string").alias("value"), F.lit("u").alias("audio_uri"))
    path, tasks = tasks_of(spark, lambda: _write_tree(spark, {"recordings": recordings}, "tree"))
    assert max(tasks) == 4  # few bytes, so that one task would do for Spark
    files = glob.glob(f"{path}/*/*/*.txt")
    assert len(files) == 30 and sorted(x for f in files for x in open(f).read().splitlines()) == sorted(f"{i} u" for i in range(2000))
    (some,) = glob.glob(f"{path}/site=s%2F%251/day=3/*.txt")
    assert open(some).read() == "".join(f"{i} u\n" for i in range(600, 800) if i % 3 == 1)


def test_a_listing_takes_few_tasks(spark, tmp_path):
    from tidemark.sources import catalogs

    rows = spark.range(150).select(F.format_string("site=a/day=%s/x.txt", "id").alias("place"), F.col("id").cast("string").alias("content"))
    ranged.write_texts(rows, str(tmp_path / "tree"))
    read = lambda: catalogs.folder_catalog(spark, str(tmp_path / "tree"), "n", "site={site}/day={day}/{file}.txt", "{site}/{day}").collect()
    found, tasks = tasks_of(spark, read)
    assert sorted(r.value for r in found) == sorted(f"a/{i}" for i in range(150)) and max(tasks) <= 16  # not one for each folder
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"
