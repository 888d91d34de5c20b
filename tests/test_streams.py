"""Streams against the operators on tables, and what is left of their state."""

import random

from pyspark.sql import functions as F

from tidemark.operators import accept, coverage
from tidemark.streaming import windows as W

ROWS = "namespace string, value string, kind string, arrival long, window_start_s double, window_end_s double, row_code string"
COUNTED = "namespace string, value string, kind string, arrival long, window_start_s double, window_end_s double, kept long, has_embedding boolean, detection_rows long, zero_window_reason string, input_checksum string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def run(spark, tmp_path, name, batches, schema, operator, mode):
    """Each list of rows is one batch; returns (rows with their batch, rows of state after the last batch)."""
    source, out = f"{tmp_path}/{name}-in", f"{tmp_path}/{name}-out"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{source}/b{i:03}")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        states = []
        for i in range(len(batches)):  # one batch after another
            stream = spark.readStream.schema(schema).parquet(f"{source}/b00[0-{i}]" if i < 10 else f"{source}/b*")
            write = lambda df, n, i=i: df.withColumn("batch", F.lit(i)).write.mode("append").parquet(out)
            query = operator(stream).writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{tmp_path}/{name}-state").trigger(availableNow=True).start()
            query.awaitTermination()
            states.append(sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"]))
    finally:
        spark.conf.set(PROVIDER, before)
    return spark.read.parquet(out).collect(), states


def test_windows_of_a_head_against_the_operator_on_tables(spark, tmp_path):
    rng = random.Random(5)
    batches, got, want = [[], [], [], []], [], []
    for v in range(40):
        key = ("n", str(v))
        rows = [(float(i), float(i + 1)) for i in range(rng.randint(0, 9))]
        windows = list(rows)
        for _ in range(rng.choice([0, 0, 1, 2])):
            kind = rng.randint(0, 3)
            if windows and kind == 0:
                del windows[rng.randrange(len(windows))]
            elif windows and kind == 1:
                i = rng.randrange(len(windows))
                windows[i] = (windows[i][0], windows[i][1] + 0.5)
            elif kind == 2:
                windows.append((100.0, 101.0))
            elif windows:
                windows.insert(rng.randrange(len(windows)), windows[-1])
        want += [(*key, i, *r) for i, r in enumerate(rows)]
        got += [(*key, i, *w) for i, w in enumerate(windows)]
        cut = sorted(rng.randint(0, len(windows)) for _ in range(2))
        split = rng.randint(0, len(rows))
        at = [("begin", -100, None, None)] + [("expected", i - 90, *r) for i, r in enumerate(rows)]
        early, late = at[: split + 1], at[split + 1 :]
        wins = [("window", i, *w) for i, w in enumerate(windows)]
        for batch, part in zip(batches, (early, late + wins[: cut[0]], wins[cut[0] : cut[1]], wins[cut[1] :] + [("end", 1000, None, None)])):
            batch += [(*key, *p, None) for p in part]
    for batch in batches:
        rng.shuffle(batch)
    rows, states = run(spark, tmp_path, "head", batches, ROWS, W.accept_window_stream, "update")
    final = {r.value: (r.accepted, r.code) for r in rows if r.closed}
    problems = accept.expected_problems(spark.createDataFrame(got, "namespace string, value string, arrival long, window_start_s double, window_end_s double"), spark.createDataFrame(want, "namespace string, value string, position long, window_start_s double, window_end_s double"))
    table = {r.value: (r.row - 1, r.code) for r in problems.collect()}
    lengths = {str(v): sum(g[1] == str(v) for g in got) for v in range(40)}
    assert 8 < len(table) < 35 and len(final) == 40
    assert final == {v: table.get(v, (n, None)) for v, n in lengths.items()}
    assert states[-1] == 0 and states[0] > 0


def test_a_stream_without_inputs_and_late_rows(spark, tmp_path):
    key = ("n", "a")
    batches = [
        [(*key, "window", 0, 0.0, 1.0, None), (*key, "window", 1, 1.0, 2.0, None), ("n", "b", "begin", -1, None, None, None)],
        [(*key, "window", 2, 1.0, 2.0, "score_out_of_domain"), ("n", "b", "end", 9, None, None, None), ("n", "c", "window", 0, 3.0, 2.0, "window_bounds_invalid"), ("n", "d", "begin", 0, None, None, None), ("n", "d", "window", 1, 0.0, 1.0, None)],
        [(*key, "end", 9, None, None, None), ("n", "c", "end", 9, None, None, None), ("n", "d", "end", 9, None, None, None)],
        [(*key, "window", 10, 5.0, 6.0, None)],
    ]
    rows, states = run(spark, tmp_path, "late", batches, ROWS, W.accept_window_stream, "update")
    final = {r.value: (r.accepted, r.code, r.window_start_s) for r in rows if r.closed}
    assert final == {"a": (2, "duplicate_window", 1.0), "b": (0, None, None), "c": (0, "window_bounds_invalid", 3.0), "d": (0, W.DISAGREES, 0.0)}
    # a late window opens its recording anew, which stays open
    assert [(r.value, r.accepted, r.closed) for r in rows if r.batch == 3] == [("a", 1, False)] and states[2] == 0 and states[3] > 0


def test_coverage_comes_once_and_frees_its_state(spark, tmp_path):
    rng = random.Random(8)
    batches, windows, ends = [[], [], []], [], []
    for v in range(30):
        n = rng.choice([0, 1, 4, 9])
        mark = (v % 4, "empty" if not n else None, f"sha256:{v}" if v % 3 else None)
        cut = sorted(rng.randint(0, n) for _ in range(2))
        for i in range(n):
            row = ("n", str(v), i, float(i * 3 % 7), i * 3 % 7 + 1.5 + (i == 2), i % 3, rng.random() < 0.5)
            windows.append(row)
            batches[(i >= cut[0]) + (i >= cut[1])].append((*row[:2], "window", *row[2:], None, None, None))
        ends.append(("n", str(v), *mark))
        batches[2].append(("n", str(v), "end", 1000, None, None, None, None, *mark))
    rows, states = run(spark, tmp_path, "cover", batches, COUNTED, W.coverage_stream, "append")
    schema = "namespace string, value string, arrival long, window_start_s double, window_end_s double, kept long, has boolean"
    table = spark.createDataFrame(windows, schema).withColumn("embedding", F.when(F.col("has"), F.array(F.lit(1.0))))
    want = coverage.coverage(spark.createDataFrame(ends, "namespace string, value string, detection_rows long, zero_window_reason string, input_checksum string"), table)
    names = want.columns
    assert sorted((tuple(r[c] for c in names) for r in rows), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert len(rows) == 30 and states[0] > 0 and states[-1] == 0


def test_coverage_without_what_the_end_knows(spark):
    recordings = spark.createDataFrame([("n", "a"), ("n", "b")], "namespace string, value string")
    windows = spark.createDataFrame([("n", "a", 0, 1.0, 2.0, 3, [1.0])], "namespace string, value string, arrival long, window_start_s double, window_end_s double, kept long, embedding array<double>")
    got = {r.value: tuple(r)[2:] for r in coverage.coverage(recordings, windows).collect()}
    assert got == {"a": (1, 3, 1, 0, 1.0, 2.0, None, None), "b": (0, 0, 0, 0, None, None, None, None)}


def result(task, **more):
    import json

    return json.dumps({"task_id": task, "run_id": task * 10, "outcome": "completed", "coverage": [{"namespace": "n", "value": f"v{task}", "windows_completed": 2, "first_window_start_s": 0.0, "last_window_end_s": 6.0, "input_checksum": "sha256:i"}], "failed": [{"namespace": "n", "value": f"w{task}", "code": "c", "stage": "infer", "detail": "why"}], "artifacts": [{"kind": "scores", "contract_id": "k", "namespace": "n", "value": f"v{task}", "uri": "u", "checksum": "x", "size_bytes": 5, "rows": 2}]} | more)


def test_results_are_taken_once(spark, tmp_path):
    from tidemark.sources import artifacts
    from tidemark.streaming import results

    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    whole = result(3, outcome="failed", coverage=None, failed=None, artifacts=None, failure={"code": "gone", "stage": "acquire_model", "detail": "d"})
    outcomes = spark.createDataFrame([(t * 10, t, "n", f"{x}{t}", "pending") for t in (1, 2, 3) for x in "vw"] + [(10, 1, "n", "z1", "pending"), (30, 3, "n", "done", "covered")], "run_id long, task_id long, namespace string, value string, state string")

    def state():
        changed, files = artifacts.ingest_results(results.accepted_results(spark, store), outcomes)
        return sorted(map(tuple, changed.collect()), key=str), sorted(map(tuple, files.collect()))

    (source / "a.json").write_text(result(1) + "\n" + result(1) + "\n\n")
    results.ingest_stream(spark, str(source), store)
    assert len(state()[1]) == 1
    (source / "b.json").write_text(result(1) + "\n" + whole + "\n{broken\n" + result(2, outcome="odd"))
    results.ingest_stream(spark, str(source), store)
    before = state()
    assert before[0] == sorted(
        [
            (10, 1, "n", "v1", "covered", 2, 0.0, 6.0, "sha256:i", None, None, None, None), (10, 1, "n", "w1", "failed", None, None, None, None, "recording", "c", "infer", "why"),
            (10, 1, "n", "z1", "pending", *[None] * 8), (20, 2, "n", "v2", "pending", *[None] * 8), (20, 2, "n", "w2", "pending", *[None] * 8), (30, 3, "n", "done", "covered", *[None] * 8),
            *[(30, 3, "n", f"{x}3", "failed", None, None, None, None, "task", "gone", "acquire_model", "the work failed at the stage acquire_model before its first recording") for x in "vw"],
        ],
        key=str,
    )
    assert before[1] == [(10, 1, "n", "v1", "scores", "k", "u", "x", 5, 2)]
    # the same files again, and another result of a task that has one
    (source / "c.json").write_text((source / "b.json").read_text())
    (source / "d.json").write_text(result(1, failed=[]))
    results.ingest_stream(spark, str(source), store)
    results.ingest_stream(spark, str(source), store)
    assert state() == before
    assert sorted((str(r.task_id), r.code) for r in results.refused_results(spark, store).collect()) == [("1", "task_has_a_result"), ("2", "result_unreadable"), ("None", "result_unreadable")]


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    from tidemark.streaming import results

    store = str(tmp_path / "store")
    take = results._take(store)
    lines = lambda *texts: spark.createDataFrame([(t,) for t in texts], "value string")
    for _ in range(2):
        take(lines(result(1)), 0)
    for _ in range(2):
        take(lines(result(1), result(2), result(2)), 1)
    assert sorted(r.task_id for r in results.accepted_results(spark, store).collect()) == [1, 2] and results.refused_results(spark, store).count() == 0
    take(lines(result(4), result(4, failed=[])), 2)  # two at once: one of them, always the same
    assert results.accepted_results(spark, store).where("task_id = 4").count() == 1 and results.refused_results(spark, store).count() == 1


def test_a_result_is_the_same_text_whatever_order_its_recordings_come_in(spark):
    from tidemark.plans.files import _results

    rows = spark.range(300).coalesce(1).select(F.lit(1).cast("long").alias("run_id"), F.lit(10).cast("long").alias("task_id"), F.lit("n").alias("namespace"), F.col("id").cast("string").alias("value"))
    texts = {order: [r[0] for r in _results(rows.sortWithinPartitions(getattr(F.col("value"), order)())).select(F.to_json(F.struct("*"))).collect()] for order in ("asc", "desc")}
    assert len(texts["asc"]) == 1 and texts["asc"] == texts["desc"]


def shuffled(spark, after=-1):
    """(bytes that stages after one wrote to shuffles, number of the last stage)."""
    context, gateway = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway
    context.listenerBus().waitUntilEmpty()
    found = context.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    stages = [found.apply(i) for i in range(found.size())]
    return sum(s.shuffleWriteBytes() for s in stages if s.stageId() > after), max((s.stageId() for s in stages), default=-1)


def test_results_are_judged_without_moving_their_texts(spark, tmp_path):
    from tidemark.streaming import results

    source, store, rng = tmp_path / "in", str(tmp_path / "store"), random.Random(3)
    source.mkdir()
    texts = [result(t, failed=[{"namespace": "n", "value": f"w{t}", "code": "c", "stage": "infer", "detail": f"{rng.getrandbits(400_000):x}"}]) for t in range(12)]
    for name in "abc":
        (source / f"{name}.json").write_text("\n".join(texts))
    last = shuffled(spark)[1]
    results.ingest_stream(spark, str(source), store)
    (source / "late.json").write_text(result(1, failed=[]))
    results.ingest_stream(spark, str(source), store)
    assert 0 < shuffled(spark, last)[0] < len(texts[0])  # of 36 texts
    taken = results.accepted_results(spark, store).collect()
    assert sorted((r.task_id, r.failed[0].detail) for r in taken) == sorted((t, texts[t].split('"detail": "')[1].split('"')[0]) for t in range(12))
    assert [(r.task_id, r.code) for r in results.refused_results(spark, store).collect()] == [(1, "task_has_a_result")]


def test_only_pending_recordings_meet_results(spark):
    from tidemark.sources import artifacts

    results = spark.createDataFrame([(1, 10, "completed", None, [("n", x, 2, 0.0, 6.0, "i") for x in "abc"], [], [])], artifacts.RESULT)
    outcomes = spark.createDataFrame([(10, 1, "n", x, s) for x, s in (("a", "pending"), ("b", "covered"), ("c", None), ("d", "pending"))], "run_id long, task_id long, namespace string, value string, state string")
    rows = artifacts.ingest_results(results, outcomes)[0]
    assert sorted((r.value, r.state, r.windows_completed) for r in rows.collect()) == [("a", "covered", 2), ("b", "covered", None), ("c", None, None), ("d", "pending", None)]
    assert rows.columns == ["run_id", "task_id", "namespace", "value", "state", *artifacts.COVERED, *artifacts.FAILED]


def test_more_results_than_are_broadcast_are_taken_too(spark, tmp_path, monkeypatch):
    from tidemark.streaming import results

    texts = [result(t) for t in range(30)]
    batch = spark.createDataFrame([(t,) for t in texts + texts], "value string").repartition(3).localCheckpoint()
    found = {}
    for most in (1_000_000, 29):
        monkeypatch.setattr(results, "MOST_TAKEN", most)
        results._take(str(tmp_path / str(most)))(batch, 0)
        found[most] = sorted(map(str, results.accepted_results(spark, str(tmp_path / str(most))).collect()))
    assert len(found[29]) == 30 and found[29] == found[1_000_000]
