"""What a work covered, and whether its parts agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

KEY = ["namespace", "value"]
#: Stages that fail one recording, stages that fail a whole work, states of a task that has started.
RECORDING_STAGES = ("acquire_input", "read_input_artifact", "infer", "accept_window", "write_artifact", "aggregate")
WORK_STAGES = ("validate_request", "acquire_model", "load_registry", "construct_model")
ACTIVE_TASKS = ("submitting", "submitted", "running", "finalizing")


def coverage(recordings: DataFrame, windows: DataFrame) -> DataFrame:
    """Counts and bounds of every recording from accepted windows (arrival, window_start_s, window_end_s, kept, embedding).

    What is known at a recording's end comes with ``recordings``: detection_rows, zero_window_reason, input_checksum; a
    column that is not there is 0 or null.
    """
    done = windows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("windows_completed"),
        F.sum("kept").alias("score_rows"),
        F.count("embedding").alias("embedding_rows"),
        F.min_by("window_start_s", "arrival").alias("first_window_start_s"),
        F.max("window_end_s").alias("last_window_end_s"),
    )
    counts = ["windows_completed", "score_rows", "embedding_rows", "detection_rows"]
    known = {"detection_rows": "long", "zero_window_reason": "string", "input_checksum": "string"}
    ends = recordings.select(*KEY, *(F.col(c).cast(t).alias(c) if c in recordings.columns else F.lit(None).cast(t).alias(c) for c, t in known.items()))
    covered = ends.join(done, KEY, "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in counts})
    return covered.select(*KEY, *counts, "first_window_start_s", "last_window_end_s", "zero_window_reason", "input_checksum")


def zero_window_problem(windows: Column, reason: Column) -> Column:
    return F.when((windows == 0) & reason.isNull(), "unexplained_zero_windows").when((windows > 0) & reason.isNotNull(), "reason_with_windows")


def coverage_problems(rows: DataFrame) -> DataFrame:
    """One row per broken rule of a coverage row."""
    w, s, e, d = (F.col(c) for c in ("windows_completed", "score_rows", "embedding_rows", "detection_rows"))
    first, last = F.col("first_window_start_s"), F.col("last_window_end_s")
    rules = [
        (first.isNull() != last.isNull(), "half_bounds"),
        ((w > 0) != first.isNotNull(), "bounds_without_windows"),
        (first < 0, "negative_start"),
        (last <= first, "empty_span"),
        ((w == 0) & (s + e + d > 0), "rows_without_windows"),
        (e > w, "more_embeddings_than_windows"),
        (d > s, "more_detections_than_scores"),
    ]
    broken = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for rule, name in rules)))
    return rows.select(*KEY, F.explode(broken).alias("problem"))


def result_problems(covered: DataFrame, failed: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Recordings named twice, doubled artifacts, and artifacts whose rows are not those that coverage counts."""
    named = covered.select(*KEY).unionByName(failed.select(*KEY)).groupBy(*KEY).count().where("count > 1").select(*KEY, F.lit("named_twice").alias("problem"))
    doubled = artifacts.groupBy("kind", *KEY).count().where("count > 1").select(*KEY, F.concat(F.lit("doubled_"), F.col("kind")).alias("problem"))
    expected = covered.select(*KEY, F.expr("stack(3, 'scores', score_rows, 'embeddings', embedding_rows, 'detections', detection_rows) AS (kind, expected)")).where("expected > 0")
    found = artifacts.groupBy("kind", *KEY).agg(F.max("rows").alias("found"))
    differ = expected.join(found, ["kind", *KEY], "full").where(~F.col("expected").eqNullSafe(F.col("found"))).select(*KEY, F.concat(F.lit("rows_differ_"), F.col("kind")).alias("problem"))
    return named.unionByName(doubled).unionByName(differ)


def request_problems(results: DataFrame, artifacts: DataFrame, by: str = "task_id") -> DataFrame:
    """What is wrong with each result as a whole: half a registry binding, or artifacts whose request it does not give.

    Results have registry_uri, registry_fingerprint, resolved_scores_request and resolved_detection_policy, null where
    absent; artifacts have the kind and the result they belong to. A request without artifacts is fine.
    """
    kinds = artifacts.groupBy(by).agg(F.max((F.col("kind") == "scores").cast("int")).alias("scores"), F.max((F.col("kind") == "detections").cast("int")).alias("detections"))
    rules = [
        (F.col("registry_uri").isNull() != F.col("registry_fingerprint").isNull(), "half_registry_binding"),
        ((F.col("scores") == 1) & F.col("resolved_scores_request").isNull(), "scores_without_request"),
        ((F.col("detections") == 1) & F.col("resolved_detection_policy").isNull(), "detections_without_policy"),
    ]
    broken = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for rule, name in rules)))
    return results.join(kinds, by, "left").select(by, F.explode(broken).alias("problem"))


def stage_problems(reports: DataFrame) -> DataFrame:
    """Failure reports whose stage is not one of their scope."""
    allowed = F.when(F.col("scope") == "recording", F.col("stage").isin(*RECORDING_STAGES)).otherwise(F.col("stage").isin(*WORK_STAGES))
    return reports.where(~F.coalesce(allowed, F.lit(False)))


def _as_texts(recordings: str) -> Column:
    """Recordings as JSON: Spark compares structs pair by pair in ``array_except``, but looks texts up."""
    return F.transform(recordings, lambda r: F.when(r.isNotNull(), F.to_json(F.struct(*(r[k].alias(k) for k in KEY)))))


def _from_texts(texts: Column) -> Column:
    return F.transform(texts, lambda text: F.from_json(text, ", ".join(f"{k} string" for k in KEY)))


def task_result_problem(results: DataFrame, tasks: DataFrame) -> DataFrame:
    """The first reason to refuse each result: another task, work file or work, other recordings, or a place elsewhere.

    Results and tasks have work_file_digest, work_digest, and an array ``recordings`` of structs (namespace, value);
    ``under_root`` tells whether all artifacts are below the task's root.
    """
    t = tasks.select("task_id", F.col("work_file_digest").alias("t_file"), F.col("work_digest").alias("t_work"), F.col("recordings").alias("t_recordings"))
    joined = results.join(t, "task_id", "left").withColumns({"wanted": _as_texts("t_recordings"), "named": _as_texts("recordings")})
    joined = joined.withColumns({"missing": F.array_except("wanted", "named"), "extra": F.array_except("named", "wanted")})
    missing, extra = F.col("missing"), F.col("extra")
    problem = F.coalesce(
        F.when(F.col("t_file").isNull(), "unknown_task"),
        F.when(F.col("work_file_digest") != F.col("t_file"), "other_work_file"),
        F.when(F.col("work_digest") != F.col("t_work"), "other_work"),
        F.when((F.size(missing) > 0) | (F.size(extra) > 0), "other_recordings"),
        F.when(~F.col("under_root"), "artifact_elsewhere"),
    )
    return joined.select("task_id", problem.alias("problem"), F.array_sort(_from_texts(missing)).alias("missing"), F.array_sort(_from_texts(extra)).alias("extra")).where("problem is not null")


def partition_problems(requested: DataFrame, covered: DataFrame, failed: DataFrame) -> DataFrame:
    """Missing, extra and misplaced recordings of a result; ``position`` gives the order on both sides."""
    named = covered.select(*KEY, "position").unionByName(failed.select(*KEY, "position"))
    missing = requested.select(*KEY).exceptAll(named.select(*KEY)).withColumn("problem", F.lit("missing"))
    extra = named.select(*KEY).exceptAll(requested.select(*KEY)).withColumn("problem", F.lit("extra"))
    both = requested.select(*KEY, F.col("position").alias("wanted")).join(covered.select(*KEY, "position"), KEY)
    moved = both.where("position <> wanted").select(*KEY, F.lit("misplaced").alias("problem"))
    return missing.unionByName(extra).unionByName(moved)


def unrequested_kinds(artifacts: DataFrame, requests: DataFrame) -> DataFrame:
    return artifacts.select("kind").distinct().join(requests.select("kind"), "kind", "left_anti")


def without_failed(rows: DataFrame, failed: DataFrame) -> DataFrame:
    """What goes on to the sinks when failing recordings are set aside."""
    return rows.join(failed.select(*KEY), KEY, "left_anti")


def failure_rows(failures: DataFrame) -> DataFrame:
    return failures.select(*KEY, "code", "stage", "window_start_s", F.substring("detail", 1, 2000).alias("detail"))


def state_counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy("run_id", *by).agg(F.count(F.lit(1)).alias("n"))


def failure_codes(failures: DataFrame, most: int = 20) -> DataFrame:
    """Failed recordings by scope and code, most first, the first ``most`` of each run, and whether there are more."""
    counts = failures.groupBy("run_id", "scope", "code").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("run_id").orderBy(F.col("n").desc(), "scope", "code")
    placed = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most + 1)
    more = F.max("place").over(Window.partitionBy("run_id")) > most
    return placed.withColumn("truncated", more).where(F.col("place") <= most).select("run_id", "scope", "code", "n", "place", "truncated")


def run_status(runs: DataFrame, task_counts: DataFrame, recording_counts: DataFrame) -> DataFrame:
    """The derived status of each run; the first rule that applies gives it. Counts are rows (run_id, state, n)."""
    of = lambda states: F.coalesce(F.sum(F.when(F.col("state").isin(*states), F.col("n"))), F.lit(0))
    tasks = task_counts.groupBy("run_id").agg(of(ACTIVE_TASKS).alias("active"), of(("queued",)).alias("queued"))
    recordings = recording_counts.groupBy("run_id").agg(of(("failed",)).alias("failed"))
    status = (
        F.when(F.col("withdrawn"), "withdrawn")
        .when(F.col("cancelled"), "cancelled")
        .when(F.col("state").isin("preparing", "preparation_failed"), F.col("state"))
        .when(F.col("active") > 0, "running")
        .when(F.col("queued") > 0, "queued")
        .when(F.col("failed") > 0, "finished_with_failures")
        .otherwise("finished")
    )
    return runs.join(tasks, "run_id", "left").join(recordings, "run_id", "left").select("run_id", status.alias("status"))


def filtered_counts(outcomes: DataFrame) -> DataFrame:
    """Claimed and skipped recordings of each run in one pass."""
    return outcomes.groupBy("run_id").agg(F.count_if(F.col("state") == "pending").alias("claimed"), F.count_if(F.col("state") == "skipped").alias("skipped"))
