"""Queries of the operators on windows, scores, checks and runs, with their SQL."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixtures
from ..functions import text as T
from ..operators import accept as A, coverage as V, embeddings as I, geometry as G, lineage as L, lists as Q, paging as P, retention as R
from ..sources.shared import shared_folder

QUERIES: dict[str, object] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *more: str):
    """Register a function of (session, views, folder); ``sql`` follows the WITH clause of all views and ``more``."""

    def enter(run):
        QUERIES[name] = lambda spark, sf_dir: run(spark, fixtures.load(spark, sf_dir), sf_dir)
        if sql is not None:
            SQL[name] = fixtures.ctes(*more) + sql
        return run

    return enter


# windows


def _configured(f: dict[str, DataFrame]) -> DataFrame:
    # a handful of configurations, each for every recording
    return f["recordings"].withColumn("c", F.explode(F.expr("array(struct(3.0D AS win, 0.0D AS overlap, 'drop' AS pad), struct(5.0D AS win, 2.5D AS overlap, 'centre_crop_end_pad' AS pad), struct(12.0D AS win, 0.0D AS overlap, 'drop' AS pad), struct(0.7D AS win, 0.0D AS overlap, 'time_scaled' AS pad))"))).select("namespace", "value", "duration_seconds", "c.*")


COUNT_SQL = "counted AS (SELECT r.namespace, r.value, c.win, c.overlap, c.pad, r.duration_seconds, CAST(CASE WHEN c.pad = 'drop' THEN greatest(floor((r.duration_seconds - c.win) / (c.win - c.overlap) + 1 + 1e-9::DOUBLE), 0) ELSE greatest(ceil((r.duration_seconds - c.win) / (c.win - c.overlap) + 1 - 1e-9::DOUBLE), 1) END AS BIGINT) AS n FROM recordings r CROSS JOIN window_configs c WHERE r.duration_seconds IS NOT NULL)"


@query("window_count", "SELECT namespace, value, win, pad, n FROM counted", COUNT_SQL)
def _(spark, f, d):
    rows = _configured(f).where("duration_seconds is not null")
    return rows.select("namespace", "value", "win", "pad", G.window_count(F.col("duration_seconds"), F.col("win"), F.col("overlap"), F.col("pad")).alias("n"))


@query("window_bounds", "SELECT namespace, value, win, overlap, pad, i, i * (win - overlap) AS window_start_s, i * (win - overlap) + win AS window_end_s FROM (SELECT *, unnest(range(0, n)) AS i FROM counted) x", COUNT_SQL)
def _(spark, f, d):
    return G.window_bounds(_configured(f))


@query("frame_span", "SELECT namespace, value, window_start_s, CAST(round_even(window_start_s * 22050.0e0, 0) AS BIGINT) AS first_frame, least(CAST(round_even((window_end_s - window_start_s) * 22050.0e0, 0) AS BIGINT), 1000000 - CAST(round_even(window_start_s * 22050.0e0, 0) AS BIGINT)) AS frames, (window_start_s * 2.0e0 = floor(window_start_s * 2.0e0)) AS on_grid FROM windows")
def _(spark, f, d):
    first, frames = G.frame_span(F.col("window_start_s"), F.col("window_end_s"), F.lit(22050.0), F.lit(1_000_000))
    return f["windows"].select("namespace", "value", "window_start_s", first.alias("first_frame"), frames.alias("frames"), G.on_exact_grid(F.col("window_start_s"), 2).alias("on_grid"))


@query("zero_window_reason", "SELECT namespace, value, CASE WHEN n = 0 THEN 'shorter_than_window' END AS reason FROM counted WHERE win = 12.0e0", COUNT_SQL)
def _(spark, f, d):
    rows = _configured(f).where("win = 12 and duration_seconds is not null")
    n = G.window_count(F.col("duration_seconds"), F.col("win"), F.col("overlap"), F.col("pad"))
    return rows.select("namespace", "value", G.zero_window_reason(F.col("duration_seconds"), n).alias("reason"))


# acceptance


def _returned(f: dict[str, DataFrame]) -> DataFrame:
    """Windows as a model returns them, 25 scores each, with defects."""
    scores = F.expr("transform(sequence(0, 24), c -> CASE WHEN bad_score AND c = 3 THEN 1.5D ELSE c / 25.0D END)")
    embedding = F.when(F.col("short_embedding"), F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    return f["bad_windows"].select("namespace", "value", "arrival", "window_start_s", "window_end_s", scores.alias("scores"), embedding.alias("embedding"), F.lit(60.0).alias("duration_seconds"))


def _coded(f):
    return A.window_codes(_returned(f), 3.0, 3.0, True, 25, 64)


CODED_SQL = """coded AS (SELECT *, CASE
  WHEN window_end_s <= window_start_s THEN 'window_bounds_invalid'
  WHEN window_start_s = before THEN 'duplicate_window' WHEN window_start_s < before THEN 'window_out_of_order'
  WHEN least(((window_start_s % 3.0e0) + 3.0e0) % 3.0e0, 3.0e0 - ((window_start_s % 3.0e0) + 3.0e0) % 3.0e0) > 3e-9::DOUBLE OR abs(window_end_s - window_start_s - 3.0e0) > 3e-9::DOUBLE THEN 'window_off_geometry'
  WHEN window_start_s < 0 OR window_start_s >= 60 OR window_end_s > 60 THEN 'window_outside_recording'
  WHEN bad_score THEN 'score_out_of_domain' WHEN short_embedding THEN 'malformed_embedding' END AS code
  FROM (SELECT *, lag(window_start_s) OVER (PARTITION BY namespace, value ORDER BY arrival) AS before FROM bad_windows) x)"""
FAILED_SQL = "failed AS (SELECT namespace, value, code, window_start_s, arrival FROM (SELECT *, row_number() OVER (PARTITION BY namespace, value ORDER BY arrival) AS rn FROM coded WHERE code IS NOT NULL) x WHERE rn = 1)"


@query("accept_window", "SELECT namespace, value, code, window_start_s, arrival FROM failed", CODED_SQL, FAILED_SQL)
def _(spark, f, d):
    return A.recording_failures(_coded(f))


@query("continue_on_failure", "SELECT namespace, value, count(*) AS windows FROM coded WHERE NOT EXISTS (SELECT 1 FROM failed x WHERE x.namespace = coded.namespace AND x.value = coded.value) GROUP BY namespace, value", CODED_SQL, FAILED_SQL)
def _(spark, f, d):
    coded = _coded(f)
    return V.without_failed(coded, A.recording_failures(coded)).groupBy("namespace", "value").agg(F.count(F.lit(1)).alias("windows"))


@query("accept_bounds", "SELECT arrival, CASE WHEN window_end_s - (arrival % 31 = 0)::INT * 4 <= window_start_s THEN 'window_bounds_invalid' END AS code FROM bad_windows")
def _(spark, f, d):
    end = F.col("window_end_s") - F.when(F.col("arrival") % 31 == 0, 4).otherwise(0)
    return f["bad_windows"].select("arrival", A.bounds_code(F.col("window_start_s"), end).alias("code"))


@query("accept_order", "SELECT arrival, CASE WHEN window_start_s = before THEN 'duplicate_window' WHEN window_start_s < before THEN 'window_out_of_order' END AS code FROM coded", CODED_SQL)
def _(spark, f, d):
    rows = f["bad_windows"].withColumn("before", F.lag("window_start_s").over(A.by_arrival()))
    return rows.select("arrival", A.order_code(F.col("window_start_s"), F.col("before")).alias("code"))


@query("accept_geometry", "SELECT arrival, CASE WHEN least(((window_start_s % 3.0e0) + 3.0e0) % 3.0e0, 3.0e0 - ((window_start_s % 3.0e0) + 3.0e0) % 3.0e0) > 3e-9::DOUBLE OR abs(window_end_s - window_start_s - 3.0e0) > 3e-9::DOUBLE THEN 'window_off_geometry' END AS code FROM bad_windows")
def _(spark, f, d):
    return f["bad_windows"].select("arrival", A.geometry_code(F.col("window_start_s"), F.col("window_end_s"), 3.0, 3.0).alias("code"))


@query("accept_within", "SELECT arrival, CASE WHEN window_start_s < 0 OR window_start_s >= 45 OR window_end_s > 45 THEN 'window_outside_recording' END AS code FROM bad_windows")
def _(spark, f, d):
    return f["bad_windows"].select("arrival", A.within_code(F.col("window_start_s"), F.col("window_end_s"), F.lit(45.0), True).alias("code"))


@query("accept_scores", "SELECT arrival, CASE WHEN bad_score THEN 'score_out_of_domain' END AS code FROM bad_windows")
def _(spark, f, d):
    return _returned(f).select("arrival", A.scores_code(F.col("scores"), 25).alias("code"))


@query("score_in_domain", "SELECT arrival, CAST(CASE WHEN bad_score THEN 4 ELSE 0 END AS BIGINT) AS place FROM bad_windows")
def _(spark, f, d):
    return _returned(f).select("arrival", A.score_position(F.col("scores")).alias("place"))


@query("accept_embedding", "SELECT arrival, CASE WHEN short_embedding THEN 'malformed_embedding' END AS code FROM bad_windows")
def _(spark, f, d):
    return _returned(f).select("arrival", A.embedding_code(F.col("embedding"), 64).alias("code"))


@query("accept_expected", """SELECT namespace, value, min(i) AS row, 'head_windows_disagree_with_input' AS code FROM (
  SELECT coalesce(g.namespace, w.namespace) AS namespace, coalesce(g.value, w.value) AS value, coalesce(g.i, w.i) AS i FROM
  (SELECT *, row_number() OVER (PARTITION BY namespace, value ORDER BY arrival) AS i FROM bad_windows WHERE arrival % 131 > 0) g
  FULL JOIN (SELECT *, row_number() OVER (PARTITION BY namespace, value ORDER BY vec_id) AS i FROM windows) w ON g.namespace = w.namespace AND g.value = w.value AND g.i = w.i
  WHERE g.window_start_s IS DISTINCT FROM w.window_start_s OR g.window_end_s IS DISTINCT FROM w.window_end_s) x GROUP BY namespace, value""")
def _(spark, f, d):
    return A.expected_problems(f["bad_windows"].where("arrival % 131 > 0"), f["windows"].withColumn("position", F.col("vec_id")))


# retention and detections


def _score_arrays(f: dict[str, DataFrame]) -> DataFrame:
    scores = F.expr("transform(sequence(0L, 24L), c -> ((vec_id * 31 + c * 17 + (vec_id % 7) * (c % 11)) % 11) / 10.0D)")
    return f["windows"].withColumn("scores", scores)


WIN = "namespace, value, window_start_s, window_end_s"
RANK = "row_number() OVER (PARTITION BY namespace, value, window_start_s ORDER BY score DESC, label)"
DETECTION = "namespace, value, window_start_s, window_end_s, s.label, label_kind, score, CAST(rank AS INTEGER) AS rank, scientific_name, common_name, gbif_taxon_key"


@query("retain_full", f"SELECT {WIN}, label, score FROM scores")
def _(spark, f, d):
    return R.retain_full(_score_arrays(f), f["registry"])


@query("score_floor", f"SELECT {WIN}, label, score FROM scores WHERE score >= 0.9e0")
def _(spark, f, d):
    return R.score_floor(f["scores"], 0.9).drop("class_index")


@query("retain_thresholded", f"SELECT {WIN}, label, score FROM scores WHERE score >= 0.7e0")
def _(spark, f, d):
    kept = _score_arrays(f).withColumn("scores", F.transform("scores", lambda x: F.when(x >= 0.7, x)))
    return R.retain_full(kept, f["registry"]).where("score is not null")


@query("retain_top_k", f"SELECT {WIN}, label, score FROM (SELECT *, {RANK} AS rn FROM scores WHERE score >= 0.2e0) x WHERE rn <= 5")
def _(spark, f, d):
    return R.retain_top_k(f["scores"], 5, 0.2).drop("class_index")


@query("label_rank", "SELECT label, row_number() OVER (ORDER BY label) - 1 AS place FROM registry")
def _(spark, f, d):
    return R.label_rank(f["registry"])


@query("detections_threshold", f"SELECT {DETECTION} FROM (SELECT *, {RANK} AS rank FROM scores WHERE score >= 0.8e0) s JOIN registry r ON r.label = s.label")
def _(spark, f, d):
    return R.detections(f["scores"], f["registry"], 0.8)


@query("detections_top_k", f"SELECT {DETECTION} FROM (SELECT *, {RANK} AS rank FROM scores WHERE score >= 0.3e0) s JOIN registry r ON r.label = s.label WHERE rank <= 3")
def _(spark, f, d):
    return R.detections(f["scores"], f["registry"], 0.3, 3)


@query("unmatched_labels", "SELECT DISTINCT namespace, value, label FROM scores WHERE label NOT IN (SELECT label FROM registry WHERE class_index % 6 > 0)")
def _(spark, f, d):
    return R.unmatched_labels(f["scores"], f["registry"].where("class_index % 6 > 0"))


@query("detections_per_recording", f"SELECT namespace, value, count(*) AS rows FROM (SELECT *, {RANK} AS rank FROM scores WHERE score >= 1.0e0) s WHERE rank <= 3 GROUP BY namespace, value")
def _(spark, f, d):
    return R.rows_per_recording(R.detections(f["scores"], f["registry"], 1.0, 3))


@query("detection_id", f"""SELECT namespace, value, window_start_s, CAST(rank AS INTEGER) AS rank, 'sha256:v1:' || sha256('{{"rank":' || rank || ',"recipe_fingerprint":"r\"\"é","recording_namespace":"' || namespace || '","recording_value":"' || value || '","recording_work_digest":"sha256:v1:' || sha256(value) || '","window_start_s":' || window_start_s || '}}') AS detection_id
  FROM (SELECT *, {RANK} AS rank FROM scores WHERE score >= 0.8e0) s""".replace('r\"\"é', 'r\\"é'))
def _(spark, f, d):
    rows = R.ranked(R.score_floor(f["scores"], 0.8))
    digest = F.concat(F.lit("sha256:v1:"), F.sha2("value", 256))
    return rows.select("namespace", "value", "window_start_s", "rank", T.detection_id(F.col("namespace"), F.col("value"), digest, F.lit('r"é'), F.col("window_start_s"), F.col("rank")).alias("detection_id"))


# coverage and checks


COVERAGE_SQL = """SELECT r.namespace, r.value, coalesce(count(w.arrival), 0) AS windows_completed, CAST(coalesce(sum(w.kept), 0) AS BIGINT) AS score_rows, count(w.embedding) AS embedding_rows, r.detection_rows,
  arg_min(w.window_start_s, w.arrival) AS first_window_start_s, max(w.window_end_s) AS last_window_end_s, r.zero_window_reason, r.input_checksum
  FROM recording_ends r LEFT JOIN kept_windows w ON r.namespace = w.namespace AND r.value = w.value GROUP BY r.namespace, r.value, r.detection_rows, r.zero_window_reason, r.input_checksum"""


@query("coverage", COVERAGE_SQL)
def _(spark, f, d):
    return V.coverage(f["recording_ends"], f["kept_windows"])


@query("zero_window_check", "SELECT namespace, value, CASE WHEN windows_completed = 0 AND reason IS NULL THEN 'unexplained_zero_windows' WHEN windows_completed > 0 AND reason IS NOT NULL THEN 'reason_with_windows' END AS problem FROM coverage_rows")
def _(spark, f, d):
    return f["coverage_rows"].select("namespace", "value", V.zero_window_problem(F.col("windows_completed"), F.col("reason")).alias("problem"))


@query("coverage_invariants", """SELECT namespace, value, 'half_bounds' AS problem FROM coverage_rows WHERE (first_window_start_s IS NULL) <> (last_window_end_s IS NULL)
  UNION ALL SELECT namespace, value, 'bounds_without_windows' FROM coverage_rows WHERE (windows_completed > 0) <> (first_window_start_s IS NOT NULL)
  UNION ALL SELECT namespace, value, 'negative_start' FROM coverage_rows WHERE first_window_start_s < 0
  UNION ALL SELECT namespace, value, 'empty_span' FROM coverage_rows WHERE last_window_end_s <= first_window_start_s
  UNION ALL SELECT namespace, value, 'rows_without_windows' FROM coverage_rows WHERE windows_completed = 0 AND score_rows + embedding_rows + detection_rows > 0
  UNION ALL SELECT namespace, value, 'more_embeddings_than_windows' FROM coverage_rows WHERE embedding_rows > windows_completed
  UNION ALL SELECT namespace, value, 'more_detections_than_scores' FROM coverage_rows WHERE detection_rows > score_rows""")
def _(spark, f, d):
    return V.coverage_problems(f["coverage_rows"])


@query("result_invariants", """SELECT namespace, value, 'named_twice' AS problem FROM (SELECT namespace, value FROM coverage_rows UNION ALL SELECT namespace, value FROM coverage_rows WHERE d % 41 = 0) x GROUP BY 1, 2 HAVING count(*) > 1
  UNION ALL SELECT namespace, value, 'doubled_' || kind FROM artifact_rows GROUP BY kind, namespace, value HAVING count(*) > 1
  UNION ALL SELECT coalesce(e.namespace, a.namespace), coalesce(e.value, a.value), 'rows_differ_' || coalesce(e.kind, a.kind) FROM
   (SELECT 'scores' AS kind, namespace, value, score_rows AS n FROM coverage_rows WHERE score_rows > 0 UNION ALL SELECT 'embeddings', namespace, value, embedding_rows FROM coverage_rows WHERE embedding_rows > 0
    UNION ALL SELECT 'detections', namespace, value, detection_rows FROM coverage_rows WHERE detection_rows > 0) e
   FULL JOIN (SELECT kind, namespace, value, max(rows) AS n FROM artifact_rows GROUP BY ALL) a ON e.kind = a.kind AND e.namespace = a.namespace AND e.value = a.value WHERE e.n IS DISTINCT FROM a.n
  UNION ALL SELECT 'result', CAST(run_id AS VARCHAR), 'half_registry_binding' FROM runs WHERE (run_id % 4 = 0) <> (run_id % 6 = 0)
  UNION ALL SELECT DISTINCT 'result', CAST(run_id AS VARCHAR), 'scores_without_request' FROM output_files WHERE kind = 'scores' AND run_id % 3 = 1
  UNION ALL SELECT DISTINCT 'result', CAST(run_id AS VARCHAR), 'detections_without_policy' FROM output_files WHERE kind = 'embeddings' AND run_id % 5 = 2 AND run_id % 7 > 0""")
def _(spark, f, d):
    named = V.result_problems(f["coverage_rows"], f["coverage_rows"].where("d % 41 = 0"), f["artifact_rows"])
    r = F.col("run_id")
    given = lambda rule: F.when(rule, "given")
    results = f["runs"].select("run_id", given(r % 4 != 0).alias("registry_uri"), given(r % 6 != 0).alias("registry_fingerprint"), given(r % 3 != 1).alias("resolved_scores_request"), given(r % 5 != 2).alias("resolved_detection_policy"))
    more = f["output_files"].where("kind = 'embeddings' AND run_id % 7 > 0").select("run_id", F.lit("detections").alias("kind"))
    problems = V.request_problems(results, f["output_files"].select("run_id", "kind").unionByName(more), "run_id")
    return named.unionByName(problems.select(F.lit("result").alias("namespace"), r.cast("string").alias("value"), "problem"))


@query("failure_stage_check", f"SELECT run_id, namespace, value, scope, code, stage FROM failures WHERE NOT CASE WHEN scope = 'recording' THEN stage IN {V.RECORDING_STAGES} ELSE stage IN {V.WORK_STAGES} END")
def _(spark, f, d):
    return V.stage_problems(f["failures"])


@query("partition_check", """SELECT namespace, value, 'missing' AS problem FROM coverage_rows WHERE d % 37 = 0
  UNION ALL SELECT namespace, value || 'x', 'extra' FROM coverage_rows WHERE d % 43 = 0
  UNION ALL SELECT namespace, value, 'misplaced' FROM coverage_rows WHERE d % 37 > 0 AND d % 47 = 0""")
def _(spark, f, d):
    rows = f["coverage_rows"].withColumn("position", F.col("d"))
    covered = rows.where("d % 37 > 0").withColumn("position", F.col("d") + F.when(F.col("d") % 47 == 0, 1).otherwise(0))
    failed = rows.where("d % 43 = 0").withColumn("value", F.concat("value", F.lit("x")))
    return V.partition_problems(rows, covered, failed)


@query("task_result_problem", """SELECT run_id AS task_id, CASE WHEN run_id % 10 = 3 THEN 'unknown_task' WHEN run_id % 10 = 5 THEN 'other_work_file' WHEN run_id % 10 = 7 THEN 'other_work' WHEN n_odd > 0 THEN 'other_recordings' WHEN run_id % 10 = 8 THEN 'artifact_elsewhere' END AS problem
  FROM (SELECT run_id, count(*) FILTER (WHERE CAST(value AS BIGINT) % 97 = 0) AS n_odd FROM run_recordings GROUP BY run_id) x WHERE run_id % 10 IN (3, 5, 7, 8) OR n_odd > 0""")
def _(spark, f, d):
    all_ = F.sort_array(F.collect_list(F.struct("namespace", "value")))
    path = shared_folder(spark, "tasks")
    f["run_recordings"].groupBy(F.col("run_id").alias("task_id")).agg(all_.alias("all")).write.parquet(path)  # tasks and results read it
    base = spark.read.schema("task_id long, all array<struct<namespace:string,value:string>>").parquet(path)
    base = base.withColumn("some", F.filter("all", lambda r: r["value"].cast("long") % 97 != 0))
    tasks = base.where("task_id % 10 <> 3").select("task_id", F.lit("f").alias("work_file_digest"), F.lit("w").alias("work_digest"), F.col("all").alias("recordings"))
    results = base.select(
        "task_id", F.when(F.col("task_id") % 10 == 5, "g").otherwise("f").alias("work_file_digest"), F.when(F.col("task_id") % 10 == 7, "v").otherwise("w").alias("work_digest"),
        F.col("some").alias("recordings"), (F.col("task_id") % 10 != 8).alias("under_root"),
    )
    return V.task_result_problem(results, tasks).select("task_id", "problem")


@query("run_counts", "SELECT run_id, state, skip_reason, count(*) AS n FROM recording_outcomes GROUP BY run_id, state, skip_reason")
def _(spark, f, d):
    return V.state_counts(f["recording_outcomes"], "state", "skip_reason")


@query("failure_codes", """SELECT run_id, scope, code, n, CAST(place AS INTEGER) AS place, most > 20 AS truncated FROM (SELECT *, max(place) OVER (PARTITION BY run_id) AS most FROM
  (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, scope, code) AS place FROM (SELECT run_id, scope, code, count(*) AS n FROM failures GROUP BY ALL) x) y) z WHERE place <= 20""")
def _(spark, f, d):
    return V.failure_codes(f["failures"])


@query("run_status", """SELECT r.run_id, CASE WHEN r.withdrawn THEN 'withdrawn' WHEN r.cancelled THEN 'cancelled' WHEN r.state = 'preparing' THEN 'preparing' WHEN t.state = 'running' THEN 'running' WHEN t.state = 'queued' THEN 'queued'
  WHEN x.failed > 0 THEN 'finished_with_failures' ELSE 'finished' END AS status FROM runs r LEFT JOIN pending_tasks t ON t.run_id = r.run_id
  LEFT JOIN (SELECT run_id, count(*) AS failed FROM failures GROUP BY run_id) x ON x.run_id = r.run_id""")
def _(spark, f, d):
    return V.run_status(f["runs"], f["pending_tasks"], V.state_counts(f["recording_outcomes"], "state"))


@query("filtered_counts", "SELECT run_id, count(*) FILTER (WHERE state = 'pending') AS claimed, count(*) FILTER (WHERE state = 'skipped') AS skipped FROM recording_outcomes GROUP BY run_id")
def _(spark, f, d):
    return V.filtered_counts(f["recording_outcomes"])


# lineage


def _outcomes(f: dict[str, DataFrame]) -> DataFrame:
    # one more id in the versions of cfg3, so that maps of two sizes are compared
    versions = F.expr("CASE WHEN configuration_digest = 'cfg3' AND model_version > 1 THEN map('model:a/v4', model_version, 'head_runtime:b', 1L) ELSE map('model:a/v4', model_version) END")
    return f["recording_outcomes"].withColumn("model_version", F.col("model_version").cast("long")).withColumn("output_versions", versions)


CURRENT_SQL = "current AS (SELECT * FROM (SELECT o.*, row_number() OVER (PARTITION BY o.namespace, o.value, o.configuration_digest ORDER BY CASE WHEN o.configuration_digest = 'cfg3' AND o.model_version > 1 THEN 2 ELSE 1 END DESC, o.model_version DESC, o.run_id) AS rn FROM recording_outcomes o JOIN runs r ON r.run_id = o.run_id AND NOT r.withdrawn WHERE o.state = 'covered') x WHERE rn = 1)"
HIGHEST_SQL = "highest AS (SELECT max(model_version) AS highest FROM recording_outcomes WHERE state IN ('covered', 'withdrawn'))"


@query("current_files", "SELECT c.run_id, c.namespace, c.value, c.configuration_digest, c.model_version >= (SELECT highest FROM highest) AS up_to_date, o.kind, o.uri FROM current c JOIN output_files o ON o.run_id = c.run_id AND o.namespace = c.namespace AND o.value = c.value", CURRENT_SQL, HIGHEST_SQL)
def _(spark, f, d):
    return L.current_files(_outcomes(f), f["runs"], f["output_files"]).select("run_id", "namespace", "value", "configuration_digest", "up_to_date", "kind", "uri")


@query("highest_versions", "SELECT 'model:a/v4' AS version_id, CAST(highest AS BIGINT) AS highest FROM highest UNION ALL SELECT 'head_runtime:b', 1 WHERE EXISTS (SELECT 1 FROM recording_outcomes WHERE state IN ('covered', 'withdrawn') AND configuration_digest = 'cfg3' AND model_version > 1)", HIGHEST_SQL)
def _(spark, f, d):
    return L.highest_versions(_outcomes(f))


@query("up_to_date", "SELECT run_id, namespace, value, model_version >= (SELECT highest FROM highest) AS up_to_date FROM recording_outcomes WHERE state = 'covered'", HIGHEST_SQL)
def _(spark, f, d):
    outcomes = _outcomes(f)
    return L.up_to_date(outcomes.where("state = 'covered'"), L.highest_versions(outcomes)).select("run_id", "namespace", "value", "up_to_date")


CLAIM_SQL = "requests AS (SELECT w.* FROM wanted w), held AS (SELECT * FROM recording_outcomes WHERE state IN ('pending', 'covered') AND CAST(value AS BIGINT) % 3 = 0)"


def _claims(f):
    key = lambda df: df.withColumn("versions_key", F.col("model_version"))
    requests = key(f["wanted"]).select("run_id", "namespace", "value", "configuration_digest", "versions_key", F.col("run_id").alias("created_at"))
    return requests, key(f["recording_outcomes"].where("state in ('pending', 'covered') and cast(value as bigint) % 3 = 0"))


@query("claim_recordings", """SELECT run_id, namespace, value FROM (SELECT r.*, row_number() OVER (PARTITION BY r.namespace, r.value, r.configuration_digest, r.model_version ORDER BY r.run_id) AS rn FROM requests r
  WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.run_id = r.run_id AND h.namespace = r.namespace AND h.value = r.value)
  AND NOT EXISTS (SELECT 1 FROM held h WHERE h.namespace = r.namespace AND h.value = r.value AND h.configuration_digest = r.configuration_digest AND h.model_version = r.model_version)) x WHERE rn = 1""", CLAIM_SQL)
def _(spark, f, d):
    return L.claims(*_claims(f)).select("run_id", "namespace", "value")


@query("skip_reasons", "SELECT r.run_id, r.namespace, r.value, CASE WHEN h.state = 'covered' THEN 'already_covered' ELSE 'in_progress' END AS skip_reason FROM requests r JOIN held h ON h.namespace = r.namespace AND h.value = r.value AND h.configuration_digest = r.configuration_digest AND h.model_version = r.model_version WHERE h.run_id <> r.run_id", CLAIM_SQL)
def _(spark, f, d):
    return L.skip_reasons(*_claims(f))


@query("backbone_inputs", """SELECT q.run_id, q.namespace, q.value, CASE WHEN c.run_id IS NULL THEN 'input_not_available' WHEN o.uri IS NULL THEN 'input_has_no_windows' WHEN o.run_id % 5 = 0 THEN 'input_location_unsupported' END AS skip_reason,
  CASE WHEN o.run_id % 5 <> 0 THEN o.uri END AS uri FROM run_recordings q
  LEFT JOIN (SELECT o.* FROM recording_outcomes o JOIN runs r ON r.run_id = o.run_id AND NOT r.withdrawn WHERE o.state = 'covered' AND o.configuration_digest = 'cfg0' AND o.model_version = 3) c ON c.namespace = q.namespace AND c.value = q.value
  LEFT JOIN (SELECT * FROM output_files WHERE kind = 'embeddings' AND CAST(value AS BIGINT) % 7 > 0) o ON o.run_id = c.run_id AND o.namespace = c.namespace AND o.value = c.value""")
def _(spark, f, d):
    backbone = f["recording_outcomes"].where("configuration_digest = 'cfg0' and model_version = 3")
    accepted = (T.location_form(F.col("uri")) == "s3") & (F.col("backbone_run") % 5 != 0)
    return L.backbone_inputs(f["run_recordings"], backbone, f["runs"], f["output_files"].where("cast(value as bigint) % 7 > 0"), accepted)


@query("task_chunks", "SELECT run_id, namespace, value, (row_number() OVER (PARTITION BY run_id ORDER BY namespace, value) - 1) // 25 AS task FROM recording_outcomes WHERE state = 'pending'")
def _(spark, f, d):
    return L.task_chunks(f["recording_outcomes"].where("state = 'pending'").select("run_id", "namespace", "value"), 25)


@query("presets_of_config", "SELECT r.run_id, r.configuration_digest, coalesce(string_agg(p.name, ',' ORDER BY p.name), '') AS presets FROM runs r LEFT JOIN presets p ON p.configuration_digest = r.configuration_digest GROUP BY r.run_id, r.configuration_digest")
def _(spark, f, d):
    return L.presets_of(f["runs"].select("run_id", "configuration_digest"), f["presets"]).withColumn("presets", F.array_join("presets", ","))


@query("first_writer_wins", """SELECT o_orderkey AS entry_id, name, CASE WHEN rn = 1 THEN 'created' WHEN digest = standing THEN 'exists' ELSE 'conflict' END AS outcome, standing FROM (SELECT *, row_number() OVER w AS rn, first_value(digest) OVER w AS standing FROM
  (SELECT o_orderkey, 'preset' || (o_custkey % 50) AS name, 'd' || (o_orderkey % 3) AS digest, o_orderdate FROM orders) x WINDOW w AS (PARTITION BY name ORDER BY o_orderdate, o_orderkey)) y""")
def _(spark, f, d):
    entries = f["orders"].select(F.col("o_orderkey").alias("entry_id"), F.concat(F.lit("preset"), F.col("o_custkey") % 50).alias("name"), F.concat(F.lit("d"), F.col("o_orderkey") % 3).alias("digest"), F.col("o_orderdate").alias("created_at"))
    return L.first_writers(entries)


@query("outdated_versions", "SELECT run_id, 'model:a/v4' AS version_id, CAST(model_version AS BIGINT) AS version, CAST(2 AS BIGINT) AS released FROM runs WHERE model_version <> 2 UNION ALL SELECT run_id, 'gone', 1, NULL FROM runs WHERE run_id % 9 = 0")
def _(spark, f, d):
    runs = f["runs"].withColumn("output_versions", F.expr("CASE WHEN run_id % 9 = 0 THEN map('model:a/v4', cast(model_version as bigint), 'gone', 1L) ELSE map('model:a/v4', cast(model_version as bigint)) END"))
    release = f["region"].where("r_regionkey = 0").select(F.lit("model:a/v4").alias("version_id"), F.lit(2).cast("long").alias("released"))
    return L.outdated_versions(runs, release)


# filters and pages


@query("selection_test", "SELECT namespace, value FROM recordings WHERE namespace BETWEEN 'src1' AND 'src3' AND value IN (SELECT CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 2 = 0) AND namespace <> 'src2'")
def _(spark, f, d):
    rows = f["recordings"].where(T.selection_test(F.col("namespace"), {"from": "src1", "to": "src3"}))
    return rows.where(~T.selection_test(F.col("namespace"), ["src2"]) & T.selection_test((F.col("value").cast("long") % 2).cast("string"), "0")).select("namespace", "value")


@query("runs_filter", "SELECT event_id AS run_id, user_id AS submitted_by, ts AS created_at FROM events WHERE user_id % 3 = 1 AND ts > (SELECT min(ts) + INTERVAL 10 DAY FROM events)")
def _(spark, f, d):
    runs = f["events"].select(F.col("event_id").alias("run_id"), F.col("user_id"), F.col("ts").alias("created_at")).withColumn("submitted_by", (F.col("user_id") % 3).cast("string"))
    after = runs.agg(F.min("created_at") + F.expr("INTERVAL 10 DAYS")).first()[0]
    # the same time two hours further east
    return P.runs_filter(runs, "1", (after + timedelta(hours=2)).isoformat() + "+02:00").select("run_id", F.col("user_id").alias("submitted_by"), "created_at")


@query("recordings_filter", "SELECT run_id, namespace, value, state, skip_reason FROM recording_outcomes WHERE state = 'skipped' AND skip_reason = 'in_progress'")
def _(spark, f, d):
    return P.recordings_filter(f["recording_outcomes"], "skipped", "in_progress").select("run_id", "namespace", "value", "state", "skip_reason")


def _kept(spark: SparkSession, rows: DataFrame, keys: list[str]) -> Q.KeptList:
    return Q.keep_list(rows, keys, shared_folder(spark, "list"), 2_000)


@query("keyset_page", "SELECT event_id, ts, event_type FROM events WHERE (ts, event_id) > (SELECT ts, event_id FROM events ORDER BY ts, event_id LIMIT 1 OFFSET 100) ORDER BY ts, event_id LIMIT 101".replace("(ts, event_id) > (SELECT ts, event_id FROM events ORDER BY ts, event_id LIMIT 1 OFFSET 100)", "ts > (SELECT ts FROM (SELECT ts, event_id FROM events ORDER BY ts, event_id LIMIT 1 OFFSET 99) a) OR (ts = (SELECT ts FROM (SELECT ts, event_id FROM events ORDER BY ts, event_id LIMIT 1 OFFSET 99) b) AND event_id > (SELECT event_id FROM (SELECT ts, event_id FROM events ORDER BY ts, event_id LIMIT 1 OFFSET 99) c))"))
def _(spark, f, d):
    kept = _kept(spark, f["events"].select("event_id", "ts", "event_type"), ["ts", "event_id"])
    _, cursor = Q.next_kept_page(kept, "events", {}, 100)
    return Q.kept_page(kept, 100, P.Cursor("events", {}).read(cursor, 2))


@query("newest_runs_page", "SELECT run_id, submitted_by FROM runs WHERE submitted_by < 'actor2' OR (submitted_by = 'actor2' AND run_id < 40) ORDER BY submitted_by DESC, run_id DESC LIMIT 21")
def _(spark, f, d):
    return Q.kept_page(_kept(spark, f["runs"].select("run_id", "submitted_by"), ["submitted_by", "run_id"]), 20, ["actor2", 40], descending=True)


@query("recordings_page", "SELECT r.namespace, r.value, o.state FROM run_recordings r LEFT JOIN (SELECT * FROM recording_outcomes WHERE state <> 'released') o ON o.run_id = r.run_id AND o.namespace = r.namespace AND o.value = r.value WHERE r.run_id = 1 AND r.value > '2' ORDER BY r.namespace, r.value LIMIT 51")
def _(spark, f, d):
    outcomes = f["recording_outcomes"].where("state <> 'released'").select("run_id", "namespace", "value", "state")
    rows = f["run_recordings"].join(outcomes, ["run_id", "namespace", "value"], "left")  # of all runs
    kept = _kept(spark, rows.select("run_id", "namespace", "value", "state"), ["run_id", "namespace", "value"])
    return Q.kept_page(kept, 50, [1, "survey", "2"], within=[1]).drop("run_id")


@query("tasks_page", "SELECT run_id, task FROM (SELECT DISTINCT run_id, (row_number() OVER (PARTITION BY run_id ORDER BY namespace, value) - 1) // 5 AS task FROM recording_outcomes WHERE state = 'pending') x WHERE run_id > 3 OR (run_id = 3 AND task > 1) ORDER BY run_id, task LIMIT 31")
def _(spark, f, d):
    tasks = L.task_chunks(f["recording_outcomes"].where("state = 'pending'").select("run_id", "namespace", "value"), 5).select("run_id", "task").distinct()
    return Q.kept_page(_kept(spark, tasks, ["run_id", "task"]), 30, [3, 1])


# embeddings and heads


@query("narrow_embedding", """SELECT vec_id, code, CASE WHEN code IS NULL THEN CASE WHEN x = 0 THEN 0 ELSE round_even(x / s, 0) * s END END AS half FROM
  (SELECT *, pow(2.0::DOUBLE, greatest(floor(log2(abs(nullif(x, 0)))), -14) - 10) AS s FROM
  (SELECT vec_id, embedding[1]::DOUBLE * CASE WHEN vec_id % 3 = 0 THEN 1e-5::DOUBLE ELSE 1::DOUBLE END AS x, CASE WHEN vec_id % 10 = 0 THEN 'embedding_value_out_of_storage_dtype_range' END AS code FROM windows) a) b""")
def _(spark, f, d):
    scaled = F.transform("embedding", lambda x: F.when(F.col("vec_id") % 10 == 0, F.lit(70_000.0)).otherwise(x.cast("double") * F.when(F.col("vec_id") % 3 == 0, 1e-5).otherwise(1.0)))
    rows = f["windows"].withColumn("wide", scaled)
    code = I.narrow_code(F.col("wide"), half=True)
    return rows.select("vec_id", code.alias("code"), F.when(code.isNull(), I.narrow_half(F.col("wide"))[0].cast("double")).alias("half"))


@query("verify_head_input", "SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 'head_input_backbone_mismatch' WHEN vec_id % 7 = 0 THEN 'head_input_width_mismatch' WHEN vec_id % 11 = 0 THEN 'head_input_recipe_differs' WHEN vec_id % 13 = 0 THEN 'head_input_recording_mismatch' END AS code FROM windows")
def _(spark, f, d):
    v = F.col("vec_id")
    want = {"backbone": F.lit("b"), "card": F.lit("c"), "dim": F.lit("64"), "recipe": F.lit("r"), "namespace": F.col("namespace"), "value": F.col("value")}
    code = I.head_input_code(
        F.when(v % 5 == 0, "x").otherwise("b"), F.lit("c"), F.when(v % 7 == 0, "32").otherwise(F.size("embedding").cast("string")), F.when(v % 11 != 0, "r"),
        F.col("namespace"), F.when(v % 13 == 0, "other").otherwise(F.col("value")), want,
    )
    return f["windows"].select("vec_id", code.alias("code"))


@query("read_head_input", "SELECT namespace, value, window_start_s, len(embedding) AS dim, round(embedding[1]::DOUBLE, 6) AS first, round(embedding[64]::DOUBLE, 6) AS last FROM windows")
def _(spark, f, d):
    e = I.narrow_float(F.col("embedding"))
    return f["windows"].select("namespace", "value", "window_start_s", F.size(e).cast("long").alias("dim"), F.round(e[0].cast("double"), 6).alias("first"), F.round(e[63].cast("double"), 6).alias("last"))


KERNEL_SQL = "dots AS (SELECT vec_id, l, sum(embedding[i + 1]::DOUBLE * ((((i * 7 + l * 3) % 11) - 5) / 10.0e0)) + l / 10.0e0 AS logit FROM windows CROSS JOIN (SELECT unnest(range(0, 64)) AS i) a CROSS JOIN (SELECT unnest(range(0, 5)) AS l) b GROUP BY vec_id, l)"


def _head(f, activate):
    kernel = [[(((i * 7 + k * 3) % 11) - 5) / 10.0 for k in range(5)] for i in range(64)]
    out = I.linear_head(f["windows"], kernel, [k / 10.0 for k in range(5)], ["vec_id"], activate)
    return out.select("vec_id", F.posexplode("logits").alias("l", "x"))


@query("classifier_layer", "SELECT vec_id, CAST(l AS BIGINT) AS l, round(logit, 4) + 0.0e0 AS logit FROM dots", KERNEL_SQL)
def _(spark, f, d):
    return _head(f, False).select("vec_id", F.col("l").cast("long").alias("l"), (F.round("x", 4) + 0.0).alias("logit"))


@query("score_head", "SELECT vec_id, CAST(l AS BIGINT) AS l, round(1 / (1 + exp(-logit)), 4) AS score FROM dots", KERNEL_SQL)
def _(spark, f, d):
    return _head(f, True).select("vec_id", F.col("l").cast("long").alias("l"), F.round("x", 4).alias("score"))


@query("sigmoid", "SELECT vec_id, round(1 / (1 + exp(-(embedding[1]::DOUBLE * 100))), 6) AS score FROM windows")
def _(spark, f, d):
    logits = F.transform("embedding", lambda x: x.cast("double") * 100)
    return f["windows"].select("vec_id", F.round(I.sigmoid(logits)[0], 6).alias("score"))


@query("sigmoid_clipped", "SELECT vec_id, round(1 / (1 + exp(-greatest(least(embedding[1]::DOUBLE * 200, 15), -15))), 9) AS score FROM windows")
def _(spark, f, d):
    logits = F.transform("embedding", lambda x: x.cast("double") * 200)
    return f["windows"].select("vec_id", F.round(I.sigmoid(logits, 15.0)[0], 9).alias("score"))


@query("logits_check", "SELECT vec_id, CASE WHEN vec_id % 4 = 0 THEN 'wrong_shape' WHEN vec_id % 9 = 0 THEN 'not_finite' END AS code FROM windows")
def _(spark, f, d):
    logits = F.when(F.col("vec_id") % 4 == 0, F.slice("embedding", 1, 9)).when(F.col("vec_id") % 9 == 0, F.concat(F.slice("embedding", 1, 9), F.array(F.lit("NaN").cast("float")))).otherwise(F.slice("embedding", 1, 10))
    return f["windows"].select("vec_id", I.logits_code(logits, 10).alias("code"))


# identity, paths and text


@query("canonical_json", """SELECT namespace, value, '{"audio_uri":"' || audio_uri || '","duration_seconds":' || coalesce(CAST(duration_seconds AS VARCHAR), 'null') || ',"namespace":"' || namespace || '","value":"' || value || '"}' AS json FROM recordings""")
def _(spark, f, d):
    return f["recordings"].select("namespace", "value", _recording_json().alias("json"))


def _recording_json():
    return T.canonical_json({"namespace": T.json_text(F.col("namespace")), "value": T.json_text(F.col("value")), "audio_uri": T.json_text(F.col("audio_uri")), "duration_seconds": T.double_text(F.col("duration_seconds"))})


JSON_SQL = """'{"audio_uri":"' || audio_uri || '","duration_seconds":' || coalesce(CAST(duration_seconds AS VARCHAR), 'null') || ',"namespace":"' || namespace || '","value":"' || value || '"}'"""


@query("sha256_v1", f"SELECT namespace, value, 'sha256:v1:' || sha256({JSON_SQL}) AS digest FROM recordings")
def _(spark, f, d):
    return f["recordings"].select("namespace", "value", T.sha256_v1(_recording_json()).alias("digest"))


@query("work_digest", f"""SELECT namespace, value, 'sha256:v1:' || sha256('{{"outputs":["scores"],"recordings":[' || {JSON_SQL} || '],"schema_version":"work/1"}}') AS digest FROM recordings""")
def _(spark, f, d):
    work = T.canonical_json({"schema_version": F.lit('"work/1"'), "outputs": F.lit('["scores"]'), "recordings": F.concat(F.lit("["), _recording_json(), F.lit("]"))})
    return f["recordings"].select("namespace", "value", T.sha256_v1(work).alias("digest"))


@query("config_digests", """SELECT run_id, 'sha256:v1:' || sha256('{"model":"a/v4","outputs":[{"kind":"detections","min_score":0.5},{"kind":"scores","min_score":0.1}],"settings":{"version":' || model_version || ',"window_overlap":0.0}}') AS digest FROM runs""")
def _(spark, f, d):
    kinds = F.array_sort(F.array(F.struct(F.lit("scores").alias("kind"), F.lit(0.1).alias("min_score")), F.struct(F.lit("detections").alias("kind"), F.lit(0.5).alias("min_score"))))
    outputs = F.concat(F.lit("["), F.array_join(F.transform(kinds, lambda k: F.concat(F.lit('{"kind":"'), k["kind"], F.lit('","min_score":'), T.double_text(k["min_score"]), F.lit("}"))), ","), F.lit("]"))
    settings = T.canonical_json({"version": F.col("model_version").cast("string"), "window_overlap": T.double_text(F.lit(0.0))})
    return f["runs"].select("run_id", T.sha256_v1(T.canonical_json({"model": F.lit('"a/v4"'), "outputs": outputs, "settings": settings})).alias("digest"))


@query("audio_uri", "SELECT namespace, value, CASE CAST(value AS BIGINT) % 4 WHEN 0 THEN audio_uri WHEN 1 THEN 'file:///data/a%20b/' || value || '%C3%A9.wav' WHEN 2 THEN 'file:///root/' || value || '.wav' END AS uri FROM recordings")
def _(spark, f, d):
    v = F.col("value").cast("long") % 4
    location = F.when(v == 0, F.col("audio_uri")).when(v == 1, F.concat(F.lit("/data/a b/"), F.col("value"), F.lit("é.wav"))).when(v == 2, F.concat(F.lit("file:///root/"), F.col("value"), F.lit(".wav"))).otherwise(F.concat(F.lit("file:///a b/"), F.col("value")))
    return f["recordings"].select("namespace", "value", T.audio_uri(location).alias("uri"))


@query("index_uris", "SELECT event_id, 's3://out/index/history/' || strftime(ts, '%Y%m%dT%H%M%SZ') || '/current_files.parquet' AS dated, 's3://out/index/current_files.parquet' AS current FROM events")
def _(spark, f, d):
    dated, current = T.index_uris(F.lit("s3://out"), F.col("ts"))
    return f["events"].select("event_id", dated.alias("dated"), current.alias("current"))


@query("hive_layout", "SELECT namespace, value, 'scores/recording_namespace=' || namespace || '/recording_value=a%20b%2F~%2A%C3%A9-' || value || '/scores.parquet' AS path FROM recordings")
def _(spark, f, d):
    return f["recordings"].select("namespace", "value", T.hive_layout(F.lit("scores"), F.col("namespace"), F.concat(F.lit("a b/~*é-"), F.col("value"))).alias("path"))


@query("location_form", "SELECT namespace, value, CASE CAST(value AS BIGINT) % 5 WHEN 0 THEN 's3' WHEN 1 THEN 'bundled' WHEN 2 THEN 'file' WHEN 3 THEN 'path' END AS form, CAST(value AS BIGINT) % 5 NOT IN (0, 3) AS refused FROM recordings")
def _(spark, f, d):
    v = F.col("value").cast("long") % 5
    location = F.when(v == 0, F.col("audio_uri")).when(v == 1, F.lit("bundled:a/b")).when(v == 2, F.lit("file:///x")).when(v == 3, F.lit("/x/y")).otherwise(F.lit("x/y"))
    rows = f["recordings"].select("namespace", "value", T.location_form(location).alias("form"))
    return rows.withColumn("refused", ~F.coalesce(F.col("form").isin("s3", "path"), F.lit(False)))


@query("storable_text", "SELECT namespace, value, CAST(value AS BIGINT) % 3 = 0 AS storable FROM recordings")
def _(spark, f, d):
    v = F.col("value").cast("long") % 3
    text = F.when(v == 0, F.col("audio_uri")).when(v == 1, F.lit("")).otherwise(F.concat("value", F.lit("\x00")))
    return f["recordings"].select("namespace", "value", T.storable(text).alias("storable"))


@query("digest_syntax", "SELECT namespace, value, CAST(value AS BIGINT) % 3 = 0 AS canonical, CAST(value AS BIGINT) % 3 = 1 AS checksum FROM recordings")
def _(spark, f, d):
    v = F.col("value").cast("long") % 3
    text = F.concat(F.when(v == 0, "sha256:v1:").when(v == 1, "sha256:").otherwise("md5:"), F.sha2("value", 256))
    return f["recordings"].select("namespace", "value", T.is_canonical_digest(text).alias("canonical"), T.is_checksum(text).alias("checksum"))


@query("location_under_root", "SELECT run_id, namespace, value, kind, CAST(value AS BIGINT) % 3 = 0 AS below FROM output_files")
def _(spark, f, d):
    v = F.col("value").cast("long") % 3
    root = F.when(v == 1, F.lit("s3://other")).otherwise(F.concat(F.lit("s3://out/"), F.col("run_id"), F.lit("/")))
    uri = F.when(v == 2, F.replace("uri", F.concat(F.lit("/"), F.col("value")), F.concat(F.lit("/../"), F.col("value")))).otherwise(F.col("uri"))
    return f["output_files"].select("run_id", "namespace", "value", "kind", T.under_root(uri, root).alias("below"))


# user models


@I.register_model("mean/1")
def _mean(batches):
    for batch in batches:
        out = batch[["namespace", "value", "arrival", "window_start_s", "window_end_s"]].copy()
        sums = np.stack(batch["embedding"].to_numpy()).astype(np.float64).sum(axis=1) if len(batch) else np.empty(0)
        out["scores"] = list((1 / (1 + np.exp(-sums)))[:, None])
        yield out


@query("model_udf", "SELECT namespace, value, arrival, window_start_s, round(1 / (1 + exp(-list_sum(list_transform(embedding, lambda x: x::DOUBLE)))), 4) AS score FROM (SELECT *, vec_id AS arrival FROM windows) x")
def _(spark, f, d):
    inputs = f["windows"].withColumn("arrival", F.col("vec_id"))
    out = I.run_model("mean/1", inputs, "namespace string, value string, arrival long, window_start_s double, window_end_s double, scores array<double>")
    return out.select("namespace", "value", "arrival", "window_start_s", F.round(F.col("scores")[0], 4).alias("score"))
