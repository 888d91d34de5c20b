"""Views over the test tables that have the shape of recordings, windows, scores, runs and output files.

One text serves Spark and the SQL oracle: ``{S}`` stands for the engine's text type.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: In the order in which they build on each other.
VIEWS = {
    "recordings": """SELECT source AS namespace, CAST(doc_id AS {S}) AS value,
  concat('s3://audio/', source, '/', CAST(doc_id AS {S}), '.wav') AS audio_uri,
  CASE WHEN doc_id % 17 = 0 THEN NULL ELSE n_chars / 60.0e0 END AS duration_seconds FROM documents""",
    "registry": """SELECT n_nationkey AS class_index, n_name AS label,
  CASE WHEN n_nationkey % 5 = 0 THEN 'non_taxonomic' WHEN n_nationkey % 5 = 1 THEN 'unresolved' ELSE 'taxon' END AS label_kind,
  CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE concat('Genus species', CAST(n_nationkey AS {S})) END AS scientific_name,
  concat('common ', n_name) AS common_name,
  CASE WHEN n_nationkey % 5 < 2 THEN NULL ELSE CAST(5000000 + n_nationkey AS BIGINT) END AS gbif_taxon_key FROM nation""",
    "windows": """SELECT 'emb' AS namespace, CAST(CAST(floor(vec_id / 20.0e0) AS BIGINT) AS {S}) AS value,
  (vec_id % 20) * 3.0e0 AS window_start_s, (vec_id % 20) * 3.0e0 + 3.0e0 AS window_end_s, vec_id, embedding FROM embeddings""",
    "scores": """SELECT w.namespace, w.value, w.window_start_s, w.window_end_s, r.class_index, r.label,
  ((w.vec_id * 31 + r.class_index * 17 + (w.vec_id % 7) * (r.class_index % 11)) % 11) / 10.0e0 AS score FROM windows w CROSS JOIN registry r""",
    "runs": """SELECT s_suppkey AS run_id, concat('actor', CAST(s_nationkey % 3 AS {S})) AS submitted_by,
  CASE WHEN s_suppkey % 11 = 10 THEN 'preparing' ELSE 'ready' END AS state,
  (s_suppkey % 13 = 12) AS cancelled, (s_suppkey % 7 = 6) AS withdrawn,
  concat('cfg', CAST(s_suppkey % 4 AS {S})) AS configuration_digest, 1 + s_suppkey % 3 AS model_version FROM supplier""",
    "run_recordings": """SELECT DISTINCT l_suppkey AS run_id, 'survey' AS namespace, CAST(l_partkey AS {S}) AS value FROM lineitem""",
    "wanted": """SELECT l.l_suppkey AS run_id, 'survey' AS namespace, CAST(l.l_partkey AS {S}) AS value, r.configuration_digest, r.model_version,
  CASE WHEN min(l.l_linenumber) = 4 THEN 'failed' WHEN min(l.l_linenumber) > 5 THEN 'released'
       WHEN r.withdrawn THEN 'withdrawn' WHEN min(l.l_linenumber) = 5 THEN 'pending' ELSE 'covered' END AS state
  FROM lineitem l JOIN runs r ON r.run_id = l.l_suppkey GROUP BY l.l_suppkey, l.l_partkey, r.configuration_digest, r.model_version, r.withdrawn""",
    "recording_outcomes": """SELECT run_id, namespace, value, configuration_digest, model_version,
  CASE WHEN live AND rn > 1 THEN 'skipped' ELSE state END AS state,
  CASE WHEN live AND rn > 1 THEN CASE WHEN holder = 'covered' THEN 'already_covered' ELSE 'in_progress' END END AS skip_reason
  FROM (SELECT w.*, row_number() OVER p AS rn, first_value(state) OVER p AS holder
      FROM (SELECT *, state IN ('covered', 'pending') AS live FROM wanted) w
      WINDOW p AS (PARTITION BY namespace, value, configuration_digest, model_version, live ORDER BY run_id)) x""",
    "output_files": """SELECT o.run_id, o.namespace, o.value, k.kind, concat(k.kind, '.parquet/1') AS contract_id,
  concat('s3://out/', CAST(o.run_id AS {S}), '/', o.value, '.', k.kind, '.parquet') AS uri
  FROM recording_outcomes o CROSS JOIN (SELECT 'scores' AS kind UNION ALL SELECT 'embeddings' AS kind) k WHERE o.state IN ('covered', 'withdrawn')""",
    # windows as a model might return them, with one defect in some of them
    "bad_windows": """SELECT namespace, value, vec_id AS arrival,
  CASE WHEN vec_id % 101 = 0 THEN window_start_s + 0.1e0 WHEN vec_id % 109 = 0 THEN window_start_s - 600.0e0 WHEN vec_id % 107 = 0 THEN window_start_s - 3.0e0 ELSE window_start_s END AS window_start_s,
  CASE WHEN vec_id % 101 = 0 THEN window_end_s + 0.1e0 WHEN vec_id % 109 = 0 THEN window_end_s - 600.0e0 WHEN vec_id % 107 = 0 THEN window_end_s - 3.0e0 WHEN vec_id % 103 = 0 THEN window_end_s - 0.5e0 ELSE window_end_s END AS window_end_s,
  vec_id % 113 = 0 AS bad_score, vec_id % 127 = 0 AS short_embedding, embedding FROM windows""",
    "kept_windows": """SELECT namespace, value, window_start_s, window_end_s, vec_id AS arrival, vec_id % 26 AS kept,
  CASE WHEN vec_id % 5 = 0 THEN NULL ELSE embedding END AS embedding FROM windows WHERE vec_id % 60 < 40""",
    "window_recordings": """SELECT DISTINCT namespace, value FROM windows""",
    "recording_ends": """SELECT namespace, value, CAST(value AS BIGINT) % 5 AS detection_rows, CASE WHEN CAST(value AS BIGINT) % 3 = 2 THEN 'shorter_than_window' END AS zero_window_reason,
  CASE WHEN CAST(value AS BIGINT) % 4 > 0 THEN concat('sha256:', value) END AS input_checksum FROM window_recordings""",
    "coverage_rows": """SELECT namespace, value, CAST(value AS BIGINT) AS d, CAST(value AS BIGINT) % 7 AS windows_completed, CAST(value AS BIGINT) % 5 AS score_rows,
  CAST(value AS BIGINT) % 9 AS embedding_rows, CAST(value AS BIGINT) % 6 AS detection_rows,
  CASE WHEN CAST(value AS BIGINT) % 11 = 0 THEN NULL ELSE CAST(value AS BIGINT) % 13 - 1.0e0 END AS first_window_start_s,
  CASE WHEN CAST(value AS BIGINT) % 17 = 0 THEN NULL ELSE (CAST(value AS BIGINT) % 3) * 3.0e0 END AS last_window_end_s,
  CASE WHEN CAST(value AS BIGINT) % 4 = 0 THEN 'shorter_than_window' END AS reason FROM recordings""",
    "artifact_rows": """SELECT 'scores' AS kind, namespace, value, score_rows + CASE WHEN d % 19 = 0 THEN 1 ELSE 0 END AS rows FROM coverage_rows WHERE score_rows > 0
  UNION ALL SELECT 'embeddings', namespace, value, embedding_rows FROM coverage_rows WHERE embedding_rows > 0 AND d % 23 > 0
  UNION ALL SELECT 'detections', namespace, value, detection_rows FROM coverage_rows WHERE detection_rows > 0
  UNION ALL SELECT 'detections', namespace, value, detection_rows FROM coverage_rows WHERE detection_rows > 0 AND d % 29 = 0""",
    "failures": """SELECT run_id, namespace, value, CASE WHEN CAST(value AS BIGINT) % 3 = 0 THEN 'work' ELSE 'recording' END AS scope,
  concat('code', CAST(CAST(value AS BIGINT) % 40 AS {S})) AS code,
  CASE CAST(value AS BIGINT) % 5 WHEN 0 THEN 'infer' WHEN 1 THEN 'load_registry' WHEN 2 THEN 'aggregate' WHEN 3 THEN 'construct_model' ELSE 'elsewhere' END AS stage
  FROM recording_outcomes WHERE state = 'failed'""",
    "pending_tasks": """SELECT run_id, CASE WHEN run_id % 2 = 0 THEN 'queued' ELSE 'running' END AS state, count(*) AS n FROM recording_outcomes WHERE state = 'pending' GROUP BY run_id""",
    "presets": """SELECT concat('preset', CAST(n_nationkey AS {S})) AS name, concat('cfg', CAST(n_nationkey % 3 AS {S})) AS configuration_digest FROM nation""",
    "window_configs": """SELECT 3.0e0 AS win, 0.0e0 AS overlap, 'drop' AS pad UNION ALL SELECT 5.0e0, 2.5e0, 'centre_crop_end_pad'
  UNION ALL SELECT 12.0e0, 0.0e0, 'drop' UNION ALL SELECT 0.7e0, 0.0e0, 'time_scaled'""",
}


class Views(dict):
    """Tables and views as DataFrames, made when first asked for; their plans do not change when others are loaded."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name in VIEWS:
            for other in re.findall(r"\b(?:FROM|JOIN) (\w+)", VIEWS[name]):
                self[other].createOrReplaceTempView(other)
            frame = self._spark.sql(VIEWS[name].format(S="STRING"))
        else:
            frame = self._spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
        frame.createOrReplaceTempView(name)
        self[name] = frame
        return frame


def load(spark: SparkSession, sf_dir: str) -> Views:
    return Views(spark, sf_dir)


def ctes(*more: str) -> str:
    """WITH clause of all views for the SQL oracle, followed by further ``name AS (...)`` entries."""
    return "WITH " + ",\n".join([*(f"{name} AS ({text.format(S='VARCHAR')})" for name, text in VIEWS.items()), *more]) + "\n"
