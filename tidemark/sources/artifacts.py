"""Score, embedding and detection files: writers, verified readers, headers and the catalog of published files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.lineage import small
from .artifact_files import KEY, PREFIX, ArtifactRefused, file_records, read_artifacts, refuse_bad, verified_files  # noqa: F401

SCORES = "namespace string, value string, window_start_s double, window_end_s double, label string, score double"
EMBEDDINGS = "namespace string, value string, window_start_s double, window_end_s double, embedding array<float>"
DETECTIONS = (
    "namespace string, value string, window_start_s double, window_end_s double, label string, label_kind string, score double, rank int, "
    "scientific_name string, common_name string, gbif_taxon_key bigint"
)
#: Header entries that every file needs.
REQUIRED = tuple(PREFIX + k for k in ("contract", "recipe_fingerprint", "recording_namespace", "recording_value"))


def write_rows(rows: DataFrame, path: str, order: list[str]) -> None:
    """Sorted zstd Parquet, dealt by recording, so that no window is split over files and empty results have no row."""
    rows.repartition(*KEY).sortWithinPartitions(*KEY, *order).write.option("compression", "zstd").mode("errorifexists").parquet(path)


def write_scores(rows: DataFrame, path: str) -> None:
    write_rows(rows.select("namespace", "value", "window_start_s", "window_end_s", "label", "score"), path, ["window_start_s", "label"])


def write_embeddings(rows: DataFrame, path: str) -> None:
    """Windows that carry a vector."""
    kept = rows.where("embedding is not null").select("namespace", "value", "window_start_s", "window_end_s", F.col("embedding").cast("array<float>").alias("embedding"))
    write_rows(kept, path, ["window_start_s"])


def write_detections(rows: DataFrame, path: str) -> None:
    write_rows(rows, path, ["window_start_s", "rank"])


#: Columns of the files that Spark writes, by kind.
TABLES = {"scores": SCORES, "embeddings": EMBEDDINGS, "detections": DETECTIONS}


def _read_table(spark: SparkSession, path: str, kind: str, expected: DataFrame | None, refuse: bool) -> DataFrame:
    verdicts = verified_files(spark, path, kind, expected, form="table")
    if refuse:
        refuse_bad(verdicts)
        return spark.read.schema(TABLES[kind]).option("recursiveFileLookup", True).parquet(path)
    fine = [r["path"] for r in verdicts.where("code is null").select("path").collect()]  # names, as Spark lists them to read a folder
    return spark.read.schema(TABLES[kind]).parquet(*fine) if fine else spark.createDataFrame([], TABLES[kind])


def read_scores(spark: SparkSession, path: str, expected: DataFrame | None = None, refuse: bool = True, form: str = "file") -> DataFrame:
    """Rows of score files whose bytes, schema and header are right; others are refused, or left out if not ``refuse``.

    The form "file" is one recording with its header, "table" what Spark wrote (``write_scores``); see ``verified_files``.
    """
    return read_artifacts(spark, path, "scores", expected, refuse) if form == "file" else _read_table(spark, path, "scores", expected, refuse)


def read_embeddings(spark: SparkSession, path: str, dim: int | None = None, expected: DataFrame | None = None, refuse: bool = True, form: str = "file") -> DataFrame:
    """Vectors of files that are right as in ``read_scores``.

    In the form "file" width and storage type are the header's, and the columns' types must agree. A "table" has no
    header, so there vectors get a ``code`` where their width is not ``dim``.
    """
    if form == "file":
        return read_artifacts(spark, path, "embeddings", expected, refuse)
    rows = _read_table(spark, path, "embeddings", expected, refuse)
    return rows.withColumn("code", F.when(F.size("embedding") != dim, "embedding_width_differs"))


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DETECTIONS).parquet(path)


def null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a null in each column that may have none; Spark reads every Parquet column as nullable."""
    counts = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], columns, "column", "nulls")


def provenance_header(rows: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Identity and a map ``header`` of the fields that are not null, kept beside the data."""
    pairs = [x for name, value in sorted(fields.items()) for x in (F.lit(PREFIX + name), value)]
    return rows.select(*KEY, F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()).alias("header"))


def header_problems(headers: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Required keys that a header lacks, and half registry bindings (a uri without a fingerprint or the reverse)."""
    own = F.map_filter("header", lambda k, v: k.startswith(PREFIX))
    missing = F.array_except(F.array(*map(F.lit, required)), F.map_keys(own))
    half = F.map_contains_key(own, PREFIX + "registry_uri") != F.map_contains_key(own, PREFIX + "registry_fingerprint")
    problems = F.concat(F.transform(missing, lambda k: F.concat(F.lit("missing "), k)), F.when(half, F.array(F.lit("half registry binding"))).otherwise(F.array().cast("array<string>")))
    return headers.select(*KEY, F.explode(problems).alias("problem"))


def publish_or_replay(incoming: DataFrame, published: DataFrame) -> DataFrame:
    """What publishing each artifact would be: new, a replay of the same bytes, or a conflict."""
    known = published.select("kind", *KEY, F.col("checksum").alias("known"))
    outcome = F.when(F.col("known").isNull(), "new").when(F.col("known") == F.col("checksum"), "replay").otherwise("conflict")
    return incoming.join(known, ["kind", *KEY], "left").select("kind", *KEY, "checksum", outcome.alias("outcome"))


def artifact_records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A catalog row for each good file of a kind below ``path``: contract, recording, uri, checksum, size and rows, as they are in the file."""
    return file_records(verified_files(spark, path, kind, hashed=True), kind)


RESULT = (
    "task_id long, run_id long, outcome string, failure struct<code:string,stage:string,detail:string>, "
    "coverage array<struct<namespace:string,value:string,windows_completed:bigint,first_window_start_s:double,last_window_end_s:double,input_checksum:string>>, "
    "failed array<struct<namespace:string,value:string,code:string,stage:string,detail:string>>, "
    "artifacts array<struct<kind:string,contract_id:string,namespace:string,value:string,uri:string,checksum:string,size_bytes:bigint,rows:bigint>>"
)
COVERED = ["windows_completed", "first_window_start_s", "last_window_end_s", "input_checksum"]
FAILED = ["scope", "code", "stage", "message"]


def ingest_results(results: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(outcomes after the results, files that the results add); only pending recordings change.

    A covered recording has its windows, bounds and input checksum; a failed one the scope, code, stage and message of
    its failure. A result that failed as a whole fails every pending recording of its task (outcomes have ``task_id``).
    Each task has one result; each artifact of a completed one is a row of the files. Only pending recordings meet the
    results; the others are passed on as they are.
    """
    null = lambda names, kinds: [F.lit(None).cast(t).alias(n) for n, t in zip(names, kinds)]
    done = results.where("outcome = 'completed'")
    covered = done.select("run_id", "task_id", F.inline("coverage")).select("run_id", "task_id", *KEY, F.lit("covered").alias("new"), *COVERED, *null(FAILED, ["string"] * 4))
    failed = done.select("run_id", "task_id", F.inline("failed")).select(
        "run_id", "task_id", *KEY, F.lit("failed").alias("new"), *null(COVERED, ["long", "double", "double", "string"]), F.lit("recording").alias("scope"), "code", "stage", F.col("detail").alias("message")
    )
    message = F.concat(F.lit("the work failed at the stage "), F.col("failure.stage"), F.lit(" before its first recording"))
    whole = results.where("outcome = 'failed'").select("run_id", "task_id", F.struct(F.lit("task").alias("scope"), F.col("failure.code").alias("code"), F.col("failure.stage").alias("stage"), message.alias("message")).alias("whole"))
    outcomes = outcomes.select("run_id", "task_id", *KEY, "state")
    joined = outcomes.where("state = 'pending'").join(covered.unionByName(failed), ["run_id", "task_id", *KEY], "left").join(whole, ["run_id", "task_id"], "left")
    own = F.col("whole").isNotNull()
    state = F.when(own, "failed").otherwise(F.coalesce("new", "state"))
    values = [F.when(~own, F.col(c)).alias(c) for c in COVERED] + [F.when(own, F.col(f"whole.{c}")).otherwise(F.col(c)).alias(c) for c in FAILED]
    changed = joined.select("run_id", "task_id", *KEY, state.alias("state"), *values)
    others = outcomes.where("state IS DISTINCT FROM 'pending'")
    files = done.select("run_id", "task_id", F.inline("artifacts")).select("run_id", "task_id", *KEY, "kind", "contract_id", "uri", "checksum", "size_bytes", "rows")
    return changed.unionByName(others, allowMissingColumns=True), files


def current_files_index(current: DataFrame, facts: DataFrame, presets: DataFrame) -> DataFrame:
    """The index of current files: one row per file with its size, model and the names of its configuration's presets."""
    names = presets.groupBy("configuration_digest").agg(F.array_sort(F.collect_list("name")).alias("presets"))
    rows = current.join(facts, ["run_id", "kind", *KEY]).join(small(names), "configuration_digest", "left")
    versions = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("output_versions"))))
    return rows.select(
        *KEY, "model_id", F.coalesce("presets", F.array().cast("array<string>")).alias("presets"), "configuration_digest", "kind", "contract_id", "uri", "checksum", "size_bytes", "rows",
        versions.alias("output_versions"), "up_to_date", F.col("run_id").cast("string").alias("run_id"),
    )


def export_index(index: DataFrame, dated: str, current: str) -> None:
    """Write the dated copy, which must be new, then replace the current one."""
    ordered = index.orderBy(*KEY, "configuration_digest", "kind")
    ordered.write.option("compression", "zstd").mode("errorifexists").parquet(dated)
    index.sparkSession.read.schema(index.schema).parquet(dated).write.option("compression", "zstd").mode("overwrite").parquet(current)
