"""Results of tasks as they arrive, each taken once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.lineage import small
from ..sources.artifacts import RESULT

TAKEN = f"{RESULT}, result_checksum string"
REFUSED = "run_id long, task_id long, result_checksum string, code string"
KEYS = "task_id long, run_id long, outcome string"
MOST_TAKEN = 1_000_000  # places of lines that are broadcast, a number each


def _take(store: str):
    """A function of (batch, number) that files the batch's results below ``store``, in folders of its own.

    A batch that runs again replaces what it wrote. A result with the checksum of one that its task has is the same
    result and changes nothing; one with another checksum is refused, as is one that cannot be read. Results are judged
    by their keys and checksums; only those that are taken are read whole, each in the task that has its text.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # a batch is a fixed list of file parts, so a line has the same place whenever it is read
        lines = batch.select(F.monotonically_increasing_id().alias("at"), "value")
        keyed = lines.select("at", F.sha2("value", 256).alias("result_checksum"), F.from_json("value", KEYS).alias("r")).select("at", "r.*", "result_checksum")
        once = keyed.groupBy("task_id", "run_id", "outcome", "result_checksum").agg(F.min("at").alias("at"))
        known = accepted_results(spark, store, before=number).select("task_id", F.col("result_checksum").alias("known"))
        readable = F.col("task_id").isNotNull() & F.col("run_id").isNotNull() & F.coalesce(F.col("outcome").isin("completed", "failed"), F.lit(False))
        # a task has few different results; those that cannot be read have a group each
        task = Window.partitionBy("task_id", F.when(~readable, F.col("result_checksum")))
        first = F.min(F.when(F.col("known").isNull(), F.col("result_checksum"))).over(task)
        code = F.when(~readable, "result_unreadable").when(F.col("result_checksum") != F.coalesce("known", first), "task_has_a_result")
        judged = once.join(known, "task_id", "left").withColumn("code", code).where("code IS NOT NULL OR known IS NULL")
        judged.select("at", "run_id", "task_id", "result_checksum", "code").write.mode("overwrite").parquet(f"{store}/judged/batch={number}")
        judged = spark.read.schema(f"at long, {REFUSED}").parquet(f"{store}/judged/batch={number}")
        fresh = lines.join(small(judged.where("code IS NULL").select("at"), MOST_TAKEN), "at")
        columns = ["task_id", "run_id", "outcome", "failure", "coverage", "failed", "artifacts", "result_checksum"]
        taken = fresh.select(F.from_json("value", RESULT).alias("r"), F.sha2("value", 256).alias("result_checksum")).select("r.*", "result_checksum").select(*columns)
        taken.write.mode("overwrite").option("compression", "zstd").parquet(f"{store}/results/batch={number}")
        judged.where("code IS NOT NULL").drop("at").write.mode("overwrite").parquet(f"{store}/refused/batch={number}")

    return run


def ingest_stream(spark: SparkSession, source: str, store: str, whole_files: bool = False) -> None:
    """Take the result files that are new in ``source`` since the last call into ``store``.

    A file has a result on each line, or, with ``whole_files``, is one result. Which files are done is kept in the
    stream's checkpoint below ``store``.
    """
    lines = spark.readStream.option("wholetext", whole_files).text(source)
    started = lines.where("trim(value) <> ''").writeStream.foreachBatch(_take(store)).option("checkpointLocation", f"{store}/checkpoint").trigger(availableNow=True).start()
    started.awaitTermination()


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], f"{schema}, batch long")
    return spark.read.schema(f"{schema}, batch long").parquet(path)


def accepted_results(spark: SparkSession, store: str, before: int | None = None) -> DataFrame:
    """The one result of each task that has one, for ``ingest_results``; those of batches ``before`` a number."""
    found = _read(spark, f"{store}/results", TAKEN)
    return (found if before is None else found.where(F.col("batch") < before)).drop("batch")


def refused_results(spark: SparkSession, store: str) -> DataFrame:
    """(run_id, task_id, result_checksum, code) of results that were refused, once each."""
    return _read(spark, f"{store}/refused", REFUSED).drop("batch").dropDuplicates(["result_checksum"])
