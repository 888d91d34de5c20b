"""Tables written to the folder that all executors share, used to cut lineage between passes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where that is unset a new local folder, but only under a local master (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not getattr(shared_dir, "own", None):
        shared_dir.own = tempfile.mkdtemp(prefix="tidemark-")
    return shared_dir.own


class Scratch:
    """Named Parquet tables of one operator call under the shared folder.

    A saved table survives the loss of executors, so later passes never recompute what came before it. While a
    table is written, Spark is asked to drop that query's shuffle files when it ends. Call ``drop`` for large
    tables once the results that need them are saved too; small ones are left to the cluster's retention rule.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        conf = self.spark.conf
        before = conf.get(_CLEANUP, "false")
        conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name))
        finally:
            conf.set(_CLEANUP, before)
        schema = df.schema
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt over all cores if they are read in fewer than half as many parts, as from a file of one row group."""
    parts, cores = rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if 2 * parts <= cores else rows
