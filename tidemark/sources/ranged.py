"""Files opened inside tasks: listed by Spark, dealt by size, read by ranges or streamed.

Tasks open a file through pyarrow's file systems, which read ranges of local, S3, Google and Azure places and, where
Hadoop's native library is installed, of HDFS. Places that only Spark can read are loaded whole with its binary reader
instead, so there files must be under 2 GB.
"""

from __future__ import annotations

import hashlib
import io
import re

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import shared_folder

#: Bytes that are read at a time when a whole file goes by.
STEP = 1 << 22
_SAME = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}
_systems: dict[str, pafs.FileSystem] = {}


def file_system(place: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path on it) of a place: a path or a URI as Spark writes it, not percent-encoded."""
    found = re.match(r"([A-Za-z][\w+.-]+):(//)?([^/]*)(/.*)?$", place, re.DOTALL)
    scheme = _SAME.get(found[1], found[1]) if found else "file"
    if scheme == "file":
        return _systems.setdefault("file", pafs.LocalFileSystem()), re.sub(r"^file:/+", "/", place)
    host, path = found[3], found[4] or ""
    key = f"{scheme}://{host}"
    if key not in _systems:
        _systems[key] = pafs.FileSystem.from_uri(f"{key}/")[0]
    named = scheme in ("hdfs", "viewfs")
    bucket = host.partition("@")[0] if scheme.startswith("abfs") else host
    return _systems[key], path if named else bucket + path


def opens_in_tasks(place: str) -> bool:
    """Whether pyarrow knows the file system of a place."""
    try:
        file_system(place)
    except (OSError, pa.ArrowException, TypeError):
        return False
    return True


class Ranged(io.RawIOBase):
    """A file read by ranges, with the bytes that were read so far."""

    def __init__(self, place: str | None, content: bytes | None = None):
        if content is None:
            system, path = file_system(place)
            self._file = system.open_input_file(path)
        else:
            self._file = pa.BufferReader(content)
        self.bytes_read = 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        self._file.seek(offset, whence)
        return self._file.tell()

    def tell(self) -> int:
        return self._file.tell()

    def size(self) -> int:
        return self._file.size()

    def read(self, size: int = -1) -> bytes:
        out = self._file.read(None if size is None or size < 0 else size)
        self.bytes_read += len(out)
        return out

    def readall(self) -> bytes:
        return self.read()

    def close(self) -> None:
        self._file.close()
        super().close()


def stream_sha256(file: Ranged) -> str:
    digest = hashlib.sha256()
    file.seek(0)
    while piece := file.read(STEP):
        digest.update(piece)
    return "sha256:" + digest.hexdigest()


_OPEN_COST = "spark.sql.files.openCostInBytes"
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def listed(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, length) of the files below ``path``, written to the shared folder; nothing of them is read. Spark lists no empty files."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    found, before = shared_folder(spark, "files"), {k: spark.conf.get(k) for k in (_OPEN_COST, _LISTING_TASKS)}
    spark.conf.set(_OPEN_COST, "16k")  # files that are not opened cost little, so a task lists many
    spark.conf.set(_LISTING_TASKS, spark.conf.get("spark.sql.shuffle.partitions"))  # else each folder is a task
    try:
        reader.load(path).select("path", "length").write.parquet(found)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema("path string, length long").parquet(found)


def _writer(root: str):
    def run(batches):
        system, base = file_system(root)
        for batch in batches:
            for place, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system.create_dir(f"{base}/{place}".rpartition("/")[0])
                with system.open_output_stream(f"{base}/{place}") as out:
                    out.write(content.encode())
            yield batch.select([0])

    return run


def write_texts(files: DataFrame, root: str) -> None:
    """Write each ``content`` to its ``place`` below the new folder ``root``, in the tasks that have the rows.

    For many small files: Spark's writers take some 20 ms for each on local disks and move them one by one at the end.
    A task that runs again writes the same files again.
    """
    files.select("place", "content").mapInArrow(_writer(root), "place string").write.format("noop").mode("overwrite").save()


def dealt(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Files over tasks so that each has about as many bytes, and begins with its longest.

    Files are sorted by size in ranges; each range, whose files are alike, is dealt out in turn.
    """
    spark = files.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = files.repartitionByRange(tasks, F.col("length").desc(), "path").sortWithinPartitions(F.col("length").desc(), "path")
    # the low bits of the id count a partition's rows; each range begins at its own task
    turn = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + F.spark_partition_id()
    return ranges.withColumn("turn", F.pmod(turn, F.lit(tasks)).cast("int")).repartitionById(tasks, "turn").drop("turn").sortWithinPartitions(F.col("length").desc(), "path")


def _checksums(batches):
    for batch in batches:
        sums = []
        for path in batch.column(0).to_pylist():
            with Ranged(path) as file:
                sums.append(stream_sha256(file))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sums, pa.string())], names=["path", "length", "checksum"])


def file_checksums(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, length, checksum) of the files below ``path``, of any size: a task streams its files, a few MB at a time."""
    if opens_in_tasks(path):
        return dealt(listed(spark, path, pattern)).mapInArrow(_checksums, "path string, length long, checksum string")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)
    return files.select("path", "length", F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("checksum"))

