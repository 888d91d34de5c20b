"""Lists kept for paging: files that each hold one range of the keys, and a table of fences.

A fence is the least and the greatest key of a file and its rows. A page needs the file that holds its first row and
those after it until it is full; with files larger than a page these are one or two, however long the list is.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .paging import DEFAULT_LIMIT, MAX_LIMIT, Cursor, PageRefused, keyset_page

#: Rows of a file, about; more than a page has.
FILE_ROWS = 100_000
#: Files of a list; of a longer one they grow, as writing and opening each costs more than a page reads of it.
MOST_FILES = 500


@dataclass(frozen=True)
class KeptList:
    """A list below ``path``: ``rows`` in ranges of ``keys``, ``fences`` with a row for each of its files."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]

    @property
    def fences(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/fences")


def _key(keys, source: str = "") -> Column:
    return F.struct(*(F.col(source + k).alias(k) for k in keys))


def keep_list(rows: DataFrame, keys: list[str], path: str, file_rows: int = FILE_ROWS) -> KeptList:
    """Write ``rows`` in order of ``keys``, which tell rows apart, as files of about ``file_rows``, with their fences.

    A list that would have more than MOST_FILES gets that many, with more rows. The rows are made once and written as they
    come, to be counted, sampled for the ranges and sorted from there.
    """
    if file_rows <= MAX_LIMIT:
        raise ValueError(f"files need more than {MAX_LIMIT} rows")
    spark = rows.sparkSession
    rows.write.parquet(f"{path}/unsorted")
    given = spark.read.schema(rows.schema).parquet(f"{path}/unsorted")
    parts = min(max(1, -(-given.count() // file_rows)), MOST_FILES)
    given.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).write.parquet(f"{path}/rows")
    unsorted = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/unsorted")
    unsorted.getFileSystem(spark._jsc.hadoopConfiguration()).delete(unsorted, True)
    kept = spark.read.schema(rows.schema).parquet(f"{path}/rows").select("*", F.col("_metadata.file_path").alias("file"))
    key = _key(keys)
    kept.groupBy("file").agg(F.min(key).alias("least"), F.max(key).alias("greatest"), F.count(F.lit(1)).alias("rows")).orderBy("least").write.parquet(f"{path}/fences")
    return KeptList(spark, path, tuple(keys))


def _literal(kept: KeptList, fences: DataFrame, values: list) -> Column:
    kinds = {f.name: f.dataType for f in fences.schema["least"].dataType.fields}
    return F.struct(*(F.lit(v).cast(kinds[k]).alias(k) for k, v in zip(kept.keys, values)))


def page_files(kept: KeptList, limit: int, after: list | None = None, descending: bool = False, within: list | None = None) -> list[str]:
    """Files that hold the ``limit`` + 1 rows after ``after`` whose first keys are those of ``within``."""
    fences = kept.fences
    near, far = ("greatest", "least") if descending else ("least", "greatest")
    if after is not None:
        bound, edge = _literal(kept, fences, after), F.col(far)
        fences = fences.where(edge < bound if descending else edge > bound)
    if within:
        here = _literal(kept, fences, within)
        some = lambda c: _key(kept.keys[: len(within)], f"{c}.")
        fences = fences.where((some("least") <= here) & (some("greatest") >= here))
    order = F.col(near).desc() if descending else F.col(near).asc()
    # only the first file may hold rows that come before the page, so with it the next limit + 1 rows are enough
    found, rows = [], 0
    for fence in fences.orderBy(order).select("file", "rows").limit(limit + 2).collect():
        found.append(fence["file"])
        rows += fence["rows"] if len(found) > 1 else 0
        if rows > limit:
            break
    return found


def kept_page(kept: KeptList, limit: int = DEFAULT_LIMIT, after: list | None = None, descending: bool = False, within: list | None = None) -> DataFrame:
    """Up to ``limit`` + 1 rows after ``after``, as ``keyset_page`` gives them, from the files that hold them."""
    if not 1 <= limit <= MAX_LIMIT:
        raise PageRefused(f"the limit must be 1 to {MAX_LIMIT}")
    files = page_files(kept, limit, after, descending, within)
    schema = kept.spark.read.parquet(f"{kept.path}/rows").schema
    rows = kept.spark.read.schema(schema).parquet(*files) if files else kept.spark.createDataFrame([], schema)
    for key, value in zip(kept.keys, within or []):
        rows = rows.where(F.col(key).eqNullSafe(F.lit(value).cast(schema[key].dataType)))
    return keyset_page(rows, list(kept.keys), limit, after, descending)


def next_kept_page(kept: KeptList, list_name: str, filters: Mapping[str, object], limit: int = DEFAULT_LIMIT, cursor: str | None = None, descending: bool = False, within: list | None = None):
    """(rows of the page, next cursor or None), as ``next_page`` gives them."""
    place = Cursor(list_name, filters)
    after = None if cursor is None else place.read(cursor, len(kept.keys))
    found = kept_page(kept, limit, after, descending, within).collect()
    return found[:limit], place.write([found[limit - 1][k] for k in kept.keys]) if len(found) > limit else None
