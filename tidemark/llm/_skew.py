"""Joins of a large table with one row per key, of which a few keys may hold much of the large table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key with more than this share of the rows is hot; so fewer than 1/HOT_SHARE keys are.
HOT_SHARE, SALTS = 0.001, 64


def join_counted(rows: DataFrame, keyed: DataFrame, on: list[str], total: int, spread: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``keyed``, which has each key once with ``n``, the rows it has (at least) among ``total``.

    Rows of hot keys are dealt over salts by the columns ``spread``, and the one row of ``keyed`` is copied to each
    salt. Only the hot keys are broadcast, fewer than 1/HOT_SHARE. Both tables are read twice or more: written ones.
    """
    limit = max(1, int(total * HOT_SHARE))
    hot = keyed.where(F.col("n") > limit).select(*on, F.lit(True).alias("hot_key"))
    salt = F.when(F.col("hot_key"), F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    left = rows.join(F.broadcast(hot), on, "left").withColumn("salt", salt).drop("hot_key")
    salts = F.when(F.col("n") > limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = keyed.withColumn("salt", F.explode(salts)).drop("n")
    return left.join(right, [*on, "salt"], how).drop("salt")
