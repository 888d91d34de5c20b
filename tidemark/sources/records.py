"""Records of CSV files whose quoted cells hold line breaks, numbered over files that are read in splits.

Whether a line begins a record depends on all lines before it. Each line is a map of the state it starts in (outside or
inside quotes) to the state it leaves; maps compose, so each block of a file is summed up by one, a prefix over blocks
tells the state that each begins in, and no block waits for another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# a quote opens a cell only at its start, and is doubled inside
_INSIDE = '[^"]*+(?:""[^"]*+)*+'
_CELLS = f'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+'
_OPEN = f'^{_CELLS}"{_INSIDE}$'
_STAYS = f"^{_INSIDE}$"
_REOPENS = f'^{_INSIDE}"[^,]*+,{_CELLS}"{_INSIDE}$'


def leaves_open(text: Column) -> tuple[Column, Column]:
    """Whether a line ends inside quotes, when it starts outside and when it starts inside."""
    return text.rlike(f"(?s){_OPEN}"), text.rlike(f"(?s){_STAYS}") | text.rlike(f"(?s){_REOPENS}")


def _running(order, *before) -> tuple[Column, Column]:
    """States after the rows up to each of ``order`` (columns out0, out1), for either state at the start."""
    flips = F.sum((F.col("out0") & ~F.col("out1")).cast("long")).over(order)
    fixed = F.last(F.when(F.col("out0") == F.col("out1"), F.struct(F.col("out0").alias("value"), F.col("flips").alias("flips"))), ignorenulls=True).over(order)
    return flips, fixed


def composed(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` (out0, out1) with ``in0``, ``in1``: the state before each row, for either state at the start of its group."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips, fixed = _running(upto)
    rows = rows.withColumn("flips", flips).withColumn("fixed", fixed)
    odd = lambda n: F.pmod(n, F.lit(2)) == 1
    after = lambda start: F.when(F.col("fixed").isNotNull(), F.col("fixed.value") != odd(F.col("flips") - F.col("fixed.flips"))).otherwise(F.lit(start) != odd(F.col("flips")))
    step = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumns({"all0": after(False), "all1": after(True)})
        .withColumns({"in0": F.coalesce(F.lag("all0").over(step), F.lit(False)), "in1": F.coalesce(F.lag("all1").over(step), F.lit(True))})
        .drop("flips", "fixed")
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text) of the CSV files below ``path``: records of each file from 1, with their line breaks.

    A carriage return before a record's end is dropped, and a byte order mark before a file's first record. Empty
    records have numbers too. Records of one line go no further than their task; only others are gathered.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    out0, out1 = leaves_open(F.col("value"))
    inner = composed(lines.withColumns({"out0": out0, "out1": out1}), ["file", "block"], ["id"])
    blocks = inner.groupBy("file", "block").agg(
        F.max_by("all0", "id").alias("out0"), F.max_by("all1", "id").alias("out1"), F.count_if(~F.col("in0")).alias("starts0"), F.count_if(~F.col("in1")).alias("starts1")
    )
    # a row for each block of a file
    placed = composed(blocks, ["file"], ["block"]).withColumn("starts", F.when(F.col("in0"), F.col("starts1")).otherwise(F.col("starts0")))
    before = F.coalesce(F.sum("starts").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = placed.select("file", "block", F.col("in0").alias("quoted"), before.alias("before"))
    lines = inner.join(at, ["file", "block"])
    lines = lines.withColumns({"inside": F.when(F.col("quoted"), F.col("in1")).otherwise(F.col("in0")), "open": F.when(F.col("quoted"), F.col("all1")).otherwise(F.col("all0"))})
    nth = F.count_if(~F.col("inside")).over(Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lines = lines.select("file", (F.col("before") + nth).alias("record"), "block", "id", "value", "inside", "open")
    whole = lines.where("NOT inside AND NOT open").select("file", "record", F.col("value").alias("text"))
    parts = lines.where("inside OR open").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "id", "value"))).alias("lines"))
    joined = parts.select("file", "record", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("text"))
    text = F.when(F.endswith("text", F.lit("\r")), F.substr("text", F.lit(1), F.length("text") - 1)).otherwise(F.col("text"))
    text = F.when((F.col("record") == 1) & text.startswith("﻿"), F.substr(text, F.lit(2))).otherwise(text)
    return whole.unionByName(joined).select("file", "record", text.alias("text"))
