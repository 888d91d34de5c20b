"""Lists of recordings in text files, checked line by line."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import audio_uri, storable

MAX_PROBLEMS = 20
FIELDS = ("audio_uri", "duration_seconds", "namespace", "value")
RECORDING = "namespace string, value string, audio_uri string, duration_seconds double"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) with lines counted from 1; a trailing carriage return is dropped.

    A list may be a folder of files: it is read as one, in order of the files' names. A byte order mark, which Spark's
    reader drops, shows in the size of its file and stands again before the file's first line.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"), "value")
    placed = lines.select("file", "block", F.monotonically_increasing_id().alias("id"), "value")
    # lines are numbered within their block, and blocks by the lines before them, so a large file is not one task
    nth = F.row_number().over(Window.partitionBy("file", "block").orderBy("id"))
    counts = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value") + 1).alias("bytes"), F.max("size").alias("size"))
    of_file = Window.partitionBy("file")
    marked = (F.col("size") - F.sum("bytes").over(of_file) >= 2) & (F.col("block") == F.min("block").over(of_file)) & ~F.col("file").rlike(r"\.(gz|bz2|zst|snappy|lz4|deflate)$")
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block of a file
    starts = counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), marked.alias("marked"))
    numbered = placed.withColumn("nth", nth).join(starts, ["file", "block"])
    # no regular expression, which would repair bytes that are no UTF-8
    text = F.when(F.endswith("value", F.lit("\r")), F.substr("value", F.lit(1), F.length("value") - 1)).otherwise(F.col("value"))
    text = F.when(F.col("marked") & (F.col("nth") == 1), F.concat(F.lit("\ufeff"), text)).otherwise(text)
    return numbered.select("file", (F.col("before") + F.col("nth")).cast("long").alias("line"), text.alias("text"))


def _one_value(text: Column) -> Column:
    """Whether a text is one JSON value and nothing after it.

    Parsers stop at the end of a value, so the text is put into a list and into an object: what may follow it in both is
    a comma, which would make the list longer.
    """
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    held = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))
    return F.coalesce((F.size(listed) == 1) & held.isNotNull(), F.lit(False))


def _type_of(text: Column, key: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), f"$.{key}", "variant"))


def _lone_surrogate(text: Column) -> Column:
    """Whether an escaped surrogate stands without its other half."""
    pairs = F.regexp_replace(F.regexp_replace(text, r"\\\\", ""), r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}", "")
    return pairs.rlike(r"\\u[dD][89a-fA-F]")


def line_problem(text: Column, parsed: Column) -> Column:
    """The first thing wrong with a line that should be one recording; empty lines are none at all.

    Types are strict: texts are JSON strings and a duration is a JSON number, or null for none.
    """
    keys = F.json_object_keys(text)
    duration = parsed["duration_seconds"]
    texts = ("namespace", "value", "audio_uri")
    not_text = reduce(operator.or_, [~F.coalesce(_type_of(text, c).isin("STRING", "VOID"), F.lit(True)) for c in texts])
    not_number = ~F.coalesce(_type_of(text, "duration_seconds").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*|VOID)$"), F.lit(True))
    given = _type_of(text, "duration_seconds") != "VOID"
    return F.coalesce(
        F.when(~F.is_valid_utf8(text), "not_utf8"),
        F.when(text.startswith("\ufeff"), "byte_order_mark"),
        F.when(F.trim(text) == "", "blank_line"),
        F.when(F.contains(text, F.lit("\x00")), "nul_character"),
        F.when(keys.isNull(), "not_an_object"),
        F.when(F.size(keys) != F.size(F.array_distinct(keys)), "repeated_key"),
        F.when(F.size(F.array_except(keys, F.array(*map(F.lit, FIELDS)))) > 0, "unknown_key"),
        F.when(~_one_value(text), "not_an_object"),
        F.when(not_text, "not_text"),
        F.when(_lone_surrogate(text), "lone_surrogate"),
        F.when(~storable(parsed["namespace"]) | ~storable(parsed["value"]) | ~storable(parsed["audio_uri"]), "missing_text"),
        F.when(not_number | given & (duration.isNull() | F.isnan(duration) | (duration <= 0) | (duration == float("inf"))), "bad_duration"),
    )


def recordings_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(line, namespace, value, audio_uri, duration_seconds, problem) of every line that is not empty."""
    lines = numbered_lines(spark, path).where("text <> ''")
    parsed = lines.withColumn("r", F.from_json("text", RECORDING))
    problem = line_problem(F.col("text"), F.col("r"))
    return parsed.withColumn("problem", problem).select("line", *(F.when(F.col("problem").isNull(), F.col(f"r.{c}")).alias(c) for c in ("namespace", "value", "audio_uri", "duration_seconds")), "problem")


def uri_list(spark: SparkSession, path: str, namespace: str) -> DataFrame:
    """One recording per line that is not empty; its identity is the stored form of the URI."""
    uri = audio_uri(F.col("text"))
    return numbered_lines(spark, path).where("text <> ''").select(
        "line", F.lit(namespace).alias("namespace"), uri.alias("value"), uri.alias("audio_uri"), F.when(uri.isNull(), "bad_uri").alias("problem")
    )


class ManifestRefused(ValueError):
    """A list that holds no recordings."""


def manifest_problems(lines: DataFrame, most: int = MAX_PROBLEMS) -> DataFrame:
    """Line problems and repeated identities by line, the first ``most``, and whether there are more.

    Every occurrence of an identity after the first names the first one's line. A list without a line is refused.
    """
    if lines.isEmpty():
        raise ManifestRefused("the list holds no recordings; give at least one")
    order = Window.partitionBy("namespace", "value").orderBy("line")
    fine = lines.where("problem is null").select("line", F.row_number().over(order).alias("nth"), F.first("line").over(order).alias("first_line"))
    repeated = fine.where("nth > 1").select("line", F.lit("repeated_identity").alias("problem"), "first_line")
    all_ = lines.where("problem is not null").select("line", "problem", F.lit(None).cast("long").alias("first_line")).unionByName(repeated)
    shown = all_.orderBy("line", "problem").limit(most + 1)  # a report
    placed = shown.withColumn("place", F.row_number().over(Window.orderBy("line", "problem"))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy()))
    return placed.where(F.col("place") <= most).select("line", "problem", "first_line", (F.col("n") > most).alias("truncated"))


def repeated_identities(recordings: DataFrame) -> DataFrame:
    """Identities that occur more than once with all their places (column ``position``, from 0)."""
    return recordings.groupBy("namespace", "value").agg(F.sort_array(F.collect_list("position")).alias("positions"), F.count(F.lit(1)).alias("n")).where("n > 1")
