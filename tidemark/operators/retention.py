"""Which scores of a window are kept, and which are detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

WINDOW = ("namespace", "value", "window_start_s")
DETECTION_COLUMNS = ("namespace", "value", "window_start_s", "window_end_s", "label", "label_kind", "score", "rank", "scientific_name", "common_name", "gbif_taxon_key")


def retain_full(windows: DataFrame, registry: DataFrame) -> DataFrame:
    """One row per window and label from windows with an array ``scores`` in registry order."""
    # the registry is a model's vocabulary; Spark broadcasts it while its size is under the session's threshold
    exploded = windows.select("namespace", "value", "window_start_s", "window_end_s", F.posexplode("scores").alias("class_index", "score"))
    return exploded.join(registry.select(F.col("class_index").cast("int").alias("class_index"), "label"), "class_index").select("namespace", "value", "window_start_s", "window_end_s", "label", "score")


def score_floor(scores: DataFrame, min_score: float) -> DataFrame:
    """Scores at or above the floor, compared as stored doubles."""
    return scores.where(F.col("score") >= F.lit(float(min_score)))


retain_thresholded = score_floor


def ranked(scores: DataFrame) -> DataFrame:
    """``rank`` by falling score, then by label in code point order, within each window."""
    order = Window.partitionBy(*WINDOW).orderBy(F.col("score").desc(), F.col("label").asc())
    return scores.withColumn("rank", F.row_number().over(order))


def retain_top_k(scores: DataFrame, k: int, min_score: float | None = None) -> DataFrame:
    """The first ``k`` scores of each window above the floor."""
    floored = scores if min_score is None else score_floor(scores, min_score)
    return ranked(floored).where(F.col("rank") <= k).drop("rank")


def retain_top_k_array(windows: DataFrame, labels: Column, k: int, min_score: float) -> DataFrame:
    """As ``retain_top_k`` for rows with an array ``scores``, per row and without a shuffle."""
    pairs = F.filter(F.arrays_zip(F.col("scores").alias("score"), labels.alias("label")), lambda x: x["score"] >= F.lit(float(min_score)))
    keyed = F.array_sort(F.transform(pairs, lambda x: F.struct((-x["score"]).alias("neg"), x["label"].alias("label"), x["score"].alias("score"))))
    top = windows.withColumn("kept", F.explode(F.slice(keyed, 1, k)))
    return top.select("namespace", "value", "window_start_s", "window_end_s", F.col("kept.label").alias("label"), F.col("kept.score").alias("score"))


def label_rank(registry: DataFrame) -> DataFrame:
    """Each label's place in code point order, from 0."""
    return registry.select("label", (F.row_number().over(Window.orderBy("label")) - 1).cast("long").alias("place"))


def detections(scores: DataFrame, registry: DataFrame, min_score: float | None = None, k: int | None = None) -> DataFrame:
    """Scores above the floor, ranked, at most ``k`` of a window, with the registry's facts of their labels.

    The floor comes first, so ranks count only what is above it; the join comes last, over what is left.
    """
    rows = ranked(scores if min_score is None else score_floor(scores, min_score))
    if k is not None:
        rows = rows.where(F.col("rank") <= k)
    return rows.drop("class_index").join(registry.drop("class_index"), "label").select(*DETECTION_COLUMNS)


def unmatched_labels(scores: DataFrame, registry: DataFrame) -> DataFrame:
    """Labels of a recording's scores that the registry lacks, also below any floor."""
    return scores.select("namespace", "value", "label").distinct().join(registry.select("label"), "label", "left_anti").select("namespace", "value", "label")


def rows_per_recording(rows: DataFrame) -> DataFrame:
    """Rows of each recording; recordings without rows have no entry and so no file."""
    return rows.groupBy("namespace", "value").agg(F.count(F.lit(1)).alias("rows"))
