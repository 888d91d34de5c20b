"""Fixed windows over recordings; seconds are doubles from the start of each recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EPSILON = 1e-9


def window_count(duration: Column, win: Column, overlap: Column, pad: Column) -> Column:
    """Windows of a recording: whole ones only under ``drop``, else at least one and a last one that is filled up.

    Null for an unknown duration.
    """
    raw = (duration - win) / (win - overlap) + 1
    count = F.when(pad == "drop", F.greatest(F.floor(raw + EPSILON), F.lit(0))).otherwise(F.greatest(F.ceil(raw - EPSILON), F.lit(1)))
    return F.when(duration.isNotNull(), count).cast("long")


def window_bounds(recordings: DataFrame) -> DataFrame:
    """One row per window of rows (namespace, value, duration_seconds, win, overlap, pad); unknown durations have none."""
    counted = recordings.withColumn("n", window_count(F.col("duration_seconds"), F.col("win"), F.col("overlap"), F.col("pad")))
    # sequence(0, -1) counts downwards, so recordings without windows go first
    placed = counted.where("n > 0").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    start = F.col("i") * (F.col("win") - F.col("overlap"))
    return placed.select("namespace", "value", "win", "overlap", "pad", "i", start.alias("window_start_s"), (start + F.col("win")).alias("window_end_s"))


def frame_span(start: Column, end: Column, rate: Column, file_frames: Column) -> tuple[Column, Column]:
    """First sample frame of a window and its number of frames in the file; halves go to the even frame."""
    first = F.bround(start * rate).cast("long")
    return first, F.least(F.bround((end - start) * rate).cast("long"), file_frames - first)


def on_exact_grid(start: Column, power: int) -> Column:
    """Whether a start is a whole number of steps on a grid; ``power`` is the largest power of two that divides the common rate."""
    return start * power == F.floor(start * power)


def zero_window_reason(duration: Column, n: Column) -> Column:
    """Why a recording has no window; an unknown duration stays unexplained."""
    return F.when(duration.isNotNull() & (n == 0), F.lit("shorter_than_window"))
