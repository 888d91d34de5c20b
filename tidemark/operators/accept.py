"""Checks of the windows that a model returns. The first failing check is a window's code, the first such window fails its recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

KEY = ["namespace", "value"]
GRID = 1e-9


def by_arrival():
    return Window.partitionBy(*KEY).orderBy("arrival")


def _finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def bounds_code(start: Column, end: Column) -> Column:
    fine = _finite(start) & _finite(end) & (end > start)
    return F.when(~F.coalesce(fine, F.lit(False)), "window_bounds_invalid")


def order_code(start: Column, before: Column) -> Column:
    """``before``: the start of the window accepted last; in a failing recording only the first violation counts."""
    return F.when(start == before, "duplicate_window").when(start < before, "window_out_of_order")


def geometry_code(start: Column, end: Column, win: float, hop: float) -> Column:
    rest = F.pmod(start, F.lit(float(hop)))
    off = (F.least(rest, F.lit(float(hop)) - rest) > GRID * hop) | (F.abs(end - start - float(win)) > GRID * win)
    return F.when(off, "window_off_geometry")


def within_code(start: Column, end: Column, duration: Column, drop: bool) -> Column:
    outside = (start < 0) | F.coalesce((start >= duration) | (F.lit(drop) & (end > duration)), F.lit(False))
    return F.when(outside, "window_outside_recording")


def score_position(scores: Column) -> Column:
    """Place of the first score outside [0, 1] from 1, 0 if none; NaN is outside."""
    return F.array_position(F.transform(scores, lambda x: ~((x >= 0) & (x <= 1))), True)


def scores_code(scores: Column, n_labels: int) -> Column:
    bad = F.exists(scores, lambda x: ~((x >= 0) & (x <= 1)))
    return F.when(bad, "score_out_of_domain").when(F.size(scores) != n_labels, "incomplete_full_scores")


def embedding_code(embedding: Column, dim: int | None) -> Column:
    """``dim`` is None where no embedding is expected."""
    if dim is None:
        return F.when(embedding.isNotNull(), "unexpected_embedding")
    endless = F.exists(embedding, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(embedding.isNull() | (F.size(embedding) != dim), "malformed_embedding").when(endless, "embedding_not_finite")


def window_codes(windows: DataFrame, win: float, hop: float, drop: bool, n_labels: int, dim: int | None) -> DataFrame:
    """``code`` of each window (namespace, value, arrival, bounds, scores, embedding, duration_seconds), null if accepted."""
    start, end = F.col("window_start_s"), F.col("window_end_s")
    with_before = windows.withColumn("before", F.lag("window_start_s").over(by_arrival()))
    code = F.coalesce(
        bounds_code(start, end),
        order_code(start, F.col("before")),
        geometry_code(start, end, win, hop),
        within_code(start, end, F.col("duration_seconds"), drop),
        scores_code(F.col("scores"), n_labels),
        embedding_code(F.col("embedding"), dim),
    )
    return with_before.withColumn("code", code).drop("before")


def recording_failures(coded: DataFrame) -> DataFrame:
    """(namespace, value, code, window_start_s, arrival) of the first window that each failing recording failed at."""
    first = coded.where("code is not null").groupBy(*KEY).agg(F.min_by(F.struct("code", "window_start_s", "arrival"), "arrival").alias("f"))
    return first.select(*KEY, "f.code", "f.window_start_s", "f.arrival")


def accepted(coded: DataFrame) -> DataFrame:
    return coded.join(recording_failures(coded).select(*KEY), KEY, "left_anti").drop("code")


def expected_problems(windows: DataFrame, expected: DataFrame) -> DataFrame:
    """Places where the windows of a head are not its input rows, in order and with equal bounds."""
    number = lambda df, order: df.withColumn("i", F.row_number().over(Window.partitionBy(*KEY).orderBy(order)))
    got = number(windows, "arrival").select(*KEY, "i", F.struct("window_start_s", "window_end_s").alias("got"))
    want = number(expected, "position").select(*KEY, "i", F.struct("window_start_s", "window_end_s").alias("want"))
    differ = got.join(want, [*KEY, "i"], "full").where(~F.col("got").eqNullSafe(F.col("want")))
    return differ.groupBy(*KEY).agg(F.min("i").cast("long").alias("row")).withColumn("code", F.lit("head_windows_disagree_with_input"))
