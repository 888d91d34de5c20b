"""Acceptance and coverage of windows as they arrive; an end marker closes a recording and frees its state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEY = ["namespace", "value"]
#: Rows of a stream: the recording's windows are to agree with an input, a row of that input, a window, the end.
BEGIN, EXPECTED, WINDOW, END = "begin", "expected", "window", "end"
STATE = "last_start double, accepted long, code string, failed_at double, checked boolean"
BOUNDS = "window_start_s double, window_end_s double"
OUTPUT = "namespace string, value string, accepted long, code string, window_start_s double, closed boolean"
DISAGREES = "head_windows_disagree_with_input"


class AcceptInOrder(StatefulProcessor):
    """State of a recording: its last accepted window, what it failed with, and the input rows that have had no window.

    Input rows (kind ``expected``, in order of ``arrival``) are a list that windows use up from the front: a window must
    have exactly the bounds of the next one. Only recordings with a row ``begin`` are compared with an input, which may
    be empty. ``row_code`` of a window is the code of the checks that need no other window. Batches must bring a
    recording's rows in order, input rows before the windows; within a batch they are sorted by arrival. The row ``end``
    refuses a recording with input rows left, gives its last result with ``closed``, and frees the state; what comes
    after it opens the recording anew and stays open.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("recording", STATE)
        self._expected = handle.getListState("expected", BOUNDS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, accepted, code, failed_at, checked = self._state.get() if self._state.exists() else (None, 0, None, None, False)
        arrived = pd.concat(rows).sort_values("arrival", kind="stable")
        kind = arrived["kind"].to_numpy(object)
        checked = bool(checked or (kind == BEGIN).any())
        ended = bool((kind == END).any())
        before = list(self._expected.get()) if self._expected.exists() and code is None else []
        bounds = arrived[["window_start_s", "window_end_s"]].to_numpy(np.float64)
        left = np.concatenate([np.array(before, dtype=np.float64).reshape(-1, 2), bounds[kind == EXPECTED]])
        if code is None:
            windows, own = bounds[kind == WINDOW], arrived["row_code"].to_numpy(object)[kind == WINDOW]
            start = windows[:, 0]
            # until the first failure every window before was accepted, so the one before is the last accepted
            previous = np.r_[np.nan if last is None else last, start[:-1]]
            order = np.where(start == previous, "duplicate_window", np.where(start < previous, "window_out_of_order", None))
            invalid = own == "window_bounds_invalid"
            moved = np.zeros(len(windows), dtype=bool)
            if checked:
                moved[len(left) :] = True
                n = min(len(left), len(windows))
                moved[:n] = (windows[:n] != left[:n]).any(axis=1)
            failed = np.flatnonzero(moved | invalid | (order != None) | ~pd.isna(own))  # noqa: E711
            n = int(failed[0]) if len(failed) else len(start)
            if len(failed):
                code = DISAGREES if moved[n] else own[n] if invalid[n] or order[n] is None else order[n]
                failed_at = float(start[n])
            if n:
                last, accepted = float(start[n - 1]), accepted + n
            left = left[n:]
            if ended and code is None and checked and len(left):
                code, failed_at = DISAGREES, float(left[0, 0])
        if ended:
            self._state.clear()
            self._expected.clear()
        else:
            self._state.update((last, accepted, code, failed_at, checked))
            if code is None and len(left):
                self._expected.put([tuple(map(float, row)) for row in left])
            else:
                self._expected.clear()
        yield pd.DataFrame({"namespace": [key[0]], "value": [key[1]], "accepted": [accepted], "code": [code], "window_start_s": [failed_at], "closed": [ended]})

    def close(self) -> None:
        pass


def accept_window_stream(rows: DataFrame) -> DataFrame:
    """Per batch and recording the state after it, from a stream (namespace, value, kind, arrival, window_start_s, window_end_s, row_code)."""
    return rows.groupBy(*KEY).transformWithStateInPandas(statefulProcessor=AcceptInOrder(), outputStructType=OUTPUT, outputMode="Update", timeMode="None")


COUNTS = "windows long, scores long, embeddings long, first_arrival long, first_start double, greatest_end double"
COVERED = (
    "namespace string, value string, windows_completed long, score_rows long, embedding_rows long, detection_rows long, "
    "first_window_start_s double, last_window_end_s double, zero_window_reason string, input_checksum string"
)


class CoverToTheEnd(StatefulProcessor):
    """Counts and bounds of an open recording; its row is given once, when the end marker comes, and the state is freed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("counts", COUNTS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, scores, embeddings, first_arrival, first, greatest = self._state.get() if self._state.exists() else (0, 0, 0, None, None, None)
        ends = []
        for batch in rows:
            windows = batch[batch["kind"] == WINDOW]
            if len(windows):
                n, scores = n + len(windows), scores + int(windows["kept"].sum())
                embeddings += int(windows["has_embedding"].fillna(False).sum())
                row = windows.iloc[int(windows["arrival"].to_numpy().argmin())]
                if first_arrival is None or row["arrival"] < first_arrival:
                    first_arrival, first = int(row["arrival"]), float(row["window_start_s"])
                end = float(windows["window_end_s"].max())
                greatest = end if greatest is None else max(greatest, end)
            ends += batch[batch["kind"] == END].to_dict("records")
        if not ends:
            self._state.update((n, scores, embeddings, first_arrival, first, greatest))
            return
        self._state.clear()
        mark = ends[0]
        text = lambda c: None if pd.isna(mark[c]) else mark[c]
        detections = 0 if pd.isna(mark["detection_rows"]) else int(mark["detection_rows"])
        values = (key[0], key[1], n, scores, embeddings, detections, first, greatest, text("zero_window_reason"), text("input_checksum"))
        yield pd.DataFrame({f.split()[0]: [v] for f, v in zip(COVERED.split(", "), values)})

    def close(self) -> None:
        pass


def coverage_stream(rows: DataFrame) -> DataFrame:
    """One row for each recording that has ended, as ``coverage`` has it, in append mode.

    The stream has windows (kind, arrival, window_start_s, window_end_s, kept, has_embedding) and for each recording an
    end marker with its detection_rows, zero_window_reason and input_checksum. Windows and marker of a recording must
    not change places between batches.
    """
    return rows.groupBy(*KEY).transformWithStateInPandas(statefulProcessor=CoverToTheEnd(), outputStructType=COVERED, outputMode="Append", timeMode="None")


def running_coverage(windows: DataFrame) -> DataFrame:
    """Running counts and bounds of each recording, for streams without end markers; the state grows with the recordings."""
    return windows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("windows_completed"), F.min("window_start_s").alias("first_window_start_s"), F.max("window_end_s").alias("last_window_end_s"), F.sum("kept").alias("score_rows")
    )
