"""Embedding vectors: storage width, head input checks, linear heads and their scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: From here on a value rounds to infinity in half precision.
HALF_LIMIT = 65_520.0


def narrow_code(embedding: Column, half: bool) -> Column:
    """Failure of vectors with a finite value that the storage width cannot hold; too small values become zero."""
    finite = lambda x: ~F.isnan(x) & (F.abs(x) != float("inf"))
    if half:
        out = F.exists(embedding, lambda x: finite(x) & (F.abs(x) >= HALF_LIMIT))
    else:
        out = F.exists(embedding, lambda x: finite(x) & (F.abs(x.cast("float")) == float("inf")))
    return F.when(out, "embedding_value_out_of_storage_dtype_range")


def narrow_float(embedding: Column) -> Column:
    return embedding.cast("array<float>")


def narrow_half(embedding: Column) -> Column:
    """Values rounded to half precision (11 significant bits, half to even), held as single precision."""

    def rounded(x: Column) -> Column:
        wide = x.cast("double")
        step = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.abs(wide))), F.lit(-14)) - 10)  # no finer than 2**-24
        inexact = F.bround(wide / step) * step
        endless = F.when(wide > 0, float("inf")).otherwise(float("-inf"))
        return F.when((wide == 0) | F.isnan(wide), wide).when(F.abs(wide) >= HALF_LIMIT, endless).otherwise(inexact).cast("float")

    return F.transform(embedding, rounded)


def head_input_code(backbone: Column, card: Column, dim: Column, recipe: Column, namespace: Column, value: Column, want: dict[str, Column]) -> Column:
    """The first mismatch between a file's header and what a head takes."""
    other = lambda a, b: ~a.eqNullSafe(b)
    return (
        F.when(other(backbone, want["backbone"]) | other(card, want["card"]), "head_input_backbone_mismatch")
        .when(other(dim, want["dim"]), "head_input_width_mismatch")
        .when(other(recipe, want["recipe"]), "head_input_recipe_differs")
        .when(other(namespace, want["namespace"]) | other(value, want["value"]), "head_input_recording_mismatch")
    )


def logits_code(logits: Column, n_labels: int) -> Column:
    endless = F.exists(logits, lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(F.size(logits) != n_labels, "wrong_shape").when(endless, "not_finite")


def sigmoid(logits: Column, clip: float | None = None) -> Column:
    """Logistic function of each logit, without overflow; clipped to ±``clip`` first if given."""
    bounded = (lambda x: F.greatest(F.least(x, F.lit(clip)), F.lit(-clip))) if clip is not None else (lambda x: x)
    return F.transform(logits, lambda x: F.when(x >= 0, 1 / (1 + F.exp(-bounded(x)))).otherwise(F.exp(bounded(x)) / (1 + F.exp(bounded(x)))))


def linear_head(windows: DataFrame, kernel: np.ndarray, bias: np.ndarray, key_columns: list[str], activate: bool = False) -> DataFrame:
    """``logits`` (or scores, if ``activate``) and ``code`` of rows with an ``embedding``, one matrix product per Arrow batch.

    A row without a vector has the code ``embedding_missing`` and one of another width ``head_input_width_mismatch``;
    both have null logits, and the other rows get theirs. A null in a vector gives null logits. The kernel (dim, labels) is a model's weights; it is broadcast once to each executor.
    """
    shared = windows.sparkSession.sparkContext.broadcast((np.asarray(kernel, dtype=np.float64), np.asarray(bias, dtype=np.float64)))
    schema = ", ".join(f"{c} {windows.schema[c].dataType.simpleString()}" for c in key_columns) + ", logits array<double>, code string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, offset = shared.value
        for batch in batches:
            out = batch[key_columns].copy()
            vectors = batch["embedding"]
            missing = vectors.isna().to_numpy()
            wrong = ~missing & (vectors.str.len().to_numpy() != len(weights))
            fine = np.flatnonzero(~missing & ~wrong)
            found = np.full(len(batch), None, dtype=object)
            if len(fine):
                logits = np.stack(vectors.to_numpy()[fine]).astype(np.float64) @ weights + offset
                if activate:
                    logits = 1 / (1 + np.exp(-np.clip(logits, -700, 700)))
                for at, row in zip(fine.tolist(), logits):
                    found[at] = row
            out["logits"] = found
            out["code"] = np.where(missing, "embedding_missing", np.where(wrong, "head_input_width_mismatch", None))
            yield out

    return windows.select(*key_columns, "embedding").mapInPandas(run, schema)


MODELS: dict[str, Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]] = {}


def register_model(name: str):
    """Decorator that enters a user's model, a function of an iterator of batches, under ``name/version``."""

    def enter(run):
        if name in MODELS:
            raise ValueError(f"{name} is registered already")
        MODELS[name] = run
        return run

    return enter


def run_model(name: str, inputs: DataFrame, schema: str) -> DataFrame:
    """Windows that the registered model returns for the rows of ``inputs``."""
    if name not in MODELS:
        raise KeyError(f"no model {name}; registered: {sorted(MODELS)}")
    return inputs.mapInPandas(MODELS[name], schema)
