"""Folders that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``; where that is unset below a local one, but only under a local master (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="tidemark-"))
        root = _own[0]
    return f"{root.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
