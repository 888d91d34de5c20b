"""A corpus from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, packing, quality_rules, simhash, substring_dedup
from tidemark.llm._scratch import Scratch

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("exact_dedup", exact_dedup.stage),
    ("simhash_near_dedup", simhash.stage),
    ("substring_dedup", substring_dedup.stage),
    ("best_fit_packing", packing.stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on ``documents``; only the table between two stages is kept."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.save(name, docs)
            if number:
                scratch.drop(STAGES[number - 1][0])
    return docs


#: SimHash components and tokenizer ids are beyond SQL; tests/llm/test_pipeline.py holds the rows against plain Python.
ORACLE_SQL = None
