"""A corpus pipeline: language, exact copies, near copies, mix of sources, packed sequences."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import stages
from barloom.llm.common import stage, table

STAGES = [
    ("language_id", stages.identified),
    ("exact_dedup", stages.without_copies),
    ("near_dedup", stages.without_near_copies),
    ("mixing", stages.mixed),
    ("packing", stages.packed),
]

# Language identification and near-duplicates by signatures are not expressible in SQL; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
