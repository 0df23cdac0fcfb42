"""Query of operator 1: near-duplicate groups of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refrain.llm.common import table
from refrain.llm.near_dedup import near_duplicates


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept over 3-word shingles at a similarity of 0.85."""
    found = near_duplicates(table(spark, folder, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept", "class_size")


QUERIES = {"op1_near_dedup": op1_near_dedup}
ORACLES: dict[str, str] = {}
