"""Query of operator 7: words of repeated passages removed from all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.common import table
from refrain.llm.substring_dedup import remove_repeats


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words, for windows of 13 words."""
    out = remove_repeats(table(spark, folder, "documents"), window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op7_substring_dedup": op7_substring_dedup}
ORACLES: dict[str, str] = {}
