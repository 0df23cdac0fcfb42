"""Query of operator 2: base counts and learned quality rules of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refrain.llm.common import table
from refrain.llm.quality import judge


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rules."""
    out = judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rules"
    )


QUERIES = {"op2_quality_rules": op2_quality_rules}
ORACLES: dict[str, str] = {}
