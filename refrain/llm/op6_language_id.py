"""Query of operator 6: language of all documents, learned from two thirds of the ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.common import table
from refrain.llm.language import identify, learn


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous."""
    docs = table(spark, folder, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    out = identify(docs, learn(docs.filter(~held_out)), keep=["doc_id"])
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


QUERIES = {"op6_language_id": op6_language_id}
ORACLES: dict[str, str] = {}
