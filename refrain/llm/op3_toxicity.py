"""Query of operator 3: toxicity of all documents, learned from three quarters of the ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.common import table
from refrain.llm.toxicity import learn, score_toxicity


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    out = score_toxicity(docs, *learn(docs, labels.filter(~held_out)), keep=["doc_id"])
    return out.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLES: dict[str, str] = {}
