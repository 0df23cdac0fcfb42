"""Query of operator 4: every document encoded and decoded again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.bpe import decode, encode
from refrain.llm.common import table


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    out = decode(encode(table(spark, folder, "documents"), keep=["doc_id"]))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op4_byte_bpe": op4_byte_bpe}
ORACLES: dict[str, str] = {}
