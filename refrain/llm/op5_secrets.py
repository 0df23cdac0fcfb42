"""Query of operator 5: secrets of all documents, with linked weak parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.common import table
from refrain.llm.secrets import BASE, find_secrets, spans_text


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, the digest of the base spans, and all spans."""
    out = find_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return out.select(
        "doc_id", *map(_count, BASE), F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text("spans").alias("spans")
    )


QUERIES = {"op5_secrets": op5_secrets}
ORACLES: dict[str, str] = {}
