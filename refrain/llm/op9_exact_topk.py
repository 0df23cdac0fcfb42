"""Query of operator 9: the five best partners of every fiftieth vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.common import table
from refrain.llm.topk import scaled, top_k, usable


def op9_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """query_id, rank, vec_id, score over components floor(256 * x)."""
    vectors = table(spark, folder, "embeddings").filter(usable("embedding"))
    vectors = vectors.select(F.col("vec_id").alias("id"), scaled("embedding").alias("vector"))
    found = top_k(vectors, vectors.filter("id % 50 = 0"), k=5)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


QUERIES = {"op9_exact_topk": op9_exact_topk}
ORACLES = {
    "op9_exact_topk": """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
