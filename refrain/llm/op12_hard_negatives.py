"""Query of operator 12: hard negatives of every hundredth vector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.common import table
from refrain.llm.negatives import hard_negatives
from refrain.llm.topk import usable


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, with every seventh label moved on by one."""
    rows = table(spark, folder, "embeddings").filter(usable("embedding") & F.col("label").isNotNull())
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    found = hard_negatives(vectors, vectors.filter("id % 100 = 0"))
    return found.withColumn("rank", F.col("rank").cast("int"))


QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLES = {
    "op12_hard_negatives": """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INT) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5""",
}
