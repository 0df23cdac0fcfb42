"""Query of operator 10: all documents mixed to source weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refrain.llm.common import table
from refrain.llm.mixing import LANES, mix_sources, offset


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies."""
    out = mix_sources(table(spark, folder, "documents"), keep=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


QUERIES = {"op10_mixing": op10_mixing}
ORACLES = {
    "op10_mixing": f"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
    SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
           source_size * 3.0::DOUBLE AS cap
    FROM sources),
filling AS (
    SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM weighed),
levels AS (
    SELECT a.*, ((SELECT sum(size) FROM docs) - coalesce((SELECT sum(cap) FROM filling b WHERE b.place < a.place), 0))
           / ((SELECT sum(weight) FROM filling) - coalesce((SELECT sum(weight) FROM filling b WHERE b.place < a.place), 0))
           AS level
    FROM filling a),
water AS (
    SELECT arg_min(level, place) AS water FROM levels WHERE NOT level * weight > cap),
targets AS (
    SELECT source, source_size, CASE WHEN level * weight > cap THEN cap ELSE water * weight END AS target
    FROM levels LEFT JOIN water ON true),
placed AS (
    SELECT docs.*, source_size, target, row_number() OVER (PARTITION BY docs.source ORDER BY size, doc_id % {LANES}, doc_id) AS place
    FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source),
taken AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS share FROM placed),
copied AS (
    SELECT *, (floor(share * place + {offset()}::DOUBLE) - floor(share * (place - 1) + {offset()}::DOUBLE))::BIGINT AS copies
    FROM taken)
SELECT doc_id, size::BIGINT AS size, source_size, target, (copies * size)::BIGINT AS taken, copies FROM copied""",
}
