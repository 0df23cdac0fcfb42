"""Query of operator 11: the twenty best documents of every benchmark item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.common import table
from refrain.llm.ranked import search


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """item_id, rank, doc_id, score of all documents against all items."""
    found = search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)
    return found.withColumn("rank", F.col("rank").cast("int"))


QUERIES = {"op11_ranked_search": op11_ranked_search}
_TERMS = r"""unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""
ORACLES = {
    "op11_ranked_search": f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
words AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf
          FROM (SELECT row, doc_id, {_TERMS} AS term FROM docs) GROUP BY row, term),
sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM words GROUP BY row),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM words, whole GROUP BY term, n_docs),
asked AS (SELECT item_id, term, count(*) AS q
          FROM (SELECT item_id, {_TERMS} AS term FROM benchmark) GROUP BY item_id, term),
scored AS (
    SELECT item_id, row, any_value(doc_id) AS doc_id,
           CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN words USING (term) JOIN weights USING (term) JOIN sizes USING (row), whole
    GROUP BY item_id, row)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank,
       doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20""",
}
