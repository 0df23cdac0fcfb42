"""A training corpus from raw documents, as stages that hand on tables.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row that the one before it kept. A stage's
result is written as Parquet in the shared folder and read again, so a lost executor costs one stage. All but
the last return the columns of documents. Null doc_ids, repeated rows and doc_ids with several texts are allowed:
every stage decides by row, never by doc_id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm import bpe, language, mixing, near_dedup, secrets
from refrain.llm.common import small_batches, text_key
from refrain.sources.storage import stage_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Columns beside the text.
BESIDE = ["doc_id", "lang", "source", "n_chars"]
#: An ambiguous text below this score is rejected. On 10,000 generated documents four are, of one to three words
#: or with more licence text than words of their own; no other text is ambiguous and as low.
LEAST_SCORE = 0.45


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a language. Rows without any letter go, and those whose nearest codeword is ambiguous and scores
    less than ``LEAST_SCORE``. A missing label is filled with the predicted one."""
    small_batches(spark)
    out = language.identify(docs, language.learn(docs), keep=COLUMNS)
    known = (F.col("lang_pred") != language.UNKNOWN) & ~(F.col("ambiguous") & (F.col("score") < LEAST_SCORE))
    return out.filter(known).select("doc_id", "text", F.coalesce("lang", "lang_pred").alias("lang"), "source", "n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, 0.8): the one with the smallest doc_id, null last.

    Rows are numbered and written first, so groups are of rows, whatever their doc_ids.
    """
    small_batches(spark)
    rows = stage_table(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "numbered")
    marked = near_dedup.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), shingle=5, percent=80)
    groups = marked.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    kept = groups.groupBy("component_id").agg(first).select(F.col("first.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets replaced by a mark and n_chars counted anew where the text changed."""
    small_batches(spark)
    spans = secrets.find_secrets(docs).filter(F.size("spans") > 0).distinct()
    rows = docs.withColumn("text_key", text_key("text")).alias("d")
    joined = rows.join(spans.alias("s"), F.expr("d.doc_id <=> s.doc_id AND d.text_key = s.text_key"), "left")
    joined = joined.withColumn("clean", F.when(F.col("spans").isNotNull(), secrets.redacted("text", "spans")))
    return joined.select(
        "d.doc_id",
        F.coalesce("clean", "d.text").alias("text"),
        "d.lang",
        "d.source",
        F.coalesce(F.length("clean").cast("long"), F.col("d.n_chars")).alias("n_chars"),
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, at most three times."""
    counted = mixing.mix_sources(docs, keep=COLUMNS).filter("copies > 0")
    repeated = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens, ids, and whether the ids decode to the text's bytes."""
    small_batches(spark)
    out = bpe.decode(bpe.encode(docs.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256)), keep=[*BESIDE, "digest"]))
    return out.select(
        *BESIDE,
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.sha2("decoded", 256) == F.col("digest")).alias("decodes"),
    )


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix),
    ("tokens", encode),
]
#: Learned and iterative stages have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
