"""CSV and parquet readers and writers, and the train / test label switch."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

SPLITS = ("train", "test")
#: Columns that a checked load adds to the columns of the file.
LINE, REASON, FILE, REJECTED = "_line", "_reason", "_file", "_rejected"


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a CSV file whose header names the schema's columns in order; another header is refused, as is a
    row that does not fit."""
    return spark.read.schema(schema).options(header=True, enforceSchema=False, mode="FAILFAST").csv(path)


@dataclass(frozen=True)
class CheckedRows:
    """The rows of a file that fit its schema, and the lines that do not: file, line and reason."""

    rows: DataFrame
    rejects: DataFrame


def _misfit(schema: StructType) -> Column:
    """Why a line was refused: its number of fields, or else the first column whose text is no value of its type."""
    texts = StructType()
    for column in [*schema.names, LINE]:
        texts = texts.add(column, StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE}
    parsed = F.from_csv(F.col(LINE), F.lit(texts.toDDL()), options)
    lost = [
        F.when(parsed[c].isNotNull() & F.col(c).isNull(), F.lit(f"no {schema[c].dataType.simpleString()} in {c}"))
        for c in schema.names
    ]
    wrong_size = F.when(parsed[LINE].isNotNull(), F.lit(f"not {len(schema)} fields"))
    return F.when(F.col(LINE).isNotNull(), F.coalesce(wrong_size, *lost, F.lit("unreadable")))


def load_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    target: str,
    days: tuple[str, ...] = (),
) -> CheckedRows:
    """Load CSV files into the table ``target`` in one pass; lines that do not fit are set aside with their reason.

    A line of another number of fields, or with text that is no value of its column's type, is rejected whole; the
    load goes on. Columns named in ``days`` hold yyyymmdd numbers and become dates; a day that does not exist is a
    reject too, an empty one is null. A file whose header names other columns still ends the load: there, no line can
    be trusted. Good and rejected lines lie in two partitions of the table, so readers of either never open the other's files.
    """
    options = {"header": True, "enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE}
    lines = spark.read.schema(StructType([*schema.fields]).add(LINE, StringType())).options(**options).csv(path)
    parsed = {c: F.try_to_date(F.col(c).cast("string"), "yyyyMMdd") for c in days}
    no_day = [F.when(F.col(c).isNotNull() & d.isNull(), F.lit(f"no such day in {c}")) for c, d in parsed.items()]
    whole_line = F.coalesce(F.col(LINE), F.to_csv(F.struct(*schema.names)))
    reasoned = lines.withColumn(FILE, F.col("_metadata.file_path")).withColumn(
        REASON, F.coalesce(_misfit(schema), *no_day, F.lit(None).cast("string"))
    )
    refused = F.col(REASON).isNotNull()
    checked = reasoned.select(
        *[parsed.get(c, F.col(c)).alias(c) for c in schema.names],
        FILE,
        REASON,
        F.when(refused, whole_line).alias(LINE),
        refused.alias(REJECTED),
    )
    write_parquet(checked, target, partition_by=(REJECTED,))
    stored = spark.read.schema(checked.schema).parquet(target)
    good, bad = stored.filter(~F.col(REJECTED)), stored.filter(REJECTED)
    return CheckedRows(good.select(*schema.names), bad.select(*[F.col(c).alias(c[1:]) for c in (FILE, LINE, REASON)]))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One scan over any number of files and folders of part files."""
    return spark.read.parquet(*paths)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_logs_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Log rows with ``date`` parsed from its yyyymmdd number; a bad date becomes null."""
    return read_csv(spark, path, schema).withColumn(
        "date", F.try_to_date(F.col("date").cast("string"), "yyyyMMdd")
    )


def label_source(labels: Mapping[str, DataFrame], split: str) -> DataFrame:
    """The label table of a split; any name but "train" and "test" is refused."""
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, not {split!r}")
    return labels[split]


def first_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first ``n`` rows in key order: a top-k per partition, then a merge of those."""
    return df.orderBy(*keys).limit(n)
