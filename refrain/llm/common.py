"""What the text operators share: reading tables, row keys, native word patterns and Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, and what separates words.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: Most bytes of text that an Arrow step handles at once; a longer single text is handled alone.
SLICE_BYTES = 1 << 20
#: Settings that bound what goes to a Python worker at once, and Spark's own values of them.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("2000", "10000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("4194304", "67108864b"),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session to a few megabytes, unless it has settings of its own."""
    for name, (value, default) in BATCHES.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, value)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def text_key(*columns: str) -> Column:
    """64-bit key of a row's content; nulls and empty texts differ."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*parts)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut to rows of at most ``limit`` bytes of text together; null texts stay null."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for row, size in enumerate(sizes):
            if row > start and total + size > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column; null as empty."""
    return [b or b"" for b in pc.cast(batch.column(column), pa.large_binary()).to_pylist()]


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
