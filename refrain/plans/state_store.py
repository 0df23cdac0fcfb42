"""Month states of listening logs kept in a table and brought up to date chunk by chunk.

The logs lie in a folder partitioned by ``chunk`` (a day, a week, a delivery). Only chunks whose files changed are read
and folded again; all others keep their states. A copy of a row may only lie in the row's own chunk, as where chunks are
spans of days: duplicates are removed within a chunk.

* ``states/chunk=../version=..``: the states of one chunk, in the version of its files. A refresh overwrites only the
  partitions it writes, so one that died is simply run again.
* ``ledger/step=..``: one row per chunk with the version that counts. A step is written last and counts only when it is
  finished, so readers see the whole state before a refresh or the whole state after it.

One refresh runs at a time. Versions that no longer count stay until ``sweep``, for readers that are still on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from refrain.operators import cleaning, profiles
from refrain.sources.storage import delete_folders, finished_folders, folder_exists

CHUNK, VERSION = "chunk", "version"
LEDGER = f"{CHUNK} string, {VERSION} string"


def write_chunks(logs: DataFrame, path: str) -> None:
    """Write log rows with a ``chunk`` column; chunks written before are replaced, others stay."""
    write = logs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write.partitionBy(CHUNK).parquet(path)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime, chunk, version) of all files below ``path``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)

    def named(partition: str):
        value = F.regexp_extract("path", f"/{partition}=([^/]*)/", 1)
        return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))).alias(partition)

    return files.select("path", "length", "modificationTime", named(CHUNK), named(VERSION))


def _partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned table whose partition columns are text, whatever their values look like."""
    fields = spark.read.parquet(path).schema.fields
    texts = [StructField(f.name, StringType()) if f.name in (CHUNK, VERSION) else f for f in fields]
    return spark.read.schema(StructType(texts)).parquet(path)


def chunk_versions(spark: SparkSession, path: str) -> DataFrame:
    """(chunk, version): a digest of name, length and time of each chunk's files."""
    mark = F.xxhash64("path", "length", "modificationTime")
    versions = _listed(spark, path).groupBy(CHUNK).agg(F.bit_xor(mark).alias("marks"), F.count("*").alias("files"))
    return versions.select(CHUNK, F.format_string("%016x-%d", "marks", "files").alias(VERSION))


class StateStore:
    """The states of the logs in ``logs_path``, kept under ``path``."""

    def __init__(self, spark: SparkSession, logs_path: str, path: str):
        self.spark, self.logs_path, self.path = spark, logs_path, path.rstrip("/")

    def steps(self) -> list[str]:
        return finished_folders(self.spark, f"{self.path}/ledger")

    def ledger(self, step: str | None = None) -> DataFrame:
        """(chunk, version) that count at ``step``, the newest finished one unless given."""
        step = step or next(reversed(self.steps()), None)
        if step is None:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/{step}")

    def refresh(self) -> int:
        """Fold the changed chunks and write the next step; chunks without files leave the ledger.

        Returns the number of chunks folded. With nothing changed, nothing is written.
        """
        # A chunk is a folder: the driver holds their names as it does for any partitioned table.
        now = {r[CHUNK]: r[VERSION] for r in chunk_versions(self.spark, self.logs_path).collect()}
        steps = self.steps()
        before = {r[CHUNK]: r[VERSION] for r in self.ledger().collect()} if steps else {}
        changed = {c: v for c, v in now.items() if before.get(c) != v}
        if now == before and steps:
            return 0
        if changed:
            self._fold(changed)
        step = f"step={int(steps[-1].split('=')[1]) + 1 if steps else 0:08d}"
        counted = self.spark.createDataFrame(sorted(now.items()), LEDGER).coalesce(1)
        counted.write.mode("overwrite").parquet(f"{self.path}/ledger/{step}")
        return len(changed)

    def _fold(self, changed: dict[str, str]) -> None:
        # Names as literals reach the scan as a partition filter: files of other chunks are not opened.
        logs = _partitioned(self.spark, self.logs_path).filter(F.col(CHUNK).isin(list(changed)))
        states = profiles.month_states(cleaning.clean_log_rows(logs), CHUNK)
        versions = self.spark.createDataFrame(sorted(changed.items()), LEDGER)
        # One row per chunk folder.
        versioned = states.join(F.broadcast(versions), CHUNK)
        write = versioned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        write.partitionBy(CHUNK, VERSION).parquet(f"{self.path}/states")

    def states(self, step: str | None = None) -> DataFrame:
        """Month states per member over all chunks that count at ``step``, merged exactly."""
        stored = self._stored()
        if stored is None:
            raise ValueError(f"no state was ever written to {self.path}")
        return profiles.merge_states(stored.join(F.broadcast(self.ledger(step)), [CHUNK, VERSION], "left_semi"))

    def _stored(self) -> DataFrame | None:
        # Dynamic overwrites leave no success mark; the ledger says what counts.
        written = self.steps() and folder_exists(self.spark, f"{self.path}/states")
        return _partitioned(self.spark, f"{self.path}/states") if written else None

    def profile(self, step: str | None = None) -> DataFrame:
        """The listening profile of every member, from the stored states alone."""
        return profiles.log_profile(profiles.rank_months(self.states(step)))

    def sweep(self) -> int:
        """Delete states and steps that the newest step does not use; returns the number of partitions deleted.

        Not while readers are on an older step, nor beside a refresh.
        """
        if self._stored() is None:
            return 0
        steps = self.steps()
        files = _listed(self.spark, f"{self.path}/states").withColumn("at", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
        old = files.select(CHUNK, VERSION, "at").distinct().join(self.ledger(), [CHUNK, VERSION], "left_anti")
        left = [r["at"] for r in old.collect()]  # one row per replaced chunk
        delete_folders(self.spark, left + [f"{self.path}/ledger/{s}" for s in steps[:-1]])
        return len(left)
