"""Query of operator 13: every document encoded into pieces and decoded again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.llm.common import table
from refrain.llm.pieces import decode, encode


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [batch.column(c) for c in ("ids", "starts", "ends")]
        offsets = lists[0].offsets.to_numpy()
        ids, starts, ends = (c.values.to_numpy() for c in lists)
        packed = ids.astype("<u4")
        bounds = list(zip(offsets[:-1], offsets[1:]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array([hashlib.sha256(packed[a:b].tobytes()).hexdigest() for a, b in bounds], pa.string()),
                batch.column("decoded_sha256"),
                pa.array([int((ends[a:b] - starts[a:b]).sum()) for a, b in bounds], pa.int64()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"],
        )


def op13_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, n_tokens, the digests of the ids and of the decoded text, and the source bytes that the pieces cover."""
    out = decode(encode(table(spark, folder, "documents"), keep=["doc_id"]))
    return out.select("doc_id", "ids", "starts", "ends", F.sha2("decoded", 256).alias("decoded_sha256")).mapInArrow(
        _digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"
    )


QUERIES = {"op13_pieces": op13_pieces}
ORACLES: dict[str, str] = {}
