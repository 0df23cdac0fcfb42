"""Hard-negative mining with Strassen products of integer tiles and mergeable heaps.

Candidates are dealt once into shards by hash and stay there; anchors are sent to every shard and stream past
its rows in small blocks, so a task holds one shard and one block of anchors. The scores of a block are one
Strassen product of int64 matrices: padded with zeros to even sides, split into quarters, seven products
of sums instead of eight. All sums are exact (modulo 2^64).

1. **Positive heaps.** Each (anchor, shard) keeps its best rows of the anchor's label; heaps of all shards are
   merged into the anchor's positives.
2. **Window heaps.** Anchors stream past the shards again, now with their positives; each (anchor, positive, shard)
   keeps its best rows of other labels inside the window that the positive's score sets, and these are merged.

With ``s`` shards an anchor moves ``s`` times and a candidate once. There are so many shards that anchors take about
as much room as candidates, within the bounds on a shard's rows that a task's memory sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard at least (else tasks are too small), components of a shard at most (a task holds them all).
LEAST, MOST = 1 << 11, 1 << 23
#: Anchors that meet a shard at once.
BLOCK = 64
#: Side below which a product is taken directly.
DIRECT = 32
#: Components beyond this are held there, so that they fit a long number.
_LARGEST = float((1 << 63) - 1024)


def strassen(a: np.ndarray, b: np.ndarray, direct: int = DIRECT) -> np.ndarray:
    """The product of two int64 matrices, exact modulo 2^64."""
    m, k, n = *a.shape, b.shape[1]
    if min(m, k, n) <= direct:
        return a @ b
    a, b = _even(a), _even(b)
    x, y, z = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:x, :y], a[:x, y:], a[x:, :y], a[x:, y:]
    b11, b12, b21, b22 = b[:y, :z], b[:y, z:], b[y:, :z], b[y:, z:]
    p1 = strassen(a11 + a22, b11 + b22, direct)
    p2 = strassen(a21 + a22, b11, direct)
    p3 = strassen(a11, b12 - b22, direct)
    p4 = strassen(a22, b21 - b11, direct)
    p5 = strassen(a11 + a12, b22, direct)
    p6 = strassen(a21 - a11, b11 + b12, direct)
    p7 = strassen(a12 - a22, b21 + b22, direct)
    out = np.empty((2 * x, 2 * z), np.int64)
    out[:x, :z] = p1 + p4 - p5 + p7
    out[:x, z:] = p3 + p5
    out[x:, :z] = p2 + p4
    out[x:, z:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def _even(a: np.ndarray) -> np.ndarray:
    """The matrix with zeros added to an odd side."""
    if not (a.shape[0] % 2 or a.shape[1] % 2):
        return a
    out = np.zeros((a.shape[0] + a.shape[0] % 2, a.shape[1] + a.shape[1] % 2), np.int64, order="F")
    out[: a.shape[0], : a.shape[1]] = a
    return out


def scaled(vectors: np.ndarray, factor: int) -> np.ndarray:
    """Components times ``factor``, rounded down, as int64."""
    return np.clip(np.floor(vectors.astype(np.float64) * factor), -_LARGEST, _LARGEST).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest allowed scores, ties by smaller id; all, if fewer."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        # All at the border stay until the ids decide.
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _matrix(batch: pa.RecordBatch, width: int, factor: int) -> np.ndarray:
    column = batch.column("vector")
    return scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width), factor)


def _runs(batch: pa.RecordBatch, most: int) -> Iterator[tuple[tuple[int, int, bool], pa.RecordBatch]]:
    """Parts of a batch with one (shard, width, is anchor), of at most ``most`` rows if they are anchors."""
    keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("shard", "width", "anchor")])
    breaks = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
    bounds = [0, *breaks.tolist(), batch.num_rows] if batch.num_rows else []
    for a, b in zip(bounds, bounds[1:]):
        shard, width, anchor = keys[:, a].tolist()
        step = most if anchor else b - a
        for start in range(a, b, step):
            yield (shard, width, bool(anchor)), batch.slice(start, min(step, b - start))


def _distinct(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows without those equal to another in all parts; equal ids are always in one shard."""
    if len(np.unique(ids)) < len(ids):
        rows = np.unique(np.column_stack([ids, labels, vectors]), axis=0)
        ids, labels, vectors = rows[:, 0], rows[:, 1], np.ascontiguousarray(rows[:, 2:])
    return ids, labels, vectors


def _tiles(batches: Iterator[pa.RecordBatch], factor: int) -> Iterator[tuple]:
    """(anchors, their shard's ids, labels, scores) of each block of anchors.

    Rows come in the order (shard, width, anchor), so a shard's candidates come before the anchors that meet them.
    """
    place, parts, held = None, [], None
    for batch in batches:
        for (shard, width, anchor), part in _runs(batch, BLOCK):
            if place != (shard, width):
                place, parts, held = (shard, width), [], None
            if not anchor:
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
                parts.append((ids, labels, _matrix(part, width, factor)))
            elif parts:
                held = held or _distinct(*[np.concatenate(c) for c in zip(*parts)])
                yield part, held[0], held[1], strassen(_matrix(part, width, factor), held[2].T)


def _table(columns: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    arrays = [pa.array(np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names)


def _positives(batches: Iterator[pa.RecordBatch], k: int, factor: int) -> Iterator[pa.RecordBatch]:
    for part, ids, labels, scores in _tiles(batches, factor):
        out: list[list[np.ndarray]] = [[] for _ in range(4)]
        own = [part.column(c).to_numpy(zero_copy_only=False) for c in ("row", "id", "label")]
        for i, (row, anchor, label) in enumerate(zip(*own)):
            at = best(scores[i], ids, (labels == label) & (ids != anchor), k)
            for column, values in zip(out, (np.full(len(at), row), np.full(len(at), anchor), ids[at], scores[i, at])):
                column.append(values)
        yield _table(out, ["row", "anchor_id", "positive_id", "positive_score"])


def _negatives(batches: Iterator[pa.RecordBatch], k: int, factor: int, low: int) -> Iterator[pa.RecordBatch]:
    for part, ids, labels, scores in _tiles(batches, factor):
        out: list[list[np.ndarray]] = [[] for _ in range(6)]
        own = [part.column(c).to_numpy(zero_copy_only=False) for c in ("row", "id", "label")]
        positives = [part.column(c).to_pylist() for c in ("positive_ids", "positive_scores")]
        for i, (row, anchor, label, found, tops) in enumerate(zip(*own, *positives)):
            other = labels != label
            if not tops:
                continue
            # The largest window of all positives first; what lies below it is of no use to any.
            other &= scores[i] <= max(tops)
            at = np.flatnonzero(other)
            mine, names = scores[i, at], ids[at]
            for positive, top in zip(found, tops):
                # low * top <= 100 * score, in whole numbers that cannot overflow.
                least = -((-low * top) // 100)
                hit = best(mine, names, (mine <= top) & (mine >= least), k)
                n = len(hit)
                values = (np.full(n, row), np.full(n, anchor), np.full(n, positive), np.full(n, top), names[hit], mine[hit])
                for column, value in zip(out, values):
                    column.append(value)
        yield _table(out, ["row", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def _merged(heaps: DataFrame, keys: list[str], ident: str, score: str, k: int) -> DataFrame:
    """Heaps of all shards merged: first those of a group of shards, then the groups."""
    order = [F.desc(score), F.asc(ident)]
    for by in ([*keys, F.pmod(F.xxhash64(ident), F.lit(32))], keys):
        heaps = heaps.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(
            F.col("rank") <= k
        )
    return heaps


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, factor: int = 256
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Both tables have ``id`` long, ``label`` and ``vector`` (numbers, none null or infinite). Components become
    ``floor(factor * x)``; those beyond 64 bits are held at the largest long number, sums are modulo 2^64. An
    anchor's positives are its best ``positives`` rows of the same label and another id; its negatives for one
    of them the best ``negatives`` rows of another label with ``low`` * positive <= 100 * negative <= 100 * positive.
    Higher scores come first, then smaller ids. Null ids, labels and vectors take no part; rows equal in id,
    label and vector count once, an anchor id with several labels or vectors gets rows for each. Vectors
    meet only vectors of their length. A window without rows gives none. Other columns are not read.
    """

    vectors, anchors = (
        t.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").select(
            F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "vector"
        )
        for t in (vectors, anchors)
    )
    anchors = anchors.dropDuplicates(["id", "label", "vector"])
    kind = vectors.schema["vector"].dataType.simpleString()
    n, components = vectors.agg(F.count("*"), F.sum(F.size("vector"))).first()
    room = max(1, n // max(anchors.count(), 1))
    n_shards = max(1, -(-(components or 0) // MOST), min(-(-n // LEAST), room))
    resident = vectors.select(
        F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int").alias("shard"),
        F.size("vector").alias("width"),
        F.lit(0).alias("anchor"),
        F.lit(None).cast("long").alias("row"),
        "id",
        "label",
        "vector",
    )
    # One list of positives per anchor row, whichever its id.
    moving = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"),
        F.size("vector").alias("width"),
        F.lit(1).alias("anchor"),
        F.xxhash64("id", "label", "vector").alias("row"),
        "id",
        "label",
        F.col("vector").cast(kind).alias("vector"),
    )

    def met(moving: DataFrame, run, schema: str) -> DataFrame:
        both = resident.unionByName(moving, allowMissingColumns=True)
        dealt = both.repartition(n_shards, "shard").sortWithinPartitions("shard", "width", "anchor")
        return dealt.mapInArrow(run, schema)

    heaps = met(
        moving, partial(_positives, k=positives, factor=factor), "row long, anchor_id long, positive_id long, positive_score long"
    )
    merged = _merged(heaps, ["row", "anchor_id"], "positive_id", "positive_score", positives)
    found = merged.groupBy("row", "anchor_id").agg(
        F.collect_list("positive_id").alias("positive_ids"), F.collect_list("positive_score").alias("positive_scores")
    )
    asking = moving.join(found.withColumnRenamed("anchor_id", "id"), ["row", "id"])
    windows = met(
        asking,
        partial(_negatives, k=negatives, factor=factor, low=low),
        "row long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    merged = _merged(windows, ["row", "anchor_id", "positive_id"], "negative_id", "negative_score", negatives)
    return merged.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
