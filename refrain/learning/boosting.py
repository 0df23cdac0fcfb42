"""Discrete adaptive boosting of weighted decision stumps, one pass over one coded table per round.

* **Cuts.** The candidate cuts of a round are the quantiles of the row weights of that round, at most ``BINS`` - 1 per
  feature, as MLlib's trees choose them: over all rows, or over a hash sample of about ``SAMPLE`` of them.
* **Coded table.** A cut always lies halfway between neighbouring values of that sample, so the sample is read once and a
  row is written once as its place among all such halves (two bytes a feature). Every round's cuts are some of those places.
* **Rounds.** A task works out its rows' weights from the stumps so far, adds them up by (feature, bin, class); the sums meet
  by feature and leave as the best cut of each. The error rate of the best one follows from its own sums.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from refrain.learning.prepare import FEATURES, KEY, LABEL, WEIGHT
from refrain.sources.storage import drop_stages, shared_dir, stage_table

#: Bins of a feature, and the rows that cuts are learned from, both as in MLlib's trees.
BINS, SAMPLE = 32, 10_000


@dataclass(frozen=True)
class Stump:
    """Class ``low`` where the feature is at most the threshold, else class ``high``."""

    feature: int
    threshold: float
    low: float
    high: float

    def prediction(self, values: Column) -> Column:
        if self.low == self.high:
            return F.lit(self.low)
        return F.when(values[self.feature] <= self.threshold, self.low).otherwise(self.high)


class BoostedStumps:
    """Each round fits a depth-1 tree to the current row weights and raises the weight of the
    rows it gets wrong. Only the best cut of each feature reaches the driver in a round; row
    weights follow from the stumps and are worked out where the rows are."""

    def __init__(self, rounds: int = 100, learning_rate: float = 0.1, seed: int = 42):
        self.rounds, self.learning_rate, self.seed = rounds, learning_rate, seed

    def fit(self, rows: DataFrame) -> BoostedStumpsModel:
        shared_dir(rows.sparkSession)
        values = vector_to_array(FEATURES)
        mark = F.xxhash64(*[KEY] if KEY in rows.columns else [], values, F.col(LABEL), F.lit(self.seed))
        plain = rows.select(
            values.alias("values"),
            F.col(LABEL).cast("int").alias("label"),
            F.col(WEIGHT).cast("double").alias("weight"),
            (F.pmod(mark, F.lit(1 << 32)) / float(1 << 32)).alias("share"),
        )
        n, total, classes, width = plain.agg(F.count("*"), F.sum("weight"), F.max("label") + 1, F.max(F.size("values"))).first()
        fraction = min(1.0, SAMPLE / n)
        drawn = plain if fraction == 1.0 else plain.filter(F.col("share") < fraction)
        sample = _Sample(drawn.select("values", "label", "weight").toArrow(), width, fraction, min(BINS, n) - 1)
        written = stage_table(plain.drop("share").mapInArrow(_coded(sample.halves), "codes binary, label int, weight double"), "codes")
        state = written.persist(StorageLevel.MEMORY_AND_DISK)
        stumps, votes, steps = [], [], []
        try:
            for _ in range(self.rounds):
                cuts = sample.cuts(total)
                found = _best(state, steps, cuts, [len(h) for h in sample.halves], classes)
                stump, place, lost, total = _stump(found, cuts, sample.halves)
                error = lost / total
                if error >= 0.5:
                    break
                stumps.append(stump)
                if error <= 0.0:
                    votes.append(1.0)
                    break
                vote = self.learning_rate * math.log((1 - error) / error)
                votes.append(vote)
                # Dividing by the new total keeps the weights summing to one over all rounds.
                grown = total + lost * (math.exp(vote) - 1)
                steps.append((stump.feature, place, stump.low, stump.high, math.exp(vote) / grown, 1.0 / grown))
                sample.weigh(steps[-1])
                total = 1.0
        finally:
            state.unpersist()
            drop_stages(written)
        if not stumps:
            raise ValueError("no stump does better than chance on these rows")
        return BoostedStumpsModel(stumps, votes, width)


class _Sample:
    """The rows that cuts are learned from, with their weights of the current round."""

    def __init__(self, rows: pa.Table, width: int, fraction: float, most: int):
        values = rows.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        self.label, self.weight = rows.column("label").to_numpy(), rows.column("weight").to_numpy()
        self.fraction, self.most = fraction, most
        self.values, self.place, self.halves = [], [], []
        for column in values.T:
            known, place = np.unique(np.append(column[~np.isnan(column)], 0.0), return_inverse=True)
            self.values.append(known)
            self.place.append(np.full(len(column), len(known)))
            self.place[-1][~np.isnan(column)] = place[:-1]
            rest = known[known != 0]
            self.halves.append(np.unique(np.concatenate([(v[:-1] + v[1:]) / 2 for v in (known, rest)])))
        self.codes = to_codes(values, self.halves)

    def weigh(self, step: tuple) -> None:
        self.weight = _weights(self.codes, self.label, self.weight, [step])

    def cuts(self, total: float) -> list[np.ndarray]:
        """The cuts of each feature for the current weights, as places among its halves."""
        expected = self.weight.sum() if self.fraction == 1.0 else self.fraction * total
        out = []
        for values, place, halves in zip(self.values, self.place, self.halves):
            counts = np.bincount(place, self.weight, len(values) + 1)[: len(values)]
            zero = np.searchsorted(values, 0.0)
            if self.fraction < 1.0:
                # Zeros are what is missing from the expected weight of the sample, as in MLlib.
                rest = expected - (counts.sum() - counts[zero])
                counts[zero] = rest if rest > np.finfo(float).eps * 100 * expected else 0.0
                there = np.arange(len(values)) != zero if counts[zero] == 0 else slice(None)
            else:
                there = np.arange(len(values)) != zero if not (place == zero).any() else slice(None)
            cuts = weighted_cuts(values[there], counts[there], expected, self.most)
            out.append(np.searchsorted(halves, cuts))
        return out


def weighted_cuts(values: np.ndarray, counts: np.ndarray, total: float, most: int) -> np.ndarray:
    """At most ``most`` cuts between sorted values that part their weights evenly: where a running total comes closest
    to the next multiple of the stride."""
    halves = (values[:-1] + values[1:]) / 2
    if len(halves) <= most:
        return halves
    running, stride = np.cumsum(counts).tolist(), total / (most + 1)
    target, i, out = stride, 1, []
    while True:
        i = max(i, bisect_right(running, target))
        while i < len(running) and not abs(running[i - 1] - target) < abs(running[i] - target):
            i += 1
        if i >= len(running):
            return halves[out]
        out.append(i - 1)
        target, i = target + stride, i + 1


def to_codes(values: np.ndarray, halves: list[np.ndarray]) -> np.ndarray:
    """For each value of a (rows, features) table the number of halves below it."""
    out = np.empty(values.shape, np.uint16)
    for i, h in enumerate(halves):
        out[:, i] = np.searchsorted(h, values[:, i], "left")
    return out


def _coded(halves: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(halves))
            codes = pa.array([r.tobytes() for r in to_codes(values, halves)], pa.binary())
            yield pa.RecordBatch.from_arrays([codes, *batch.columns[1:]], ["codes", "label", "weight"])

    return run


def _weights(codes: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: list[tuple]) -> np.ndarray:
    """Row weights after some rounds: (feature, place, low, high, factor where wrong, factor where right) each."""
    for feature, place, low, high, wrong, right in steps:
        predicted = np.where(codes[:, feature] <= place, low, high)
        weight = weight * np.where(predicted != label, wrong, right)
    return weight


def _best(state: DataFrame, steps: list[tuple], cuts: list[np.ndarray], sizes: list[int], classes: int) -> list:
    """The best cut of each feature in one pass: (feature, gain, cut, class weights on the left and on the right)."""
    sums = state.mapInArrow(_sums(steps, cuts, sizes, classes), "feature int, part int, sums array<double>")
    kinds = "feature int, gain double, cut int, low array<double>, high array<double>"
    found = sums.repartition("feature").mapInArrow(_best_cuts([len(c) for c in cuts], classes), kinds).collect()
    return sorted(found, key=lambda r: r.feature)


def _stump(found: list, cuts: list[np.ndarray], halves: list[np.ndarray]) -> tuple[Stump, int, float, float]:
    """(stump, its place among the halves, weight of the rows it gets wrong, weight of all rows)."""
    best = max(found, key=lambda r: r.gain)  # of equal gains the first feature's
    low, high = np.array(best.low), np.array(best.high)
    whole = low + high
    if best.gain > 0 and low.argmax() != high.argmax():
        place = int(cuts[best.feature][best.cut])
        stump = Stump(best.feature, float(halves[best.feature][place]), float(low.argmax()), float(high.argmax()))
        lost = low.sum() - low.max() + high.sum() - high.max()
    else:
        only = float(whole.argmax())
        place, stump = 0, Stump(0, 0.0, only, only)
        lost = whole.sum() - whole.max()
    return stump, place, float(lost), float(whole.sum())


def _sums(steps: list[tuple], cuts: list[np.ndarray], sizes: list[int], classes: int):
    """Row weights, then rows, of a whole task by (bin, class): one row per feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, side = len(cuts), max(len(c) for c in cuts) + 1
        starts = np.cumsum([0, *[s + 1 for s in sizes[:-1]]])
        cells = np.concatenate([f * side + np.searchsorted(c, np.arange(s + 1)) for f, (c, s) in enumerate(zip(cuts, sizes))])
        cells *= classes
        sums = np.zeros((2, width * side * classes))
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint16).reshape(-1, width)
            label = batch.column("label").to_numpy()
            weight = _weights(codes, label, batch.column("weight").to_numpy(), steps)
            key = (cells[codes + starts] + label[:, None]).ravel()
            sums[0] += np.bincount(key, np.repeat(weight, width), sums.shape[1])
            sums[1] += np.bincount(key, minlength=sums.shape[1])
        tables = sums.reshape(2, width, -1).transpose(1, 0, 2).reshape(width, -1)
        offsets = pa.array(np.arange(width + 1) * tables.shape[1], pa.int32())
        part = np.full(width, TaskContext.get().partitionId(), np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width, dtype=np.int32)), pa.array(part), pa.ListArray.from_arrays(offsets, pa.array(tables.ravel()))],
            ["feature", "part", "sums"],
        )

    return run


def _gini(weights: np.ndarray) -> np.ndarray:
    total = weights.sum(-1, keepdims=True)
    return 1 - (np.divide(weights, total, out=np.zeros(weights.shape), where=total > 0) ** 2).sum(-1)


def _best_cuts(counts: list[int], classes: int):
    """The sums of all tasks added up, in the order of the tasks; the cut of each feature with the largest Gini gain.

    A feature without a cut that leaves rows on both sides has gain -1 and all weights on the left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, list] = {}
        for batch in batches:
            for feature, part, sums in zip(*(batch.column(c) for c in ("feature", "part", "sums"))):
                tables.setdefault(feature.as_py(), []).append((part.as_py(), sums.values.to_numpy()))
        out = []
        for feature, parts in tables.items():
            added = sum(t for _, t in sorted(parts, key=lambda p: p[0]))
            weight, rows = (np.cumsum(x, 0) for x in added.reshape(2, -1, classes))
            low, whole = weight[: counts[feature]], weight[-1]
            high, below = whole - low, rows[: counts[feature]].sum(1)
            share = low.sum(1) / whole.sum()
            gain = _gini(whole) - share * _gini(low) - high.sum(1) / whole.sum() * _gini(high)
            gain = np.where((below > 0) & (below < rows[-1].sum()) & (gain >= 0), gain, -1.0)
            cut = int(gain.argmax()) if len(gain) else -1
            if cut >= 0 and gain[cut] >= 0:
                out.append((feature, float(gain[cut]), cut, low[cut].tolist(), high[cut].tolist()))
            else:
                out.append((feature, -1.0, 0, whole.tolist(), [0.0] * classes))
        if out:
            kinds = (pa.int32(), pa.float64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["feature", "gain", "cut", "low", "high"])

    return run


class BoostedStumpsModel:
    def __init__(self, stumps: list[Stump], votes: list[float], features: int):
        self.stumps, self.votes, self.features = stumps, votes, features

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds ``probability`` and ``prediction``: the weighted votes of all stumps as one built-in expression."""
        whole = rows.withColumn("_values", vector_to_array(FEATURES))
        tally = F.lit(0.0)
        for stump, vote in zip(self.stumps, self.votes):
            tally = tally + F.when(stump.prediction(F.col("_values")) == 1, vote).otherwise(-vote)
        margin = F.col("_margin")
        churn = 1 / (1 + F.exp(-2 * margin))
        return whole.withColumn("_margin", tally / sum(self.votes)).select(
            *rows.columns,
            array_to_vector(F.array(1 - churn, churn)).alias("probability"),
            (margin > 0).cast("double").alias("prediction"),
        )

    @property
    def featureImportances(self) -> DenseVector:
        """Share of the votes that split on each feature."""
        shares = [0.0] * self.features
        for stump, vote in zip(self.stumps, self.votes):
            if stump.low != stump.high:
                shares[stump.feature] += vote / sum(self.votes)
        return DenseVector(shares)

    def save(self, path: str) -> None:
        rows = [(i, *astuple(s), v, self.features) for i, (s, v) in enumerate(zip(self.stumps, self.votes))]
        kinds = "stump int, feature int, threshold double, low double, high double, vote double, features int"
        table = SparkSession.active().createDataFrame(rows, kinds)
        table.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> BoostedStumpsModel:
        rows = SparkSession.active().read.parquet(path).orderBy("stump").collect()
        stumps = [Stump(r.feature, r.threshold, r.low, r.high) for r in rows]
        return cls(stumps, [r.vote for r in rows], rows[0].features)
