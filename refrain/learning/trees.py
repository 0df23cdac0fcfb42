"""Boosted trees with second-order leaves, grown on one binned table.

* **Binned table.** Each feature is cut once at its quantiles; a row becomes one byte a feature, bin 0 for a missing
  value. The table is written once, all rounds read it.
* **Histograms.** One pass adds up gradients and Hessians by (node, feature, bin) inside each task, over all nodes that are
  open; the sums meet by (node, feature) and leave as the best split of each, a row per node and feature. Sums are
  whole numbers (fixed point), so the same rows give the same tree however they are dealt.
* **Missing values.** Every split is tried with the missing rows on either side; the better side is learned.
* **Leaf-wise growth.** The open leaf with the largest gain is split until the leaf budget is spent. Nodes that this
  choice may reach are scored ahead, a generation at a time, so a tree needs about as many passes as it has levels;
  the choice itself is made over scored leaves only and equals splitting one by one.
* **Small nodes.** Without a leaf budget no split waits for another. A node of at most ``FEW`` rows then sends its rows to
  one task, which grows all that is below it by the same sums; a deep tree needs passes for its large nodes only.
* **Sampling.** Each tree draws its share of the columns from the seed, its share of the rows by a hash of the row.
* **Tables that one task holds.** With ``held`` a binned table of at most that many bytes goes to one task, which grows all
  trees of the model without a job between them (``learning/held.py``): the same trees.

Margins stay in the table; its lineage is cut by reliable checkpoints.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from refrain.learning.held import HeldRows
from refrain.learning.prepare import FEATURES, KEY, LABEL, RAW, WEIGHT
from refrain.sources.storage import shared_dir, stage_table

CHECKPOINT_EVERY = 10
#: Fixed point of gradient and Hessian sums.
UNIT = float(1 << 24)
#: Nodes scored in one pass.
AT_ONCE = 128
#: Gains up to this are none.
NO_GAIN = 1e-9
#: Rows of a node that one task may take to finish it.
FEW = 20_000


@dataclass
class Tree:
    """Nodes in the order they were made. A node with ``left`` >= 0 splits: bins up to ``bin`` go left, and so do
    missing values if ``missing_left``; a leaf gives ``value``. A finished tree may hold arrays instead of lists."""

    feature: list[int] = field(default_factory=lambda: [0])
    bin: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, gain: float) -> tuple[int, int]:
        below = len(self.left), len(self.left) + 1
        self.feature[node], self.bin[node], self.missing_left[node], self.gain[node] = feature, cut, missing_left, gain
        self.left[node], self.right[node] = below
        for column, empty in zip(self.columns(), (0, 0, False, -1, -1, 0.0, 0.0)):
            column += [empty, empty]
        return below

    def columns(self) -> tuple[list, ...]:
        return self.feature, self.bin, self.missing_left, self.left, self.right, self.value, self.gain

    def leaves(self) -> list[int]:
        return [i for i, below in enumerate(self.left) if below < 0]

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of a (rows, features) table of bins."""
        return _placed(self.arrays(), bins)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.asarray(c) for c in self.columns())


def _placed(arrays: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    feature, cut, missing, left, right = arrays[:5]
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while True:
        rows = rows[left[at[rows]] >= 0]
        if not len(rows):
            return at
        inner = at[rows]
        got = bins[rows, feature[inner]]
        goes_left = np.where(got == 0, missing[inner], got <= cut[inner])
        at[rows] = np.where(goes_left, left[inner], right[inner])


def gains(g: np.ndarray, h: np.ndarray, n: np.ndarray, l2: float, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(largest gain, its bin, whether missing rows go left) for histograms with bin 0 for missing rows, by row.

    A side without curvature (its rows are all but certain, and nothing is penalised) has no leaf value: no split."""
    total_g, total_h, total_n = (x.sum(1, keepdims=True) for x in (g, h, n))
    whole = _whole(total_g, total_h, l2)

    def tried(rows: np.ndarray | slice, missing: bool) -> tuple[np.ndarray, np.ndarray]:
        left = [np.cumsum(x[rows, 1:], 1) for x in (g, h, n)]
        if missing:
            left = [part + x[rows, :1] for part, x in zip(left, (g, h, n))]
        right = [t[rows] - part for t, part in zip((total_g, total_h, total_n), left)]
        gain = (_score(*left[:2], l2) + _score(*right[:2], l2) - whole[rows]) / 2
        gain[(left[2] < least) | (right[2] < least)] = -np.inf
        at = gain.argmax(1)
        return gain[np.arange(len(at)), at], at

    gain, at = tried(slice(None), False)
    # Without missing rows both sides are equal; they go right then.
    goes_left, some = np.zeros(len(g), bool), np.flatnonzero((g[:, 0] != 0) | (h[:, 0] != 0) | (n[:, 0] != 0))
    if len(some):
        other, other_at = tried(some, True)
        better = other > gain[some]
        goes_left[some[better]] = True
        gain[some[better]], at[some[better]] = other[better], other_at[better]
    return gain, at + 1, goes_left


def _score(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    h = h + l2
    return g**2 / h if h.min(initial=np.inf) > 0 else np.divide(g**2, h, out=np.full(g.shape, -np.inf), where=h > 0)


def _whole(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return np.where(h + l2 > 0, _score(g, h, l2), 0.0)


def gains_of_rows(bins: np.ndarray, g: np.ndarray, h: np.ndarray, l2: float, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``gains`` gives, by column of a (rows, columns) table of bins with each row's sums: for few rows.

    The rows are put in order by each column, and a cut lies behind the last row of each bin."""
    order = bins.argsort(0, kind="stable")
    sorted_, count = np.take_along_axis(bins, order, 0), np.arange(1, len(bins) + 1)[:, None]
    up_to = [g[order].cumsum(0), h[order].cumsum(0), count]
    total, missing = [x[-1:] for x in up_to], bins == 0
    behind = np.ones(bins.shape, bool)
    behind[:-1] = sorted_[:-1] != sorted_[1:]
    behind &= sorted_ > 0
    whole = _whole(*total[:2], l2)

    def tried(left: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        right = [t - part for t, part in zip(total, left)]
        gain = (_score(*left[:2], l2) + _score(*right[:2], l2) - whole) / 2
        gain[~behind | (left[2] < least) | (right[2] < least)] = -np.inf
        at = gain.argmax(0)
        return gain[at, np.arange(len(at))], at

    gone = [(g[:, None] * missing).sum(0), (h[:, None] * missing).sum(0), missing.sum(0)]
    gain, at = tried([x - m for x, m in zip(up_to, gone)])
    goes_left = np.zeros(len(gain), bool)
    if missing.any():
        other, other_at = tried([*up_to[:2], np.broadcast_to(count, bins.shape)])
        goes_left = (other > gain) & missing.any(0)
        gain, at = np.where(goes_left, other, gain), np.where(goes_left, other_at, at)
    return gain, sorted_[at, np.arange(len(at))].astype(np.int64), goes_left


class BoostedTrees:
    """``leaves`` and ``depth`` bound each tree; None is no bound. ``bins`` counts bins of values, at most 255.

    A binned table of at most ``held`` bytes is grown in one task; none is by default.
    """

    def __init__(
        self,
        rounds: int = 100,
        learning_rate: float = 0.1,
        leaves: int | None = None,
        depth: int | None = None,
        l2: float = 0.0,
        column_share: float = 1.0,
        row_share: float = 1.0,
        bins: int = 64,
        least_rows: int = 1,
        seed: int = 42,
        held: int = 0,
    ):
        self.held = held
        self.rounds, self.learning_rate, self.leaves, self.depth, self.l2 = rounds, learning_rate, leaves, depth, l2
        self.column_share, self.row_share, self.bins, self.least_rows, self.seed = column_share, row_share, bins, least_rows, seed

    def fit(self, rows: DataFrame) -> BoostedTreesModel:
        shared_dir(rows.sparkSession)
        source = RAW if RAW in rows.columns else FEATURES
        values = vector_to_array(source)
        width = rows.select(F.size(values)).first()[0]
        cuts = _cuts(rows, values, width, self.bins)
        mark = F.xxhash64(*([KEY] if KEY in rows.columns else [values, F.col(LABEL)]))
        weight = F.col(WEIGHT) if WEIGHT in rows.columns else F.lit(1.0)
        plain = rows.select(values.alias("values"), F.col(LABEL).cast("double").alias("label"), weight.cast("double").alias("weight"), mark.alias("mark"))
        state = stage_table(plain.mapInArrow(_binned(cuts), "bins binary, label double, weight double, mark long, margin double"), "binned")
        if self.held and state.count() * width <= self.held:
            return BoostedTreesModel(self._held(state, width), cuts, width)
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        held, trees = [state], []
        try:
            for number in range(self.rounds):
                tree = self._grown(state, number, width)
                if len(tree.left) == 1:
                    break
                trees.append(tree)
                state = state.mapInArrow(_moved(tree, width), state.schema)
                if (number + 1) % CHECKPOINT_EVERY == 0:
                    state = state.checkpoint()
                    while held:
                        held.pop().unpersist()
                state = state.persist(StorageLevel.MEMORY_AND_DISK)
                held.append(state)
        finally:
            for table in held:
                table.unpersist()
        return BoostedTreesModel(trees, cuts, width)

    def _held(self, state: DataFrame, width: int) -> list[Tree]:
        """All trees from one task that holds the table."""
        columns = "feature array<int>, bin array<int>, missing_left array<boolean>, left array<int>, right array<int>, value array<double>, gain array<double>"
        found = state.coalesce(1).mapInArrow(_boosted(self, width), f"tree int, {columns}").toArrow().sort_by("tree")
        return [Tree(*(found.column(i)[t].values.to_numpy(zero_copy_only=False) for i in range(1, found.num_columns))) for t in range(found.num_rows)]

    def _columns(self, number: int, width: int) -> np.ndarray:
        rng = np.random.default_rng([self.seed, number])
        return np.sort(rng.permutation(width)[: max(1, round(self.column_share * width))])

    def _grown(self, state: DataFrame | HeldRows, number: int, width: int) -> Tree:
        """One tree: score ahead what the best-first choice may reach, until the choice meets scored leaves only."""
        columns = self._columns(number, width)
        ahead, level, split, sums, best, small = Tree(), {0: 0}, {}, {}, {}, []
        while True:
            chosen = self._chosen(best, split)
            wanted = [n for n in ahead.leaves() if n not in best] if not best else []
            for node in chosen:
                if node not in split:
                    split[node] = ahead.split(node, *best[node][1:], best[node][0])
                    level.update({below: level[node] + 1 for below in split[node]})
                wanted += [below for below in split[node] if below not in best]
            if not wanted:
                tree, places = self._pruned(ahead, set(chosen), split, sums)
                return _grafted(tree, self._finished(state, ahead, small, level, columns, number, width, places)) if small else tree
            for start in range(0, len(wanted), AT_ONCE):
                part = wanted[start : start + AT_ONCE]
                for node, found in self._scored(state, ahead, part, columns, number, width).items():
                    sums[node] = found[:2]
                    last = self.depth is not None and level[node] >= self.depth
                    if not last and self.leaves is None and found[2] > NO_GAIN and found[6] <= FEW:
                        small.append(node)
                        last = True
                    best[node] = (-np.inf, 0, 0, False) if last else found[2:6]

    def _chosen(self, best: dict, split: dict) -> list[int]:
        """The nodes that best-first growth splits, as far as nodes are scored; equal gains go to the older node."""
        open_ = [(-best[0][0], 0)] if 0 in best else []
        out: list[int] = []
        while open_ and (self.leaves is None or len(out) + 1 < self.leaves):
            gain, node = heapq.heappop(open_)
            if -gain <= NO_GAIN:
                break
            out.append(node)
            for below in split.get(node, ()):
                if below in best:
                    heapq.heappush(open_, (-best[below][0], below))
        return out

    def _pruned(self, ahead: Tree, chosen: set[int], split: dict, sums: dict) -> tuple[Tree, dict[int, int]]:
        """The tree of the chosen nodes alone, with leaf values, and the place of each node in it."""
        out, todo, places = Tree(), deque([(0, 0)]), {}
        while todo:
            node, at = todo.popleft()
            places[node] = at
            if node in chosen:
                below = out.split(at, ahead.feature[node], ahead.bin[node], ahead.missing_left[node], ahead.gain[node])
                todo += list(zip(split[node], below))
            else:
                g, h = sums[node]
                out.value[at] = self._value(g, h)
        return out, places

    def _value(self, g: float, h: float) -> float:
        return -self.learning_rate * g / (h + self.l2) if h + self.l2 > 0 else 0.0

    def _finished(self, state: DataFrame, tree: Tree, nodes: list[int], level: dict, columns: np.ndarray, number: int, width: int, places: dict) -> dict:
        """What grows below small nodes, by their place in the pruned tree; each node's rows meet in one task."""
        rows = state.mapInArrow(_rows_of(tree, nodes, width, self.row_share, self.seed, number), "node long, bins binary, g long, h long")
        depths = [None if self.depth is None else self.depth - level[n] for n in nodes]
        kinds = "node long, feature array<int>, bin array<int>, missing_left array<boolean>, left array<int>, right array<int>, value array<double>, gain array<double>"
        found = rows.groupBy("node").applyInArrow(_subtrees(self, depths, columns, width), kinds).toArrow()
        parts = [found.column(i).combine_chunks() for i in range(1, found.num_columns)]
        out = {}
        for i, node in enumerate(found.column(0).to_pylist()):
            out[places[nodes[node]]] = tuple(p[i].values.to_numpy(zero_copy_only=False) for p in parts)
        return out

    def _subtree(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray, columns: np.ndarray, depth: int | None) -> Tree:
        """The tree below a node whose rows are all here, split by split, from the same whole numbers as in a pass."""
        out, side, bins, todo = Tree(), self.bins + 1, bins[:, columns], [(0, np.arange(len(g)), 0)]
        while todo:
            node, rows, level = todo.pop()
            mine, weights = bins[rows], (g[rows].astype(float), h[rows].astype(float))
            varied = np.flatnonzero((mine != mine[0]).any(0))
            if len(varied) and (depth is None or level < depth):
                key = (mine[:, varied] + np.arange(len(varied)) * side).ravel()
                sums = [np.bincount(key, np.repeat(w, len(varied)), len(varied) * side).reshape(-1, side) / UNIT for w in weights]
                counts = np.bincount(key, minlength=len(varied) * side).reshape(-1, side).astype(float)
                gain, cut, missing = gains(*sums, counts, self.l2, self.least_rows)
                top = int(gain.argmax())
                if gain[top] > NO_GAIN:
                    got = mine[:, varied[top]]
                    goes_left = np.where(got == 0, missing[top], got <= cut[top])
                    below = out.split(node, int(columns[varied[top]]), int(cut[top]), bool(missing[top]), float(gain[top]))
                    todo += [(below[0], rows[goes_left], level + 1), (below[1], rows[~goes_left], level + 1)]
                    continue
            out.value[node] = self._value(*(float(w.sum()) / UNIT for w in weights))
        return out

    def _grown_held(self, held: HeldRows, number: int, width: int) -> Tree:
        """The tree that ``_grown`` gives, from rows in memory; without a leaf budget split by split, down one side first."""
        columns = self._columns(number, width)
        every = held.begin(columns, _drawn(held.mark, self.row_share, self.seed, number), self.bins + 1, UNIT)
        if self.leaves is not None:
            return self._grown(held, number, width)
        out, todo = Tree(), [(0, every, None, 0)]
        while todo:
            node, rows, sums, level = todo.pop()
            if self.depth is None or level < self.depth:
                sums = held.sums(rows) if sums is None and held.many(rows) else sums
                gain, feature, cut, missing = self._best_split(held, rows, sums)
                if gain > NO_GAIN:
                    parts = held.parted(rows, feature, cut, missing)
                    below = out.split(node, feature, cut, missing, gain)
                    last = self.depth is not None and level + 1 >= self.depth
                    todo += [(n, *p, level + 1) for n, p in zip(below, zip(parts, (None, None) if last else held.parted_sums(sums, *parts)))]
                    continue
            out.value[node] = self._value(*held.total(rows))
        return _by_level([np.asarray(c) for c in out.columns()])

    def _best_split(self, held: HeldRows, rows: np.ndarray, sums: np.ndarray | None) -> tuple[float, int, int, bool]:
        """(gain, feature, bin, missing left) of a node. Columns with one bin only cannot split."""
        none = -np.inf, 0, 0, False
        if len(rows) < 2 * max(1, self.least_rows):
            return none
        bins = None if sums is not None else held.some[rows]
        varied = np.flatnonzero((sums[2] > 0).sum(1) > 1 if bins is None else (bins != bins[0]).any(0))
        if not len(varied):
            return none
        if bins is None:
            g, h, n = sums[:, varied]
            gain, cut, missing = gains(g / UNIT, h / UNIT, n, self.l2, self.least_rows)
        else:
            gain, cut, missing = gains_of_rows(bins[:, varied], held.g[rows] / UNIT, held.h[rows] / UNIT, self.l2, self.least_rows)
        top = int(gain.argmax())
        return float(gain[top]), int(held.columns[varied[top]]), int(cut[top]), bool(missing[top])

    def _scored_held(self, held: HeldRows, tree: Tree, nodes: list[int]) -> dict:
        above = {below: n for n, left in enumerate(tree.left) if left >= 0 for below in (left, tree.right[n])}
        out = {}
        for node in nodes:
            rows, sums = held.node(node, above.get(node), tree)
            out[node] = (*held.total(rows), *self._best_split(held, rows, sums), len(rows))
        return out

    def _scored(self, state: DataFrame | HeldRows, tree: Tree, nodes: list[int], columns: np.ndarray, number: int, width: int) -> dict:
        """(G, H, gain, feature, bin, missing left, rows) of nodes, from one pass over the table."""
        if isinstance(state, HeldRows):
            return self._scored_held(state, tree, nodes)
        sized = state.mapInArrow(
            _histograms(tree, nodes, columns, self.bins + 1, width, self.row_share, self.seed, number),
            "key long, g array<long>, h array<long>, n array<long>",
        )
        found = sized.repartition("key").mapInArrow(
            _best(self.l2, self.least_rows), "key long, total_g double, total_h double, total_n long, gain double, bin int, missing_left boolean"
        )
        rows = found.toPandas().sort_values("key")
        out = {n: (0.0, 0.0, -np.inf, 0, 0, False, 0) for n in nodes}
        for r in rows.itertuples():
            node, feature = nodes[r.key // len(columns)], int(columns[r.key % len(columns)])
            if r.gain > out[node][2] or out[node][2] == -np.inf:
                out[node] = (r.total_g, r.total_h, r.gain, feature, int(r.bin), bool(r.missing_left), r.total_n)
        return out


def _cuts(rows: DataFrame, values, width: int, bins: int) -> list[np.ndarray]:
    """Upper bounds of the bins of each feature: distinct quantiles of its values that are there."""
    share = [i / bins for i in range(1, bins)]
    there = [F.when(~F.isnan(values[i]), values[i]) for i in range(width)]
    got = rows.agg(*[F.percentile_approx(v, share, 10_000).alias(f"c{i}") for i, v in enumerate(there)]).first()
    return [np.unique(np.array(c, float)) if c else np.zeros(0) for c in got]


def to_bins(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bins of a (rows, features) table: 0 for missing, else 1 + number of cuts below the value."""
    out = np.empty(values.shape, np.uint8)
    for i, c in enumerate(cuts):
        out[:, i] = np.where(np.isnan(values[:, i]), 0, 1 + np.searchsorted(c, values[:, i], "left"))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _bins(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)


def _binned(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = to_bins(_matrix(batch.column("values"), len(cuts)), cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in bins], pa.binary())]
                + [batch.column(c) for c in ("label", "weight", "mark")]
                + [pa.array(np.zeros(len(bins)))],
                ["bins", "label", "weight", "mark", "margin"],
            )

    return run


def _moved(tree: Tree, width: int):
    """Adds a tree's leaf values to the margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = tree.arrays()
        for batch in batches:
            margin = batch.column("margin").to_numpy() + arrays[5][_placed(arrays, _bins(batch, width))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margin)], batch.schema.names)

    return run


def _drawn(mark: np.ndarray, share: float, seed: int, number: int) -> np.ndarray:
    """Whether a row is in a tree's sample: a hash of its mark, the seed and the tree."""
    x = mark.view(np.uint64) ^ np.uint64((seed * 1_000_003 + number + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) / 2.0**64 < share


def _sampled(batches: Iterator[pa.RecordBatch], tree: Tree, nodes: list[int], width: int, share: float, seed: int, number: int) -> Iterator[tuple]:
    """(place among the nodes, bins, gradient, Hessian) of the drawn rows of some nodes, in fixed point."""
    order, arrays = np.full(len(tree.left), -1), tree.arrays()
    order[nodes] = np.arange(len(nodes))
    for batch in batches:
        bins = _bins(batch, width)
        node = order[_placed(arrays, bins)]
        mine = np.flatnonzero((node >= 0) & _drawn(batch.column("mark").to_numpy(), share, seed, number))
        margin, label, weight = (batch.column(c).to_numpy()[mine] for c in ("margin", "label", "weight"))
        p = 1 / (1 + np.exp(-margin))
        yield node[mine], bins[mine], np.round(weight * (p - label) * UNIT), np.round(weight * p * (1 - p) * UNIT)


def _histograms(tree: Tree, nodes: list[int], columns: np.ndarray, side: int, width: int, share: float, seed: int, number: int):
    """Sums of gradients, Hessians and rows by (node, column, bin) of a whole task; a row per node and column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(nodes), len(columns), side), np.int64)
        for node, bins, g, h in _sampled(batches, tree, nodes, width, share, seed, number):
            # A column at a time: its sums stay in the processor's cache, and weights are not repeated per column.
            for i, mine in enumerate(np.ascontiguousarray(bins[:, columns].T)):
                key = node * side + mine
                for total, part in zip(sums, (g, h, None)):
                    total[:, i] += np.bincount(key, part, len(nodes) * side).reshape(-1, side).astype(np.int64)
        tables = sums.reshape(3, -1, side)
        key = np.flatnonzero(tables[2].any(1))
        offsets = pa.array(np.arange(len(key) + 1) * side, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(t[key].ravel())) for t in tables]
        yield pa.RecordBatch.from_arrays([pa.array(key), *lists], ["key", "g", "h", "n"])

    return run


def _rows_of(tree: Tree, nodes: list[int], width: int, share: float, seed: int, number: int):
    """The drawn rows of some nodes, with the node's place among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, bins, g, h in _sampled(batches, tree, nodes, width, share, seed, number):
            table = pa.array([r.tobytes() for r in bins], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(node.astype(np.int64)), table, pa.array(g.astype(np.int64)), pa.array(h.astype(np.int64))],
                ["node", "bins", "g", "h"],
            )

    return run


def _boosted(trees: BoostedTrees, width: int):
    """All trees from the rows of one task: a row of arrays each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = HeldRows.read(batches, width)
        kinds = (pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        names = ["tree", "feature", "bin", "missing_left", "left", "right", "value", "gain"]
        for number in range(trees.rounds):
            tree = trees._grown_held(held, number, width)
            if len(tree.left) == 1:
                break
            held.margin += tree.arrays()[5][_placed(tree.arrays(), held.bins)]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *(pa.array([c], pa.list_(k)) for c, k in zip(tree.columns(), kinds))], names)

    return run


def _subtrees(trees: BoostedTrees, depths: list[int | None], columns: np.ndarray, width: int):
    """The tree below one node from its rows: a row of arrays."""

    def run(rows: pa.Table) -> pa.Table:
        node = rows.column("node")[0].as_py()
        bins = np.frombuffer(b"".join(rows.column("bins").to_pylist()), np.uint8).reshape(-1, width)
        tree = trees._subtree(bins, rows.column("g").to_numpy(), rows.column("h").to_numpy(), columns, depths[node])
        kinds = (pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        lists = [pa.array([c], pa.list_(kind)) for c, kind in zip(tree.columns(), kinds)]
        return pa.Table.from_arrays(
            [pa.array([node], pa.int64()), *lists], ["node", "feature", "bin", "missing_left", "left", "right", "value", "gain"]
        )

    return run


def _grafted(tree: Tree, below: dict[int, tuple[np.ndarray, ...]]) -> Tree:
    """A tree with its leaves at some places replaced by trees."""
    columns, size = [[c] for c in map(np.array, tree.columns())], len(tree.left)
    for at, part in below.items():
        shift = size - 1
        part = [np.where(c >= 0, c + shift, -1) if i in (3, 4) else c for i, c in enumerate(part)]
        for whole, c in zip(columns, part):
            whole[0][at] = c[0]
            whole.append(c[1:])
        size += len(part[0]) - 1
    return _by_level([np.concatenate(c) for c in columns])


def _by_level(columns: list[np.ndarray]) -> Tree:
    """A tree with its nodes numbered from the root down, level by level."""
    size = len(columns[3])
    left, right, level, order = columns[3], columns[4], np.zeros(1, np.int64), []
    while len(level):
        order.append(level)
        inner = level[left[level] >= 0]
        level = np.stack([left[inner], right[inner]], 1).ravel()
    order = np.concatenate(order)
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    columns = [c[order] for c in columns]
    for i in (3, 4):
        columns[i] = np.where(columns[i] >= 0, place[columns[i]], -1)
    return Tree(*(c.tolist() for c in columns))


def _best(l2: float, least: int):
    """Histograms of one key from all tasks added up; the best split of each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "total_g", "total_h", "total_n", "gain", "bin", "missing_left"]
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                side = len(batch.column("g")[0])
                tables = np.stack([_matrix(batch.column(c), side) for c in ("g", "h", "n")], 1)
                for key, table in zip(batch.column("key").to_pylist(), tables):
                    sums[key] = sums[key] + table if key in sums else table
        if not sums:
            return
        g, h, n = np.stack(list(sums.values())).transpose(1, 0, 2).astype(float)
        g, h = g / UNIT, h / UNIT
        gain, cut, missing = gains(g, h, n, l2, least)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array(g.sum(1)), pa.array(h.sum(1)), pa.array(n.sum(1).astype(np.int64)), pa.array(gain)]
            + [pa.array(cut.astype(np.int32)), pa.array(missing)],
            names,
        )

    return run


class BoostedTreesModel:
    def __init__(self, trees: list[Tree], cuts: list[np.ndarray], features: int):
        self.trees, self.cuts, self.features = trees, cuts, features
        #: The trees as arrays, made where rows are scored.
        self._arrays: list[tuple[np.ndarray, ...]] | None = None

    def margin(self, values: np.ndarray) -> np.ndarray:
        bins = to_bins(values, self.cuts)
        if self._arrays is None:
            self._arrays = [t.arrays() for t in self.trees]
        return sum((a[5][_placed(a, bins)] for a in self._arrays), np.zeros(len(bins)))

    def transform(self, rows: DataFrame) -> DataFrame:
        """Adds ``probability`` and ``prediction``; the raw vector is read where there is one."""
        shared = rows.sparkSession.sparkContext.broadcast(self)
        width = self.features

        @F.pandas_udf("double")
        def churn(values):
            import pandas

            table = np.array(values.tolist(), float).reshape(-1, width)
            return pandas.Series(1 / (1 + np.exp(-shared.value.margin(table))))

        scored = rows.withColumn("_churn", churn(vector_to_array(RAW if RAW in rows.columns else FEATURES)))
        return scored.select(
            *rows.columns,
            array_to_vector(F.array(1 - F.col("_churn"), F.col("_churn"))).alias("probability"),
            (F.col("_churn") > 0.5).cast("double").alias("prediction"),
        )

    @property
    def featureImportances(self) -> DenseVector:
        """Share of the total gain of the splits on each feature."""
        out = np.zeros(self.features)
        for tree in self.trees:
            np.add.at(out, tree.feature, np.where(np.array(tree.left) >= 0, tree.gain, 0.0))
        return DenseVector(out / out.sum() if out.sum() else out)

    def nodes(self) -> DataFrame:
        """A row per node of all trees."""
        kinds = [("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("missing_left", pa.bool_())]
        kinds += [("left", pa.int32()), ("right", pa.int32()), ("value", pa.float64()), ("gain", pa.float64())]
        schema = pa.schema(kinds)
        parts = [
            pa.table([pa.array(c, kind) for c, (_, kind) in zip(([t] * len(tree.left), range(len(tree.left)), *tree.columns()), kinds)], schema=schema)
            for t, tree in enumerate(self.trees)
        ]
        return SparkSession.active().createDataFrame(pa.concat_tables([schema.empty_table(), *parts]))

    def save(self, path: str) -> None:
        self.nodes().coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        cuts = [(i, c.tolist()) for i, c in enumerate(self.cuts)]
        table = SparkSession.active().createDataFrame(cuts, "feature int, cuts array<double>")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")

    @classmethod
    def load(cls, path: str) -> BoostedTreesModel:
        read = SparkSession.active().read
        cuts = [np.array(r.cuts, float) for r in read.parquet(f"{path}/cuts").orderBy("feature").collect()]
        table = read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        trees = [
            Tree(*(part[c].to_numpy() for c in ("feature", "bin", "missing_left", "left", "right", "value", "gain")))
            for _, part in table.groupby("tree")
        ]
        return cls(trees, cuts, len(cuts))
