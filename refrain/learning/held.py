"""Boosting of a binned table that one task holds.

A pass over a table is a Spark job, and a boosted model takes thousands of them. A table of at most ``HELD`` bytes of bins
goes to one task instead, which grows all trees of the model from it: the same whole numbers, the same splits, no job
between them. Larger tables are grown pass by pass (``trees.BoostedTrees``).

Sums of a node's smaller child are added up from its rows; the larger child's are the node's less those. A node of fewer
rows than a column has bins is split from its rows in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa

if TYPE_CHECKING:
    from refrain.learning.trees import Tree

#: Bytes of bins (rows by features) that one task holds; with what goes along, some three times as much memory.
HELD = 1 << 27
#: Cells (rows by features) added up at once.
CELLS = 1 << 17


class HeldRows:
    """Rows in memory, and their margins so far."""

    def __init__(self, bins: np.ndarray, label: np.ndarray, weight: np.ndarray, mark: np.ndarray):
        self.bins, self.label, self.weight, self.mark, self.margin = bins, label, weight, mark, np.zeros(len(label))

    @classmethod
    def read(cls, batches: Iterator[pa.RecordBatch], width: int) -> HeldRows:
        parts: dict[str, list] = {"bins": [], "label": [], "weight": [], "mark": []}
        for batch in batches:
            parts["bins"].append(np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width))
            for c in ("label", "weight", "mark"):
                parts[c].append(batch.column(c).to_numpy())
        return cls(*(np.concatenate(p) for p in parts.values()))

    def begin(self, columns: np.ndarray, drawn: np.ndarray, side: int, unit: float) -> np.ndarray:
        """A new tree over some columns and rows; gives the places of its rows."""
        p = 1 / (1 + np.exp(-self.margin))
        self.columns, self.side, self.unit = columns, side, unit
        self.g, self.h = np.round(self.weight * (p - self.label) * unit), np.round(self.weight * p * (1 - p) * unit)
        self.some = self.bins if len(columns) == self.bins.shape[1] else np.ascontiguousarray(self.bins[:, columns])
        every = np.flatnonzero(drawn)
        #: Rows and sums of the nodes that may still be split, by node.
        self.open: dict[int, tuple[np.ndarray, np.ndarray | None]] = {0: (every, None)}
        return every

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """Sums of gradients, Hessians and rows by (column, bin), in fixed point: whole numbers, so in any order the same."""
        width, side = len(self.columns), self.side
        out, shift = np.zeros((3, width * side)), np.arange(width) * side
        step = max(1, CELLS // width)
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            key = (self.some[part] + shift).ravel()
            for total, weight in zip(out, (self.g, self.h)):
                total += np.bincount(key, np.repeat(weight[part], width), width * side)
            out[2] += np.bincount(key, minlength=width * side)
        return out.reshape(3, width, side)

    def parted(self, rows: np.ndarray, feature: int, cut: int, missing_left: bool) -> tuple[np.ndarray, np.ndarray]:
        got = self.bins[rows, feature]
        goes_left = (got <= cut) & (missing_left | (got > 0))
        return rows[goes_left], rows[~goes_left]

    def total(self, rows: np.ndarray) -> tuple[float, float]:
        return float(self.g[rows].sum()) / self.unit, float(self.h[rows].sum()) / self.unit

    def many(self, rows: np.ndarray) -> bool:
        """Whether rows are more than the bins of a column: sums are worth adding up only then."""
        return len(rows) > self.side

    def parted_sums(self, sums: np.ndarray | None, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray | None, np.ndarray | None]:
        """The sums of both children of a node with known sums; None for a child of few rows."""
        less, more = (left, right) if len(left) <= len(right) else (right, left)
        if sums is None or not self.many(more):
            return None, None
        small = self.sums(less)
        large, small = sums - small, small if self.many(less) else None
        return (small, large) if less is left else (large, small)

    def node(self, node: int, above: int | None, tree: Tree) -> tuple[np.ndarray, np.ndarray | None]:
        """Rows and sums of a node whose parent is open or was; a parent's own are let go."""
        if node not in self.open:
            rows, sums = self.open.pop(above)
            parts = self.parted(rows, tree.feature[above], tree.bin[above], tree.missing_left[above])
            self.open |= dict(zip((tree.left[above], tree.right[above]), zip(parts, self.parted_sums(sums, *parts))))
        rows, sums = self.open[node]
        if sums is None and self.many(rows):
            self.open[node] = rows, sums = rows, self.sums(rows)
        return rows, sums
