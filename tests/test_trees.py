"""Boosted trees: splits, leaf values, missing values, leaf-wise growth, sampling and saving, against plain numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from refrain.learning import trees
from refrain.learning.trees import BoostedTrees, BoostedTreesModel, gains, to_bins


def table(spark, x, y, weight=None):
    rows = [(f"m{i}", v.tolist(), float(t), float(w)) for i, (v, t, w) in enumerate(zip(x, y, np.ones(len(y)) if weight is None else weight))]
    made = spark.createDataFrame(rows, "msno string, v array<double>, is_churn double, weight double")
    return made.select("msno", "is_churn", "weight", array_to_vector("v").alias("raw"))


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 6))
    x[rng.random(x.shape) < 0.15] = np.nan
    z = np.where(np.isnan(x[:, 0]), 2.0, x[:, 0]) * np.where(np.nan_to_num(x[:, 1]) > 0, 1.5, -0.5) + np.nan_to_num(x[:, 2]) ** 2 - 1
    return x, (rng.random(500) < 1 / (1 + np.exp(-2 * z))).astype(float)


def one_by_one(bins, g, h, leaves, l2):
    """Leaf-wise growth that scores every split of every open leaf by adding up its rows, and splits one leaf at a time."""

    def best(rows):
        top = (-np.inf, 0, 0, False)
        for f in range(bins.shape[1]):
            for missing in (False, True):
                for cut in range(1, int(bins.max()) + 1):
                    b = bins[rows, f]
                    left = np.where(b == 0, missing, b <= cut)
                    if 0 < left.sum() < len(rows):
                        a, c = rows[left], rows[~left]
                        parts = [g[r].sum() ** 2 / (h[r].sum() + l2) for r in (a, c, rows)]
                        gain = (parts[0] + parts[1] - parts[2]) / 2
                        if gain > top[0] + 1e-9:
                            top = (gain, f, cut, missing)
        return top

    everything = np.arange(len(bins))
    open_, out = [(best(everything), everything)], []
    while len(open_) < leaves:
        at = max(range(len(open_)), key=lambda i: open_[i][0][0])
        (gain, f, cut, missing), rows = open_[at]
        if gain <= 1e-9:
            break
        out.append(gain)
        b = bins[rows, f]
        left = np.where(b == 0, missing, b <= cut)
        open_[at : at + 1] = [(best(r), r) for r in (rows[left], rows[~left])]
    return out, [(rows, -g[rows].sum() / (h[rows].sum() + l2)) for _, rows in open_]


def test_a_leafy_tree_equals_one_grown_split_by_split(spark, planted):
    x, y = planted
    model = BoostedTrees(rounds=1, learning_rate=1.0, leaves=12, l2=3.0, bins=8).fit(table(spark, x, y))
    bins = to_bins(x, model.cuts)
    g, h = np.where(y == 1, -0.5, 0.5), np.full(len(y), 0.25)
    want, leaves = one_by_one(bins, g, h, 12, 3.0)
    tree = model.trees[0]
    assert len(tree.leaves()) == len(leaves) == 12
    got = sorted(x for x, left in zip(tree.gain, tree.left) if left >= 0)
    assert np.allclose(got, sorted(want), atol=1e-5)
    value = np.array(tree.value)[tree.place(bins)]
    for rows, wanted in leaves:
        assert np.allclose(value[rows], wanted, atol=1e-6)


def test_leaf_values_are_penalised_newton_steps(spark, planted):
    x, y = planted
    weight = np.where(y == 1, 2.0, 0.5)
    rows = table(spark, x, y, weight)
    model = BoostedTrees(rounds=2, learning_rate=0.3, depth=3, l2=3.0).fit(rows)
    bins, margin = to_bins(x, model.cuts), np.zeros(len(y))
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        g, h, at = weight * (p - y), weight * p * (1 - p), tree.place(bins)
        assert len(tree.leaves()) <= 8
        for leaf in np.unique(at):
            assert abs(tree.value[leaf] + 0.3 * g[at == leaf].sum() / (h[at == leaf].sum() + 3.0)) < 1e-6
        margin += np.array(tree.value)[at]
    assert np.allclose(model.margin(x), margin)


def test_missing_values_learn_their_side(spark):
    rng = np.random.default_rng(2)
    for side in (-1.0, 1.0):
        x = rng.normal(size=(400, 2))
        x[:100, 0] = np.nan
        y = (np.where(np.isnan(x[:, 0]), side, x[:, 0]) > 0).astype(float)
        model = BoostedTrees(rounds=1, leaves=2, learning_rate=1.0).fit(table(spark, x, y))
        tree = model.trees[0]
        assert tree.feature[0] == 0 and tree.missing_left[0] == (side < 0)
        assert ((model.margin(x) > 0) == (y == 1)).mean() > 0.97


def test_gains_try_missing_rows_on_both_sides():
    rng = np.random.default_rng(0)
    g, h, n = rng.normal(size=(5, 9)), rng.random((5, 9)), rng.integers(0, 4, (5, 9))
    gain, cut, missing = gains(g, h, n, 3.0, 1)
    for i in range(5):
        every = {}
        for side in (False, True):
            for c in range(1, 9):
                left = np.array([side] + [b <= c for b in range(1, 9)])
                if n[i][left].sum() and n[i][~left].sum():
                    score = lambda m: g[i][m].sum() ** 2 / (h[i][m].sum() + 3.0)
                    every[side, c] = (score(left) + score(~left) - score(left | ~left)) / 2
        assert abs(gain[i] - max(every.values())) < 1e-9 and abs(every[bool(missing[i]), int(cut[i])] - gain[i]) < 1e-9


def test_127_leaves_are_saved_and_read_back(spark, tmp_path):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3_000, 4))
    y = (np.sin(4 * x[:, 0]) * np.cos(3 * x[:, 1]) + rng.normal(size=3_000) * 0.3 > 0).astype(float)
    rows = table(spark, x, y)
    model = BoostedTrees(rounds=1, leaves=127).fit(rows)
    assert len(model.trees[0].leaves()) == 127
    model.save(f"{tmp_path}/leafy")
    back = BoostedTreesModel.load(f"{tmp_path}/leafy")
    assert np.array_equal(back.margin(x), model.margin(x)) and len(back.trees[0].leaves()) == 127
    scored = back.transform(rows).select("msno", "is_churn", "prediction")
    assert scored.filter("prediction = is_churn").count() > 0.75 * 3_000
    assert abs(sum(model.featureImportances) - 1) < 1e-9 and model.featureImportances[0] > model.featureImportances[3]


def test_the_same_rows_give_the_same_trees_however_dealt(spark, planted):
    x, y = planted
    rows = table(spark, x, y)
    make = lambda: BoostedTrees(rounds=3, leaves=9, column_share=0.7, row_share=0.8, l2=1.0)
    one, other = make().fit(rows.repartition(1)), make().fit(rows.repartition(7))
    assert [t.columns()[:5] for t in one.trees] == [t.columns()[:5] for t in other.trees]
    for tree in one.trees:
        assert len({f for f, left in zip(tree.feature, tree.left) if left >= 0}) <= 4
    plain = BoostedTrees(rounds=3, leaves=9, l2=1.0).fit(rows)
    assert [t.columns()[:2] for t in plain.trees] != [t.columns()[:2] for t in one.trees]


def test_rounds_lower_the_loss_past_a_checkpoint(spark, planted):
    x, y = planted
    model = BoostedTrees(rounds=12, leaves=6, learning_rate=0.3).fit(table(spark, x, y))
    assert len(model.trees) == 12
    loss = lambda m: np.logaddexp(0, np.where(y == 1, -m, m)).mean()
    parts = [BoostedTreesModel(model.trees[:k], model.cuts, 6).margin(x) for k in (0, 1, 6, 12)]
    assert loss(parts[0]) > loss(parts[1]) > loss(parts[2]) > loss(parts[3])


def test_one_class_gives_no_trees(spark, planted):
    x, _ = planted
    flat = np.ones_like(x)
    model = BoostedTrees(rounds=3, leaves=4).fit(table(spark, flat, np.arange(500) % 2.0))
    assert model.trees == [] and (model.margin(flat) == 0).all()


def test_a_side_without_curvature_is_no_split():
    g, h, n = np.array([[0.0, 3.0, -1.0, -2.0]]), np.array([[0.0, 0.0, 0.5, 0.5]]), np.array([[0, 2, 2, 2]])
    gain, at, _ = gains(g, h, n, 0.0, 1)
    assert at[0] == 2 and gain[0] == pytest.approx((2.0**2 / 0.5 + 2.0**2 / 0.5 - 0.0) / 2)
    assert gains(g, np.zeros((1, 4)), n, 0.0, 1)[0][0] == -np.inf


def test_small_nodes_finished_in_one_task_give_the_tree_of_whole_passes(spark, planted, monkeypatch):
    x, y = planted
    rows = table(spark, x, y, np.where(y == 1, 2.0, 0.5))
    for settings in ({"depth": 30, "l2": 1.0, "row_share": 0.9, "column_share": 0.7}, {"depth": 4, "l2": 3.0}, {"least_rows": 20}):
        passes, grown = [], []
        scored = BoostedTrees._scored

        def counted(self, *given, scored=scored, passes=passes):
            passes.append(len(given[2]))
            return scored(self, *given)

        monkeypatch.setattr(BoostedTrees, "_scored", counted)
        for few in (0, 60, 20_000):
            monkeypatch.setattr(trees, "FEW", few)
            passes.clear()
            model = BoostedTrees(rounds=2, bins=8, **settings).fit(rows)
            grown.append([t.columns() for t in model.trees])
        monkeypatch.setattr(BoostedTrees, "_scored", scored)
        assert grown[0] == grown[1] == grown[2]
        assert passes == [1, 1]  # the root of each tree only


def test_an_empty_model_has_a_table_of_no_nodes(spark):
    model = BoostedTreesModel([], [np.zeros(0)], 1)
    assert model.nodes().count() == 0
    assert model.nodes().dtypes[:3] == [("tree", "int"), ("node", "int"), ("feature", "int")]
