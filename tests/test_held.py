"""Boosted trees grown in one task are those grown pass by pass."""

from __future__ import annotations

import uuid

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from refrain.learning import evaluate, held, models, prepare, trees
from refrain.learning.trees import BoostedTrees, gains, gains_of_rows


def table(spark, x, y, weight):
    rows = [(i, v.tolist(), int(t), float(w), i % prepare.FOLDS, "test" if i % 5 == 0 else "train") for i, (v, t, w) in enumerate(zip(x, y, weight))]
    made = spark.createDataFrame(rows, "msno int, v array<double>, is_churn int, weight double, fold int, part string")
    return made.select("msno", "is_churn", "weight", "fold", "part", array_to_vector("v").alias("features"), array_to_vector("v").alias("raw"))


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 7))
    x[:, 4], x[:, 5], x[:, 6] = x[:, 4] > 0, np.round(x[:, 5]), 1.0
    x[rng.random(x.shape) < 0.2] = np.nan
    y = (np.nan_to_num(x[:, 0]) + np.nan_to_num(x[:, 1]) ** 2 + rng.normal(size=700) > 0.7).astype(float)
    rows = table(spark, x, y, np.where(y == 1, 2.0, 0.5)).persist()
    yield rows
    rows.unpersist()


SETTINGS = (
    {"depth": 30, "l2": 1.0, "row_share": 0.9, "column_share": 0.7, "rounds": 3},
    {"depth": 3, "l2": 3.0, "rounds": 3},
    {"leaves": 15, "least_rows": 20, "rounds": 3},
    {"leaves": 40, "rounds": 2},
)


@pytest.mark.parametrize("settings", SETTINGS)
def test_trees_of_one_task_are_those_of_passes(spark, planted, settings):
    passes = BoostedTrees(bins=16, **settings).fit(planted)
    whole = BoostedTrees(bins=16, held=held.HELD, **settings).fit(planted.repartition(5))
    assert len(passes.trees) == len(whole.trees) == settings["rounds"]
    for one, other in zip(passes.trees, whole.trees):
        assert len(one.left) > 3
        assert all(np.array_equal(a, b) for a, b in zip(one.columns(), other.columns()))


def test_a_table_that_fits_is_grown_without_passes(spark, planted, monkeypatch):
    """A model of many rounds is a fixed number of jobs; a table of more bytes than that is grown by passes."""
    jobs = []
    for rounds in (2, 20):
        group = f"held-{uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, "boosting rounds")
        assert len(models.fit("gbt_shallow", planted, rounds=rounds).trees) == rounds
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]
    monkeypatch.setattr(BoostedTrees, "_held", lambda *a: pytest.fail("held"))
    assert len(BoostedTrees(rounds=1, depth=2, held=700 * 7 - 1).fit(planted).trees) == 1


def test_gains_of_few_rows_are_those_of_their_sums():
    rng = np.random.default_rng(1)
    for least, l2, n in ((1, 1.0, 30), (3, 0.0, 9), (1, 0.0, 2), (20, 0.0, 50)):
        for _ in range(20):
            bins = rng.integers(0, 7, (n, 40)).astype(np.uint8)
            bins[:, :10] = np.maximum(bins[:, :10], 1)
            g, h = np.round(rng.normal(size=n) * 2**20) / 2**24, np.round(rng.random(n) * 2**20) / 2**24
            sums = [np.stack([np.bincount(b, w, 9) for b in bins.T]) for w in (g, h, np.ones(n))]
            wanted, got = gains(*sums, l2, least), gains_of_rows(bins, g, h, l2, least)
            assert np.array_equal(wanted[0], got[0])
            found = np.isfinite(got[0])
            assert all(np.array_equal(a[found], b[found]) for a, b in zip(wanted[1:], got[1:]))


def test_chunks_add_up_to_the_same_sums(monkeypatch):
    rng = np.random.default_rng(4)
    rows = held.HeldRows(rng.integers(0, 9, (300, 5)).astype(np.uint8), rng.integers(0, 2, 300) * 1.0, rng.random(300), np.arange(300))
    every = rows.begin(np.array([0, 2, 4]), np.arange(300) % 3 > 0, 9, trees.UNIT)
    whole = rows.sums(every)
    assert whole[2].sum(1).tolist() == [200] * 3
    left, right = rows.parted(every, 2, 4, False)
    assert np.array_equal(sum(rows.parted_sums(whole, left, right)), whole)
    monkeypatch.setattr(held, "CELLS", 50)
    assert np.array_equal(rows.sums(every), whole)


def test_out_of_fold_fits_side_by_side_give_the_scores_of_fits_in_turn(spark, planted):
    changes = {"gbt_deep": {"rounds": 2}, "gbt_leafy": {"rounds": 2}}
    one, many = (
        evaluate.out_of_fold_scores(["gbt_deep", "gbt_leafy"], planted, prepare.FOLDS, changes, at_once=n).drop("raw", "features") for n in (1, 6)
    )
    assert one.count() == 700 and one.exceptAll(many).count() == 0
    assert one.filter((F.col("gbt_deep") < 0.5) != (F.col("gbt_leafy") < 0.5)).count() < 200
