"""The six classifiers under comparison: presets, fitting, grid search, saving and loading."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.learning.boosting import BoostedStumps, BoostedStumpsModel
from refrain.learning.held import HELD
from refrain.learning.prepare import FEATURES, FOLD, FOLDS, LABEL, SEED, WEIGHT
from refrain.learning.trees import BoostedTrees, BoostedTreesModel
from refrain.sources.storage import shared_dir


@dataclass(frozen=True)
class Preset:
    """An estimator class with its settings."""

    estimator: type
    model: type
    settings: dict[str, Any]

    def build(self, **changes: Any):
        settings = {**self.settings, **changes}
        if self.estimator in (BoostedStumps, BoostedTrees):
            return self.estimator(**settings)
        return self.estimator(labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, seed=SEED, **settings)


# The settings under comparison, with the defaults of their libraries where those act: the deep
# profile's leaf penalty of 1, the leafy one's 20 rows a leaf. (The leafy one's row share of 0.8 has no effect
# there, since its library samples rows only at a set frequency.) ``held`` says where trees are grown, not which.
PRESETS: dict[str, Preset] = {
    "adaboost": Preset(BoostedStumps, BoostedStumpsModel, {"rounds": 100, "learning_rate": 0.1}),
    "random_forest": Preset(
        RandomForestClassifier,
        RandomForestClassificationModel,
        # Each row keeps its node in every tree, so a level costs one step of each tree and not the way from the root.
        {
            "numTrees": 200,
            "maxDepth": 15,
            "featureSubsetStrategy": "sqrt",
            "minInstancesPerNode": 3,
            "cacheNodeIds": True,
            "checkpointInterval": 10,
        },
    ),
    "gbt_deep": Preset(
        BoostedTrees,
        BoostedTreesModel,
        {"rounds": 250, "depth": 30, "learning_rate": 0.13, "row_share": 0.9, "column_share": 0.7, "l2": 1.0, "held": HELD},
    ),
    "gbt_leafy": Preset(
        BoostedTrees,
        BoostedTreesModel,
        {"rounds": 300, "leaves": 127, "learning_rate": 0.1, "least_rows": 20, "held": HELD},
    ),
    "decision_tree": Preset(
        DecisionTreeClassifier,
        DecisionTreeClassificationModel,
        {"maxDepth": 15, "minInstancesPerNode": 5},
    ),
    "gbt_shallow": Preset(
        BoostedTrees, BoostedTreesModel, {"rounds": 1000, "depth": 6, "learning_rate": 0.1, "l2": 3.0, "held": HELD}
    ),
}


def fit(name: str, rows: DataFrame, **changes: Any):
    """Fit one preset without a search; ``changes`` replace some of its settings."""
    if name not in PRESETS:
        raise ValueError(f"no model named {name!r}; known: {sorted(PRESETS)}")
    shared_dir(rows.sparkSession)  # lets tree ensembles checkpoint their node ids
    return PRESETS[name].build(**changes).fit(rows)


def side_by_side(spark: SparkSession, jobs: list[Callable[[], Any]], at_once: int) -> list:
    """The results of jobs that run ``at_once`` at a time, in the order of the jobs; they start in that order."""
    run = inheritable_thread_target(spark)(lambda job: job())
    with ThreadPool(at_once) as pool:
        return pool.map(run, jobs, chunksize=1)


def accuracy() -> Evaluator:
    return MulticlassClassificationEvaluator(labelCol=LABEL, predictionCol="prediction", metricName="accuracy")


@dataclass(frozen=True)
class Search:
    """The settings tried, their mean metrics, the best setting and the model refitted with it."""

    settings: list[dict[str, Any]]
    metrics: list[float]
    best: dict[str, Any]
    model: Any


def grid_search(
    name: str,
    rows: DataFrame,
    grid: dict[str, list[Any]],
    evaluator: Evaluator | None = None,
    at_once: int = 3,
) -> Search:
    """Cross-validated search over settings of any preset; the best one is refitted on all rows.

    ``rows`` carry their fold number, so the folds do not depend on partitioning. Fits run ``at_once`` at a time, each
    from a thread with its own scheduler pool, so their jobs share the cluster where it schedules fairly; the
    rows should be a written table. Of equal settings the first wins, whatever ends first.
    """
    evaluator = evaluator or accuracy()
    settings = [dict(zip(grid, values)) for values in product(*grid.values())]
    context = rows.sparkSession.sparkContext

    def measured(job: tuple[int, int]) -> float:
        place, k = job
        context.setLocalProperty("spark.scheduler.pool", f"search-{(place * FOLDS + k) % at_once}")
        model = fit(name, rows.filter(F.col(FOLD) != k), **settings[place])
        return evaluator.evaluate(model.transform(rows.filter(F.col(FOLD) == k)))

    with ThreadPool(at_once) as pool:
        run = inheritable_thread_target(rows.sparkSession)(measured)
        parts = pool.map(run, list(product(range(len(settings)), range(FOLDS))), chunksize=1)
    means = [sum(parts[i * FOLDS : (i + 1) * FOLDS]) / FOLDS for i in range(len(settings))]
    sign = 1 if evaluator.isLargerBetter() else -1
    best = max(range(len(settings)), key=lambda i: (sign * means[i], -i))
    return Search(settings, means, settings[best], fit(name, rows, **settings[best]))


def fit_meta(rows: DataFrame) -> LogisticRegressionModel:
    """Logistic meta-model on stacked scores; penalty 1 on the summed loss is 1/n on the mean."""
    n = rows.count()
    return LogisticRegression(
        labelCol=LABEL, featuresCol=FEATURES, regParam=1.0 / n, standardization=False, maxIter=100
    ).fit(rows)


def save_model(model, path: str) -> None:
    if isinstance(model, (BoostedStumpsModel, BoostedTreesModel)):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def load_model(name: str, path: str):
    return PRESETS[name].model.load(path)
