"""Scores, blends, stacking, metrics, reports and importances."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from typing import Any

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.learning import models
from refrain.learning.prepare import FEATURES, FOLD, KEY, LABEL, PART
from refrain.learning.trees import BoostedTreesModel
from refrain.operators.ordering import auc_by_model
from refrain.sources.storage import fresh_path, shared_dir

# Fixed value: scores are kept this far from 0 and 1 (the spacing of doubles at 1).
CLIP = 2.220446049250313e-16


def churn_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def with_scores(fitted: dict[str, Any], rows: DataFrame) -> DataFrame:
    """One probability column per model, all from a single pass over the rows."""
    names = []
    for name, model in fitted.items():
        scored = model.transform(rows).withColumn(name, churn_probability())
        rows = scored.select(*rows.columns, name)
        names.append(name)
    return rows


def blend(*scores: str) -> Column:
    return sum((F.col(s) for s in scores[1:]), F.col(scores[0])) / len(scores)


def singles_and_pairs(scores: list[str]) -> dict[str, Column]:
    """Every single score, then the average of every unordered pair, named ``a-b``."""
    pairs = {f"{a}-{b}": blend(a, b) for a, b in combinations(scores, 2)}
    return {**{s: F.col(s) for s in scores}, **pairs}


def long_scores(scored: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(model, score, is_churn), one row per model and scored row."""
    cells = [F.struct(F.lit(n).alias("model"), c.cast("double").alias("score")) for n, c in columns.items()]
    return scored.select(LABEL, F.inline(F.array(*cells)))


def row_loss(score: Column, label: Column) -> Column:
    p = F.least(F.greatest(score, F.lit(CLIP)), F.lit(1 - CLIP))
    return -F.when(label == 1, F.log(p)).otherwise(F.log(1 - p))


def log_loss(long: DataFrame) -> DataFrame:
    return long.groupBy("model").agg(F.avg(row_loss(F.col("score"), F.col(LABEL))).alias("log_loss"))


def report(scored: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(model, auc, log_loss) of each score column or blend. The scores are read three times, so they should be written first."""
    long = long_scores(scored, columns)
    return auc_by_model(long).join(F.broadcast(log_loss(long)), "model")


def stacked(scored: DataFrame, scores: list[str]) -> DataFrame:
    """Base scores as the feature vector of the meta-model."""
    kept = [c for c in (KEY, LABEL, PART, FOLD) if c in scored.columns]
    assembler = VectorAssembler(inputCols=scores, outputCol=FEATURES)
    return assembler.transform(scored.drop(FEATURES)).select(*kept, *scores, FEATURES)


def out_of_fold_scores(
    names: list[str], rows: DataFrame, folds: int, changes: dict[str, dict[str, Any]] | None = None, at_once: int = 1
) -> DataFrame:
    """Scores of each row by models fitted on the other folds, so the meta-model sees no leak.

    ``changes`` replace some settings of a model, by its name. Fits run ``at_once`` at a time, those of a name side by side.
    """
    shared_dir(rows.sparkSession)

    def fit(name: str, fold: int):
        return lambda: models.fit(name, rows.filter(F.col(FOLD) != fold), **(changes or {}).get(name, {}))

    jobs = [(name, fold) for name in names for fold in range(folds)]
    fitted = dict(zip(jobs, models.side_by_side(rows.sparkSession, [fit(*job) for job in jobs], at_once)))
    parts = [with_scores({n: fitted[n, fold] for n in names}, rows.filter(F.col(FOLD) == fold)) for fold in range(folds)]
    return reduce(DataFrame.unionByName, parts)


def meta_coefficients(meta, names: list[str], spark) -> DataFrame:
    return spark.createDataFrame(
        [(n, float(c)) for n, c in zip(names, meta.coefficients)], "model string, coefficient double"
    )


def gain_importance(model, columns: list[str], spark, top: int = 20) -> DataFrame:
    """The features with the largest mean gain of a split: (feature, gain)."""
    gains = _splits(model, columns, spark).select("feature", F.col("mean_gain").alias("gain"))
    return gains.orderBy(F.desc("gain"), "feature").limit(top)


def split_importance(model, columns: list[str], spark, top: int = 20) -> DataFrame:
    """The features split on most often, with the mean gain of those splits."""
    return _splits(model, columns, spark).orderBy(F.desc("splits"), "feature").limit(top)


def _splits(model, columns: list[str], spark) -> DataFrame:
    """(feature, splits, mean_gain) over all trees, as a query over the table of their nodes.

    An MLlib ensemble has that table in its saved form.
    """
    names = spark.createDataFrame(list(enumerate(columns)), "index int, feature string")
    if isinstance(model, BoostedTreesModel):
        splits = model.nodes().filter("left >= 0").select(F.col("feature").alias("index"), "gain")
    else:
        path = fresh_path(spark, "nodes")
        models.save_model(model, path)
        splits = spark.read.parquet(f"{path}/data").select(
            F.col("nodeData.split.featureIndex").alias("index"), F.col("nodeData.gain").alias("gain")
        )
    counted = (
        splits.filter(F.col("index") >= 0)
        .groupBy("index")
        .agg(F.count("*").alias("splits"), F.avg("gain").alias("mean_gain"))
    )
    return counted.join(F.broadcast(names), "index").select("feature", "splits", "mean_gain")


def submission(scored: DataFrame, *scores: str) -> DataFrame:
    """Member and blended churn probability, ready for a CSV file."""
    return scored.select(KEY, blend(*scores).alias(LABEL))
