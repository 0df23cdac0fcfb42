"""From the wide member table to training rows: split, folds, class weights, feature vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.functions.columns import hash_share
from refrain.operators.cleaning import SENTINEL, fill_sentinel
from refrain.operators.ordering import exact_quantiles
from refrain.sources.storage import stage_table

LABEL, KEY, FEATURES, WEIGHT, PART, FOLD = "is_churn", "msno", "features", "weight", "part", "fold"
#: The features with NaN where a value is missing, for models that learn where missing values go.
RAW = "raw"
HOLDOUT_SHARE, SEED, FOLDS = 0.2, 42, 3


def split_cuts(df: DataFrame, share: float = HOLDOUT_SHARE, seed: int = SEED) -> DataFrame:
    """(is_churn, cut): the exact quantile of the key hashes of each class, one row per class."""
    hashes = df.filter(F.col(LABEL).isNotNull()).groupBy(
        F.col(LABEL).alias("column"), hash_share(F.col(KEY), seed).alias("value")
    )
    cuts = exact_quantiles(hashes.agg(F.count("*").alias("n")), {"cut": share})
    return cuts.select(F.col("column").alias(LABEL), "cut")


def stratified_split(
    df: DataFrame, share: float = HOLDOUT_SHARE, seed: int = SEED, cuts: DataFrame | None = None
) -> DataFrame:
    """Adds ``part`` ("train" / "test"): each class gives the same share of its rows, to one row.

    The keys with the smallest hashes of each class are held out, so the split is repeatable on any
    number of executors. ``cuts`` may bring a written ``split_cuts``. Rows without a label train.
    """
    cuts = split_cuts(df, share, seed) if cuts is None else cuts
    held_out = hash_share(F.col(KEY), seed) < F.col("cut")
    split = df.join(F.broadcast(cuts), LABEL, "left")  # one row per class: two
    return split.select(*df.columns, F.when(held_out, "test").otherwise("train").alias(PART))


def with_folds(df: DataFrame, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    return df.withColumn(FOLD, F.floor(hash_share(F.col(KEY), f"fold-{seed}") * folds).cast("int"))


def class_weights(df: DataFrame) -> DataFrame:
    """(is_churn, n, weight): rows / (classes * rows of the class), one row per class."""
    counts = df.groupBy(LABEL).agg(F.count("*").alias("n"))
    size = counts.select(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    balanced = size.getField("rows") / (size.getField("classes") * F.col("n"))
    return counts.withColumn(WEIGHT, balanced)


def with_class_weights(df: DataFrame) -> DataFrame:
    weights = class_weights(df).select(LABEL, WEIGHT)
    return df.join(F.broadcast(weights), LABEL)  # one row per class: two


def assembled(df: DataFrame, columns: list[str], vectors: Sequence[str] = ()) -> DataFrame:
    """Key, label and two vectors of the columns: in ``features`` nulls take the sentinel, in ``raw`` they are NaN.

    ``vectors`` names vector columns (sparse one-hot blocks) that ``features`` takes in behind the columns. ``raw`` is
    dense and goes without them.
    """
    numbers = df.withColumns({c: F.col(c).cast("double") for c in columns})
    gaps = numbers.withColumn(RAW, array_to_vector(F.array(*[F.coalesce(c, F.lit(float("nan"))) for c in columns])))
    filled = fill_sentinel(gaps, columns, SENTINEL)
    kept = [c for c in (KEY, LABEL, PART, FOLD, WEIGHT) if c in df.columns]
    return VectorAssembler(inputCols=[*columns, *vectors], outputCol=FEATURES).transform(filled).select(*kept, FEATURES, RAW)


def staged_training_rows(final: DataFrame, columns: list[str], vectors: Sequence[str] = ()) -> DataFrame:
    """Assembled rows of the final dataset with part, fold and (within the part) class weight.

    The feature build is written out once; weights, every fit and every evaluation read that
    table, so losing an executor never repeats the build.
    """
    rows = stage_table(assembled(with_folds(final), columns, vectors), "training")
    rows = stratified_split(rows, cuts=stage_table(split_cuts(rows), "cuts"))
    counts = rows.groupBy(PART, LABEL).agg(F.count("*").alias("n"))
    sizes = counts.groupBy(PART).agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    balanced = F.col("rows") / (F.col("classes") * F.col("n"))
    weights = counts.join(F.broadcast(sizes), PART).select(PART, LABEL, balanced.alias(WEIGHT))
    return rows.join(F.broadcast(weights), [PART, LABEL])  # two parts, two classes
