"""Data exploration: frequencies, crosstabs, summaries, correlations, densities and duplicates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refrain.functions import columns as C
from refrain.operators import ordering
from refrain.sources.storage import stage_table


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value as text) for every cell of the columns, in one pass."""
    cells = [F.struct(F.lit(c).alias("column"), C.label_null(F.col(c)).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for several columns at once; null is the value "NAN"."""
    return _long(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def most_common(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(column).asc_nulls_last())


def date_part_counts(df: DataFrame, moment: Column) -> DataFrame:
    """(part, value, n) for year, month, day of month and weekday name; null is "NAN"."""
    parts = df.select(
        F.year(moment).alias("year"),
        F.month(moment).alias("month"),
        F.dayofmonth(moment).alias("day"),
        F.date_format(moment, "EEEE").alias("weekday"),
    )
    return frequencies(parts, parts.columns).withColumnRenamed("column", "part")


def rows_per_key_histogram(df: DataFrame, key: str) -> DataFrame:
    """(rows, members): how many keys have how many rows."""
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return per_key.groupBy("rows").agg(F.count("*").alias("members"))


def churn_crosstab(df: DataFrame, columns: list[str], label: str = "is_churn") -> DataFrame:
    """(column, value, stayed, churned, ratio); the ratio is null without any stayer."""
    cells = [F.struct(F.lit(c).alias("column"), C.label_null(F.col(c)).alias("value")) for c in columns]
    counted = (
        df.select(label, F.inline(F.array(*cells)))
        .groupBy("column", "value")
        .agg(F.count_if(F.col(label) == 0).alias("stayed"), F.count_if(F.col(label) == 1).alias("churned"))
    )
    return counted.withColumn("ratio", F.try_divide("churned", "stayed"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max of each numeric column.

    The columns are written when this is called, and two passes over them run: the first takes the moments and
    brackets each quartile by a sketch, the second writes the value counts inside the brackets. The result ranks those alone.
    A column without values counts 0.
    """
    quartiles, totals = _by_selection(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    ordered = ["column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    return totals.join(F.broadcast(quartiles), "column", "left").select(*ordered)


def mean_and_median(df: DataFrame, column: str) -> DataFrame:
    """(column, mean, median) of one numeric column; no row if it holds no value. Two passes first, as in ``describe``."""
    medians, totals = _by_selection(df, [column], {"median": 0.5})
    return totals.join(F.broadcast(medians), "column").select("column", "mean", "median")


def _by_selection(df: DataFrame, columns: list[str], shares: dict[str, float]) -> tuple[DataFrame, DataFrame]:
    """Exact quantiles (column, *shares), and the moments of every column; a row per column each.

    The columns are written once, so that a join behind them is shuffled once for both passes.
    """
    df = stage_table(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "selected")
    found = ordering.summaries(df, columns, list(shares.values()))
    fields = ["column", "count", "mean", "std", "min", "max"]
    schema = "column string, count bigint, mean double, std double, min double, max double"
    totals = df.sparkSession.createDataFrame([[row[f] for f in fields] for row in found], schema)
    counts = stage_table(ordering.counts_near(df, found), "quantiles")
    return ordering.exact_quantiles(counts, shares, totals.select("column", "count")), totals


def null_profile(df: DataFrame) -> DataFrame:
    """(column, type, non_null, total) of every column, in one aggregate."""
    pieces = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.count(name).alias("non_null"),
            F.count("*").alias("total"),
        )
        for name, kind in df.dtypes
    ]
    return df.agg(F.array(*pieces).alias("rows")).select(F.inline("rows"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier one."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Number of rows whose key was seen before (null is a key like any other)."""
    return duplicate_rows(df.select(key))


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, each over the rows where both are known.

    Each row states its complete pairs, which are folded to one state per pair on the map side:
    one pass and one shuffle of as many rows as there are pairs. A constant column gives null.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    cells = [
        F.struct(
            F.lit(i).alias("pair"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")
        )
        for i, (a, b) in enumerate(pairs)
    ]
    complete = df.select(F.inline(F.array(*cells))).filter("x IS NOT NULL AND y IS NOT NULL")
    r = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    found = complete.groupBy("pair").agg(r.alias("r"))
    named = F.array(
        *[F.struct(F.lit(i).alias("pair"), F.lit(a).alias("column"), F.lit(b).alias("other")) for i, (a, b) in enumerate(pairs)],
        *[F.struct(F.lit(i).alias("pair"), F.lit(b).alias("column"), F.lit(a).alias("other")) for i, (a, b) in enumerate(pairs) if a != b],
    )
    names = df.sparkSession.range(1).select(F.inline(named))
    return names.join(F.broadcast(found), "pair", "left").select("column", "other", "r")


def density(df: DataFrame, columns: list[str], points: int = 200, reach: float = 3.0) -> DataFrame:
    """Gaussian kernel density of each column on an even grid: (column, point, x, density).

    Bandwidth is std * n^(-1/5); the grid runs ``reach`` bandwidths beyond both ends. Rows are
    first reduced to value counts. Each distinct value then adds its kernel to the fixed number
    of grid points, summed on the map side, so only grid points are shuffled.
    """
    counts = ordering.value_counts(df, columns)
    value, n = F.col("value"), F.col("n")
    moments = []
    for c in columns:
        x = F.col(c).cast("double")
        moments.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("total"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("low"),
                F.max(x).alias("high"),
            )
        )
    width = F.col("std") * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    grid = (
        df.agg(F.array(*moments).alias("rows"))
        .select(F.inline("rows"))
        .filter(F.col("std") > 0)
        .withColumn("width", width)
        .withColumn("start", F.col("low") - reach * F.col("width"))
        .withColumn("step", (F.col("high") - F.col("low") + 2 * reach * F.col("width")) / (points - 1))
        .select("column", "total", "width", "start", "step")
    )
    placed = counts.join(F.broadcast(grid), "column").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    )
    x = F.col("start") + F.col("point") * F.col("step")
    offset = (x - value) / F.col("width")
    kernel = n * F.exp(-0.5 * offset * offset) / (F.col("total") * F.col("width") * math.sqrt(2 * math.pi))
    return placed.groupBy("column", "point", x.alias("x")).agg(F.sum(kernel).alias("density"))
