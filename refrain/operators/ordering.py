"""Global order statistics without a global sort in one task: running totals, exact quantiles, AUC."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from refrain.functions.columns import hash_share

#: Of the quantile sketch: a returned value's rank is off by at most a 1,000th of the rows.
ACCURACY = 1_000
#: Sampled values per bucket cut; more of them even the buckets out.
PER_CUT = 16


def _bucket_count(df: DataFrame) -> int:
    """As many buckets as shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)


def _cuts_below(cuts: str, value: Column, most: int) -> Column:
    """How many of the sorted cuts (``most`` at the most) are below the value, by bisection."""
    steps = [1 << i for i in reversed(range(most.bit_length()))]

    def further(below: Column, step: Column) -> Column:
        reached = below + step
        return F.when(F.get(cuts, reached - 1) < value, reached).otherwise(below)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)


def running_totals(
    counts: DataFrame, group: str, value: str, amounts: list[str], buckets: int | None = None
) -> DataFrame:
    """For each (group, value) row, the sum of each amount over all smaller values of the group.

    ``counts`` has one row per group and value, and few groups. Values are cut into buckets of
    about equal size; the running total is then the total of the earlier buckets (at most
    ``buckets`` rows per group) plus a running total inside the bucket. The cuts come from a hash
    sample of the values and follow from the set of values alone, so every evaluation of this plan
    cuts at the same places, whatever the order rows arrive in and whichever task is run again.
    They only balance the work: any cut points give the same, exact result.
    Adds ``below_{amount}`` columns.
    """
    buckets = buckets or _bucket_count(counts)
    # Reading an amount here too lets these branches share the shuffle behind ``counts``.
    present = F.when(F.col(amounts[0]) >= 0, F.col(value))
    sizes = counts.groupBy(group).agg(F.count(present).alias("values"))
    drawn = hash_share(F.col(value), "cuts") * F.col("values") < PER_CUT * buckets
    sample = F.array_sort(F.collect_list(F.when(drawn, present)))
    sampled = counts.join(F.broadcast(sizes), group).groupBy(group).agg(sample.alias("sample"))
    places = F.sequence(F.lit(1), F.lit(buckets - 1))
    cut = F.transform(places, lambda i: F.get("sample", F.floor(i * F.size("sample") / buckets).cast("int")))
    cuts = sampled.select(group, cut.alias("cuts"))
    position = _cuts_below("cuts", F.col(value), buckets - 1)
    placed = counts.join(F.broadcast(cuts), group).withColumn("bucket", position).drop("cuts")

    earlier = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(group, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = placed.groupBy(group, "bucket").agg(*[F.sum(a).alias(f"all_{a}") for a in amounts])
    offsets = per_bucket.select(
        group, "bucket", *[F.coalesce(F.sum(f"all_{a}").over(earlier), F.lit(0)).alias(f"before_{a}") for a in amounts]
    )
    return placed.join(F.broadcast(offsets), [group, "bucket"]).select(
        *counts.columns,
        *[(F.col(f"before_{a}") + F.coalesce(F.sum(a).over(inside), F.lit(0))).alias(f"below_{a}") for a in amounts],
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) over several numeric columns in one pass; nulls are left out."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).filter("value IS NOT NULL").groupBy("column", "value").agg(
        F.count("*").alias("n")
    )


def summaries(df: DataFrame, columns: list[str], shares: Sequence[float] = ()) -> list[Row]:
    """(column, count, mean, std, min, max, cuts) per numeric column: one aggregate without a shuffle of values.

    Runs one job. ``cuts`` are sketched bounds, a lower and an upper one per share, between which the
    exact quantile lies: the margin is four times the sketch's error, which covers the neighbouring ranks
    from ``ACCURACY`` values on.
    """
    margin = 4 / ACCURACY
    bounds = [min(max(s + side, 0.0), 1.0) for s in shares for side in (-margin, margin)]
    pieces = []
    for name in columns:
        x = F.col(name).cast("double")
        ranked = F.when(F.isnan(x), math.inf).otherwise(x)  # the sketch knows no NaN; one counts as the last value
        cuts = F.percentile_approx(ranked, bounds, ACCURACY) if bounds else F.array().cast("array<double>")
        pieces.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(x).alias("count"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
                cuts.alias("cuts"),
            )
        )
    return df.agg(F.array(*pieces).alias("rows")).first().rows


def _bracketed(x: Column, cuts: Sequence[float]) -> tuple[Column, Column]:
    """(value, near): a value inside a bracket stays; all values of a gap between brackets become one of that gap.

    The order of values is kept. NaN, the largest double, stands for the gap above the last bracket.
    """
    def order(v: float) -> tuple[bool, float]:
        return math.isnan(v), v

    brackets: list[list[float]] = []
    pairs = [(low, math.nan if high == math.inf else high) for low, high in zip(cuts[::2], cuts[1::2])]
    for low, high in sorted(pairs, key=lambda b: order(b[0])):
        if brackets and order(low) <= order(brackets[-1][1]):
            brackets[-1][1] = max(brackets[-1][1], high, key=order)
        else:
            brackets.append([low, high])
    value, near, below = F.lit(math.nan), F.lit(False), [-math.inf, *(math.nextafter(high, math.inf) for _, high in brackets)]
    for (low, high), gap in reversed(list(zip(brackets, below))):
        value = F.when(x < low, F.lit(gap)).when(x <= high, x).otherwise(value)
        near = F.when(x < low, False).when(x <= high, True).otherwise(near)
    return value, near


def counts_near(df: DataFrame, found: list[Row]) -> DataFrame:
    """(column, value, near, n): value counts that are whole inside the brackets of ``summaries`` only.

    Outside them a count per gap is left, so no more than the brackets hold is shuffled: a few
    1,000ths of the rows per quantile, and ties in one row. Columns of up to ``ACCURACY`` values stay whole.
    """
    cells = []
    for row in found:
        x = F.col(row.column).cast("double")
        value, near = _bracketed(x, row.cuts) if row["count"] > ACCURACY else (x, F.lit(True))
        value = F.when(x.isNotNull(), value)
        cells.append(F.struct(F.lit(row.column).alias("column"), value.alias("value"), near.alias("near")))
    kept = df.select(F.inline(F.array(*cells))).filter("value IS NOT NULL")
    return kept.groupBy("column", "value", "near").agg(F.count("*").alias("n"))


def exact_quantiles(
    counts: DataFrame, shares: dict[str, float], totals: DataFrame | None = None
) -> DataFrame:
    """Interpolated quantiles of each column from its value counts: (column, *shares).

    ``totals`` may bring the (column, count) that are known already. Counts with a column ``near`` stand for
    values folded together where it is false; a quantile never falls there, and if it did the query would fail.
    """
    if totals is None:
        totals = counts.groupBy("column").agg(F.sum("n").alias("count"))
    ranked = running_totals(counts, "column", "value", ["n"]).join(F.broadcast(totals), "column")
    value = F.col("value")
    if "near" in counts.columns:
        value = F.when(F.col("near"), value).otherwise(F.raise_error(F.lit("a quantile outside its bracket")))
    picks = []
    for name, share in shares.items():
        place = F.lit(share) * (F.col("count") - 1)
        low, high = F.floor(place), F.ceil(place)

        def at(rank):
            inside = (F.col("below_n") <= rank) & (rank < F.col("below_n") + F.col("n"))
            return F.max(F.when(inside, value))

        between = at(low) + F.max(place - low) * (at(high) - at(low))
        picks.append(F.when(at(low) == at(high), at(low)).otherwise(between).alias(name))  # infinities are equal too
    return ranked.groupBy("column").agg(*picks)


def auc_by_model(scored: DataFrame, model: str = "model", score: str = "score", label: str = "is_churn") -> DataFrame:
    """Area under the ROC curve per model, ties counted half: (model, auc)."""
    counts = scored.groupBy(model, score).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"), F.sum(1 - F.col(label).cast("bigint")).alias("neg")
    )
    ranked = running_totals(counts, model, score, ["neg"])
    wins = F.sum(F.col("pos") * (F.col("below_neg") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.groupBy(model).agg(F.try_divide(wins, pairs).alias("auc"))
