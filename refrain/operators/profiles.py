"""Member profiles of transactions and listening logs.

No member's raw rows ever meet in one task: rows are first reduced to partial states (by
day, payment method or month) with map-side combining, and only those states, bounded by
the calendar and the number of methods, are brought together per member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from refrain.functions import columns as C
from refrain.operators import cleaning
from refrain.sources.schemas import DAY_GAP, LOG_MEASURES

MONTHS_KEPT = 3
MEAN_MEASURES = [*LOG_MEASURES, DAY_GAP]
#: Parts that a member's payments are dealt to by date.
DAY_PARTS = 16

# Output column -> input column of the transaction profile.
TRANSACTION_MEANS = {
    "payment_plan_days_mean": "payment_plan_days",
    "plan_list_price_mean": "plan_list_price",
    "actual_amount_paid_mean": "actual_amount_paid",
    "mean_paid_per_day": "paid_per_day",
}
TRANSACTION_SUMS = {
    "amount_paid_less": "has_paid_less",
    "amount_paid_more": "has_paid_more",
    "amount_cancels": "is_cancel",
    "total_autorenew": "is_auto_renew",
}
TRANSACTION_PROFILE = [
    "payment_plan_days_mean",
    "plan_list_price_mean",
    "actual_amount_paid_mean",
    "most_freq_payment_method",
    "amount_paid_less",
    "amount_paid_more",
    "amount_cancels",
    "mean_paid_per_day",
    "amount_transactions",
    "total_autorenew",
    "first_transaction",
    "last_transaction",
    "percent_of_autorenew",
]


def most_frequent(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Most frequent value per key, the smallest one on a tie, null where all are null."""
    counted = rows.groupBy(key, value).agg(F.count(value).alias("n"))
    # Largest count wins; among equal counts the struct falls back to the negated value.
    best = F.max_by(value, F.when(F.col("n") > 0, F.struct(F.col("n"), -F.col(value))))
    return counted.groupBy(key).agg(best.alias(name))


def transaction_profile(rows: DataFrame) -> DataFrame:
    """One row per member over distinct raw transaction rows.

    Distinct dates and the most frequent method need two different groupings. A member's rows are dealt to
    ``DAY_PARTS`` parts by date: a part counts its own days and leaves one state, so what is brought together per
    member is a few states, not one per day. Methods are counted apart, in rows of their own that carry nothing else.
    """
    means, sums = TRANSACTION_MEANS, TRANSACTION_SUMS
    measures = [*means.values(), *sums.values()]
    known = rows.filter(F.col("msno").isNotNull())
    part = F.pmod(F.xxhash64(C.parse_day(F.col("transaction_date"))), F.lit(DAY_PARTS))
    dealt = cleaning.with_transaction_columns(known.withColumn("part", part).repartition("msno", "part"))
    days = dealt.groupBy("msno", "part", "transaction_date").agg(
        *[F.sum(c).alias(f"sum_{c}") for c in measures],
        *[F.count(c).alias(f"known_{c}") for c in means.values()],
    )
    parts = days.groupBy("msno", "part").agg(
        *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in measures],
        *[F.sum(f"known_{c}").alias(f"known_{c}") for c in means.values()],
        F.count("transaction_date").alias("days"),
        F.min("transaction_date").alias("first_transaction"),
        F.max("transaction_date").alias("last_transaction"),
    )
    # No filter on the method here: it would sink below the removal of duplicates and let its shuffle run twice.
    methods = known.groupBy("msno", "payment_method_id").agg(F.count("payment_method_id").alias("method_rows"))
    states = parts.drop("part").unionByName(methods, allowMissingColumns=True)
    method = F.col("payment_method_id")
    profile = states.groupBy("msno").agg(
        *[F.try_divide(F.sum(f"sum_{c}"), F.sum(f"known_{c}")).alias(name) for name, c in means.items()],
        *[F.coalesce(F.sum(f"sum_{c}"), F.lit(0)).alias(name) for name, c in sums.items()],
        F.max_by(method, F.when(method.isNotNull(), F.struct("method_rows", -method))).alias("most_freq_payment_method"),
        F.sum("days").alias("amount_transactions"),
        F.min("first_transaction").alias("first_transaction"),
        F.max("last_transaction").alias("last_transaction"),
    )
    return profile.select("msno", *TRANSACTION_PROFILE[:-1], autorenew_share().alias("percent_of_autorenew"))


def autorenew_share():
    return F.try_divide(F.col("total_autorenew"), F.col("amount_transactions"))


def month_states(rows: DataFrame, *extra_keys: str) -> DataFrame:
    """Mergeable state of clean log rows per member and month: row count, sums, first and last day."""
    known = rows.filter(F.col("msno").isNotNull())
    return known.groupBy("msno", F.year("date").alias("year"), F.month("date").alias("month"), *extra_keys).agg(
        F.count("*").alias("logs"),
        *[F.sum(m).alias(m) for m in LOG_MEASURES],
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """Exact merge of month states that were built from disjoint parts of the rows."""
    return states.groupBy("msno", "year", "month").agg(
        F.sum("logs").alias("logs"),
        *[F.sum(m).alias(m) for m in LOG_MEASURES],
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )


def rank_months(states: DataFrame) -> DataFrame:
    """Adds ``month_rank`` (1 = newest month with logs) and the month's summed day gaps.

    Gaps between consecutive days add up to last minus first, so a month's sum is its last day
    minus the last day of the previous logged month (its own first day if there is none).
    """
    member = Window.partitionBy("msno")
    newest_first = member.orderBy(F.col("year").desc(), F.col("month").desc())
    # In newest-first order the month before this one is the next row.
    since = F.coalesce(F.lead("last_day").over(newest_first), F.col("first_day"))
    return states.withColumns(
        {
            "month_rank": F.row_number().over(newest_first),
            DAY_GAP: F.datediff("last_day", since).cast("bigint"),
        }
    )


def monthly_columns(ranked: DataFrame) -> DataFrame:
    """Monthly means (8) and sums (7) per member and month."""
    return ranked.select(
        "msno",
        "year",
        "month",
        "month_rank",
        *[F.try_divide(F.col(m), F.col("logs")).alias(f"{m}_mean_monthly") for m in MEAN_MEASURES],
        *[F.col(m).alias(f"{m}_sum_monthly") for m in LOG_MEASURES],
    )


def newest_months(ranked: DataFrame, months: int = MONTHS_KEPT) -> DataFrame:
    return ranked.filter(F.col("month_rank") <= months)


def _pivoted(months: int) -> list:
    """Conditional aggregates of the pivot: missing mean -> null, missing sum -> 0."""
    ranks = range(1, months + 1)
    means = [
        f"max(CASE WHEN month_rank = {r} THEN try_divide({m}, logs) END) AS {m}_mean_monthly_{r}"
        for m in MEAN_MEASURES
        for r in ranks
    ]
    sums = [
        f"coalesce(max(CASE WHEN month_rank = {r} THEN {m} END), 0) AS {m}_sum_monthly_{r}"
        for m in LOG_MEASURES
        for r in ranks
    ]
    return [F.expr(text) for text in means + sums]


def _totals() -> list:
    means = [f"try_divide(sum({m}), sum(logs)) AS {m}_mean" for m in MEAN_MEASURES]
    sums = [f"sum({m}) AS {m}_sum" for m in MEAN_MEASURES]
    ends = ["min(first_day) AS first_login", "max(last_day) AS last_login", "sum(logs) AS amount_of_logins"]
    return [F.expr(text) for text in means + sums + ends]


def log_totals(ranked: DataFrame) -> DataFrame:
    """Per member: 8 means, 8 sums, first and last login, number of log rows."""
    return ranked.groupBy("msno").agg(*_totals())


def pivot_months(ranked: DataFrame, months: int = MONTHS_KEPT) -> DataFrame:
    """Per member: each measure of the newest months side by side, ``{measure}_{rank}``."""
    return newest_months(ranked, months).groupBy("msno").agg(*_pivoted(months))


def log_profile(ranked: DataFrame, months: int = MONTHS_KEPT) -> DataFrame:
    """Totals and pivoted months in one aggregate (64 columns for three months)."""
    return ranked.groupBy("msno").agg(*_totals(), *_pivoted(months))
