"""Catalog: member profiles, the composite feature pipelines and the one-hot blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from refrain.catalog.common import (
    ONE_HOT_DOMAIN,
    Query,
    final_steps,
    inputs,
    log_steps,
    member_steps,
    moment_text,
    pivot_columns,
    rounded_columns,
    settle,
    total_columns,
    transaction_steps,
    with_steps,
)
from refrain.operators import joins, onehot, profiles
from refrain.plans import features, state_store
from refrain.sources import retail
from refrain.sources.storage import fresh_path, stage_table

VIEWS = retail.DUCKDB_VIEWS
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TX_DOUBLES = [*profiles.TRANSACTION_MEANS, "percent_of_autorenew"]
TX_OTHERS = ["most_freq_payment_method", *profiles.TRANSACTION_SUMS, "amount_transactions"]
LOG_DATES = ["first_login", "last_login"]
BLOCK = [f"{c}_{v}" for c, values in ONE_HOT_DOMAIN.items() for v in values]


def query(name: str, sql: str):
    def add(function: Query) -> Query:
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return add


def _log_select(source: str, totals: bool, pivot: bool) -> str:
    parts = ["msno"]
    if totals:
        parts += [rounded_columns(total_columns()["double"]), *total_columns()["other"], "amount_of_logins"]
        parts += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in LOG_DATES]
    if pivot:
        parts += [rounded_columns(pivot_columns()["double"]), *pivot_columns()["other"]]
    return f"SELECT {', '.join(parts)} FROM {source}"


def _ranked(spark, folder, split="train"):
    states = profiles.month_states(features.clean_logs(inputs(spark, folder), split))
    return profiles.rank_months(states)


@query(
    "members_features",
    with_steps(
        member_steps(),
        f"""
SELECT msno, is_churn, city, {rounded_columns(['bd'])}, registered_via,
       {moment_text('registration_init_time')} AS registration_init_time FROM member_features""",
    ),
)
def members_features(spark, folder):
    return settle(features.member_features(inputs(spark, folder), "train"))


def _tx_sql(split: str) -> str:
    return with_steps(
        transaction_steps(split),
        f"""
SELECT msno, {', '.join(TX_OTHERS)}, {rounded_columns(TX_DOUBLES, 4)},
       {moment_text('first_transaction')} AS first_transaction, {moment_text('last_transaction')} AS last_transaction
FROM transaction_features""",
    )


@query("tx_profile", _tx_sql("train"))
def tx_profile(spark, folder):
    return settle(features.transaction_features(inputs(spark, folder), "train"), 4)


@query("tx_profile_test", _tx_sql("test"))
def tx_profile_test(spark, folder):
    return settle(features.transaction_features(inputs(spark, folder), "test"), 4)


@query(
    "tx_mode",
    with_steps(
        transaction_steps(),
        "SELECT msno, payment_method_id AS most_freq_payment_method FROM label LEFT JOIN"
        " (SELECT * FROM method_rank WHERE place = 1) USING (msno)",
    ),
)
def tx_mode(spark, folder):
    from refrain.catalog.rows import paid_rows

    return profiles.most_frequent(
        paid_rows(spark, folder), "msno", "payment_method_id", "most_freq_payment_method"
    )


@query("logs_totals", with_steps(log_steps(), _log_select("log_totals", True, False)))
def logs_totals(spark, folder):
    return settle(profiles.log_totals(_ranked(spark, folder)))


MONTHLY_DOUBLES = [f"{m}_mean_monthly" for m in profiles.MEAN_MEASURES] + ["total_secs_sum_monthly"]
MONTHLY_OTHERS = [f"{m}_sum_monthly" for m in profiles.LOG_MEASURES if m != "total_secs"]


@query(
    "logs_monthly",
    with_steps(
        log_steps(),
        f"SELECT msno, year, month, {rounded_columns(MONTHLY_DOUBLES)}, {', '.join(MONTHLY_OTHERS)} FROM log_months",
    ),
)
def logs_monthly(spark, folder):
    return settle(profiles.monthly_columns(_ranked(spark, folder)).drop("month_rank"))


@query(
    "logs_month_rank",
    with_steps(log_steps(), "SELECT msno, year, month, month_rank FROM log_months WHERE month_rank <= 3"),
)
def logs_month_rank(spark, folder):
    newest = profiles.newest_months(_ranked(spark, folder))
    return newest.select("msno", "year", "month", "month_rank")


@query("logs_monthly_pivot", with_steps(log_steps(), _log_select("log_pivot", False, True)))
def logs_monthly_pivot(spark, folder):
    return settle(profiles.pivot_months(_ranked(spark, folder)))


@query("logs_profile", with_steps(log_steps(), _log_select("log_features", True, True)))
def logs_profile(spark, folder):
    return settle(features.log_features(inputs(spark, folder), "train"))


@query("logs_profile_test", with_steps(log_steps("test"), _log_select("log_features", True, True)))
def logs_profile_test(spark, folder):
    return settle(features.log_features(inputs(spark, folder), "test"))


@query("partial_merge", with_steps(log_steps(), _log_select("log_features", True, True)))
def partial_merge(spark, folder):
    """Month states built from four arbitrary parts of the clean rows, then merged exactly."""
    rows = features.clean_logs(inputs(spark, folder), "train")
    chunk = F.pmod(F.xxhash64(*rows.columns), F.lit(4))
    parts = profiles.month_states(rows.withColumn("chunk", chunk), "chunk")
    return settle(profiles.log_profile(profiles.rank_months(profiles.merge_states(parts))))


@query("incremental_logs", with_steps(log_steps(), _log_select("log_features", True, True)))
def incremental_logs(spark, folder):
    """Stored month states by week of delivery: a first load with the newest week cut short and another one late, then
    both brought up to date. Only those two weeks are folded again."""
    tables = inputs(spark, folder)
    # A week's rows by its Monday: copies of a row share its day, hence its chunk.
    week = F.date_format(F.date_trunc("week", "date"), "yyyy-MM-dd")
    logs = joins.over_members(tables.user_logs.filter("date IS NOT NULL"), tables.label("train"), lambda rows: rows)
    logs = stage_table(logs.withColumn(state_store.CHUNK, week), "logs")
    chunk = F.col(state_store.CHUNK)
    ends = logs.select(F.struct(F.min(chunk).alias("late"), F.max(chunk).alias("newest"))).scalar()
    late, newest = chunk == ends.getField("late"), chunk == ends.getField("newest")
    path, store_path = fresh_path(spark, "chunks"), fresh_path(spark, "states")
    store = state_store.StateStore(spark, path, store_path)
    state_store.write_chunks(logs.filter(~late & (~newest | (F.col("num_75") < 3))), path)
    store.refresh()
    state_store.write_chunks(logs.filter(late | newest), path)
    store.refresh()
    return settle(store.profile())


@query(
    "one_hot",
    with_steps(
        {k: v for k, v in final_steps().items() if k in ("label", "members") or k.startswith(("label_", "member_"))},
        "SELECT msno, "
        + ", ".join(
            f"CASE WHEN {c} = {v} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {c}_{v}"
            for c, values in ONE_HOT_DOMAIN.items()
            for v in values
        )
        + " FROM (SELECT *, year(registration_init_time) AS registration_init_time_year,"
        " month(registration_init_time) AS registration_init_time_month FROM member_features)",
    ),
)
def one_hot(spark, folder):
    parts = features.with_registration_parts(features.member_features(inputs(spark, folder), "train"))
    kept = parts.select("msno", *features.ONE_HOT_COLUMNS)
    return onehot.one_hot(kept, onehot.fit_categories(kept, features.ONE_HOT_COLUMNS))


WIDE_COLUMNS = ["price_cents", "payment_method_id"]


@query(
    "one_hot_sparse",
    with_steps(
        {
            "train": VIEWS["train"],
            "transactions": VIEWS["transactions"],
            "priced": """
SELECT CAST(round(plan_list_price * 100) AS BIGINT) AS price_cents, payment_method_id
FROM train JOIN transactions USING (msno)""",
        },
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value,"
            f' CAST(row_number() OVER (ORDER BY {c}) - 1 AS INT) AS "index", CAST(count(*) AS BIGINT) AS n'
            f" FROM priced WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in WIDE_COLUMNS
        ),
    ),
)
def one_hot_sparse(spark, folder):
    """Price points and payment methods of all payments as sparse vectors, read back as the sum of each vector."""
    tables = inputs(spark, folder)
    cents = F.round(F.col("plan_list_price") * 100).cast("bigint").alias("price_cents")
    rows = joins.join_facts(tables.label("train"), tables.transactions).select(cents, "payment_method_id")
    index = onehot.category_index(rows, WIDE_COLUMNS)
    encoded = onehot.one_hot_sparse(rows, index, WIDE_COLUMNS)
    sums = onehot.vector_sums(encoded, [f"{c}_vector" for c in WIDE_COLUMNS])
    sums = sums.select(F.regexp_replace("vector", "_vector$", "").alias("column"), "index", "total")
    sums = sums if index.count() <= onehot.WIDE else sums.hint("merge")
    counted = index.join(sums, ["column", "index"], "left")
    return counted.select("column", "value", "index", F.coalesce("total", F.lit(0.0)).cast("bigint").alias("n"))


def _final_sql(split: str) -> str:
    other = [
        "msno",
        "is_churn",
        *TX_OTHERS,
        *total_columns()["other"],
        "amount_of_logins",
        *pivot_columns()["other"],
        "diff_first_last_transaction",
        "diff_max_min_log",
        "diff_first_log_registration",
        "days_since_last_transaction",
        "days_since_registration",
        "diff_days_last_login_last_transaction",
        "days_since_last_login",
        "rare_user",
        *BLOCK,
    ]
    doubles = ["bd", *TX_DOUBLES, *total_columns()["double"], *pivot_columns()["double"]]
    return with_steps(final_steps(split), f"SELECT {', '.join(other)}, {rounded_columns(doubles, 4)} FROM final")


@query("final_dataset", _final_sql("train"))
def final_dataset(spark, folder):
    return settle(features.final_dataset(inputs(spark, folder), "train"), 4)


@query("final_dataset_test", _final_sql("test"))
def final_dataset_test(spark, folder):
    """The scoring split encoded with the categories learned from the training split."""
    tables = inputs(spark, folder)
    categories = features.learn_categories(tables, "train")
    return settle(features.final_dataset(tables, "test", categories), 4)
