"""Catalog: data exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from refrain.catalog.common import (
    Query,
    inputs,
    member_steps,
    rounded,
    rounded_columns,
    settle,
    transaction_steps,
    with_steps,
)
from refrain.functions import columns as C
from refrain.operators import cleaning, explore, joins
from refrain.sources import retail
from refrain.sources.schemas import LOG_MEASURES

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
VIEWS = retail.DUCKDB_VIEWS

MEMBER_CODES = ["city", "bd", "registered_via", "gender", "is_churn"]
PAYMENT_CODES = [
    "payment_method_id",
    "payment_plan_days",
    "plan_list_price",
    "actual_amount_paid",
    "is_auto_renew",
    "is_cancel",
]
CROSSTAB_CODES = ["gender", "registered_via", "city"]
MEMBER_NUMBERS = ["is_churn", "city", "bd", "registered_via", "year", "month", "day", "gender_number"]
LABEL_LOGS = {
    "train": VIEWS["train"],
    "user_logs": VIEWS["user_logs"],
    "label_logs": "SELECT * FROM train LEFT JOIN user_logs USING (msno)",
}


def query(name: str, sql: str):
    def add(function: Query) -> Query:
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return add


def _members(spark, folder):
    tables = inputs(spark, folder)
    return joins.left_join_profiles(tables.label("train"), tables.members)


def _payments(spark, folder):
    tables = inputs(spark, folder)
    return joins.left_join_facts(tables.label("train"), tables.transactions)


def _logs(spark, folder):
    tables = inputs(spark, folder)
    return joins.left_join_facts(tables.label("train"), tables.user_logs)


def _counts_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", coalesce(CAST({c} AS VARCHAR), 'NAN') AS value, count(*) AS n"
        f" FROM {source} GROUP BY ALL"
        for c in columns
    )


def _cents(columns: list[str]) -> list[str]:
    """Money as whole cents, so that its text form is the same in any engine."""
    return [f"CAST(round({c} * 100) AS BIGINT) AS {c}" for c in columns]


MONEY = ["plan_list_price", "actual_amount_paid"]


@query(
    "freq_table",
    with_steps(
        {
            **member_steps(),
            **transaction_steps(),
            "payments": "SELECT * REPLACE (" + ", ".join(_cents(MONEY)) + ") FROM paid_rows",
        },
        _counts_sql("label_members", MEMBER_CODES) + " UNION ALL " + _counts_sql("payments", PAYMENT_CODES),
    ),
)
def freq_table(spark, folder):
    """Counts of every category of members and of distinct payments (money in whole cents)."""
    payments = cleaning.drop_duplicate_rows(_payments(spark, folder))
    cents = payments.withColumns({c: F.round(F.col(c) * 100).cast("bigint") for c in MONEY})
    return joins.union_by_name(
        explore.frequencies(_members(spark, folder), MEMBER_CODES), explore.frequencies(cents, PAYMENT_CODES)
    )


@query(
    "freq_with_null_label",
    with_steps(
        member_steps(),
        """
SELECT msno, coalesce(CAST(city AS VARCHAR), 'NAN') AS city, coalesce(CAST(bd AS VARCHAR), 'NAN') AS bd,
       coalesce(CAST(registered_via AS VARCHAR), 'NAN') AS registered_via, coalesce(gender, 'NAN') AS gender,
       CAST(city AS DOUBLE) AS city_number FROM label_members""",
    ),
)
def freq_with_null_label(spark, folder):
    """Null categories shown as "NAN", and one of them turned back into a number."""
    labelled = _members(spark, folder).select(
        "msno", *[C.label_null(F.col(c)).alias(c) for c in ("city", "bd", "registered_via", "gender")]
    )
    return labelled.withColumn("city_number", C.unlabel_null(F.col("city"), "double"))


@query(
    "registration_trend",
    with_steps(
        member_steps(),
        """
SELECT 'year' AS part, coalesce(CAST(year(day) AS VARCHAR), 'NAN') AS value, count(*) AS n FROM member_known GROUP BY ALL
UNION ALL
SELECT 'month', coalesce(CAST(month(day) AS VARCHAR), 'NAN'), count(*) FROM member_known GROUP BY ALL
UNION ALL
SELECT 'day', coalesce(CAST(day(day) AS VARCHAR), 'NAN'), count(*) FROM member_known GROUP BY ALL
UNION ALL
SELECT 'weekday', coalesce(dayname(day), 'NAN'), count(*) FROM member_known GROUP BY ALL""",
    ),
)
def registration_trend(spark, folder):
    return explore.date_part_counts(_members(spark, folder), C.parse_day(F.col("registration_init_time")))


@query(
    "most_common",
    with_steps(
        member_steps(),
        "SELECT registered_via, count(*) AS n FROM label_members GROUP BY ALL ORDER BY n DESC, registered_via",
    ),
)
def most_common(spark, folder):
    return explore.most_common(_members(spark, folder), "registered_via")


@query(
    "logs_per_user_hist",
    with_steps(
        LABEL_LOGS,
        "SELECT rows, count(*) AS members FROM"
        " (SELECT msno, count(*) AS rows FROM label_logs GROUP BY msno) GROUP BY rows",
    ),
)
def logs_per_user_hist(spark, folder):
    return explore.rows_per_key_histogram(_logs(spark, folder), "msno")


@query(
    "crosstab_churn",
    with_steps(
        member_steps(),
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", coalesce(CAST({c} AS VARCHAR), 'NAN') AS value,"
            " count(*) FILTER (is_churn = 0) AS stayed, count(*) FILTER (is_churn = 1) AS churned,"
            f" {rounded('count(*) FILTER (is_churn = 1) / nullif(count(*) FILTER (is_churn = 0), 0)')} AS ratio"
            " FROM label_members GROUP BY ALL"
            for c in CROSSTAB_CODES
        ),
    ),
)
def crosstab_churn(spark, folder):
    return settle(explore.churn_crosstab(_members(spark, folder), CROSSTAB_CODES))


def _describe_sql(source: str, columns: list[str]) -> str:
    def number(aggregate: str, name: str) -> str:
        return f"{rounded(aggregate, 4)} AS {name}"

    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {number(f'avg({c})', 'mean')},"
        f" {number(f'stddev_samp({c})', 'std')}, {number(f'min({c})', 'min')},"
        f" {number(f'quantile_cont({c}::DOUBLE, 0.25)', 'q25')}, {number(f'quantile_cont({c}::DOUBLE, 0.5)', 'q50')},"
        f" {number(f'quantile_cont({c}::DOUBLE, 0.75)', 'q75')}, {number(f'max({c})', 'max')} FROM {source}"
        for c in columns
    )


@query("describe", with_steps(LABEL_LOGS, _describe_sql("label_logs", ["is_churn", *LOG_MEASURES])))
def describe(spark, folder):
    return settle(explore.describe(_logs(spark, folder), ["is_churn", *LOG_MEASURES]), 4)


DESCRIBED_PAYMENTS = ["is_churn", *PAYMENT_CODES, "transaction_date", "membership_expire_date"]


@query(
    "describe_transactions",
    with_steps(
        {
            "train": VIEWS["train"],
            "transactions": VIEWS["transactions"],
            "label_payments": "SELECT * FROM train LEFT JOIN transactions USING (msno)",
        },
        _describe_sql("label_payments", DESCRIBED_PAYMENTS),
    ),
)
def describe_transactions(spark, folder):
    return settle(explore.describe(_payments(spark, folder), DESCRIBED_PAYMENTS), 4)


@query(
    "null_profile",
    with_steps(
        {"train": VIEWS["train"], **member_steps()},
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{kind}' AS type, count({c}) AS non_null, count(*) AS total FROM label_members"
            for c, kind in [
                ("msno", "bigint"),
                ("is_churn", "int"),
                ("city", "int"),
                ("bd", "int"),
                ("gender", "string"),
                ("registered_via", "int"),
                ("registration_init_time", "int"),
            ]
        ),
    ),
)
def null_profile(spark, folder):
    return explore.null_profile(_members(spark, folder))


@query(
    "dup_count",
    with_steps(
        {
            "train": VIEWS["train"],
            "transactions": VIEWS["transactions"],
            "joined": "SELECT * FROM train LEFT JOIN transactions USING (msno)",
        },
        "SELECT (SELECT count(*) FROM joined) - (SELECT count(*) FROM (SELECT DISTINCT * FROM joined)) AS duplicates",
    ),
)
def dup_count(spark, folder):
    return explore.duplicate_rows(_payments(spark, folder))


@query(
    "dup_key_count",
    with_steps(
        {
            "train": VIEWS["train"],
            "transactions": VIEWS["transactions"],
            "joined": "SELECT msno FROM train LEFT JOIN transactions USING (msno)",
        },
        "SELECT count(*) - count(DISTINCT msno) AS duplicates FROM joined",
    ),
)
def dup_key_count(spark, folder):
    return explore.duplicate_keys(_payments(spark, folder), "msno")


@query(
    "age_stats",
    with_steps(
        member_steps(),
        f"""
SELECT 'bd' AS "column", {rounded('avg(bd)')} AS mean, {rounded('median(bd)')} AS median
FROM label_members WHERE bd > 0 AND bd < 90""",
    ),
)
def age_stats(spark, folder):
    usual = _members(spark, folder).filter((F.col("bd") > 0) & (F.col("bd") < 90))
    return settle(explore.mean_and_median(usual, "bd"))


@query(
    "distinct_sorted",
    with_steps(member_steps(), "SELECT DISTINCT city FROM label_members ORDER BY city NULLS LAST"),
)
def distinct_sorted(spark, folder):
    return explore.distinct_values(_members(spark, folder), "city")


def _correlation_sql(source: str, columns: list[str]) -> str:
    cells = []
    for a in columns:
        for b in columns:
            r = f"corr({a}, {b})"
            value = rounded(f"CASE WHEN isnan({r}) THEN NULL ELSE {r} END")
            cells.append(f"SELECT '{a}' AS \"column\", '{b}' AS other, {value} AS r FROM {source}")
    return " UNION ALL ".join(cells)


@query(
    "correlation",
    with_steps(
        {
            **member_steps(),
            "coded": """
SELECT *, year(day) AS year, month(day) AS month, day(day) AS day_of_month,
       CASE WHEN gender = 'male' THEN 0 ELSE 1 END AS gender_number FROM member_known""",
            "numbers": "SELECT is_churn, city, bd, registered_via, year, month, day_of_month AS day, gender_number FROM coded",
        },
        _correlation_sql("numbers", MEMBER_NUMBERS),
    ),
)
def correlation(spark, folder):
    moment = C.parse_day(F.col("registration_init_time"))
    coded = _members(spark, folder).withColumns(
        {
            "year": F.year(moment),
            "month": F.month(moment),
            "day": F.dayofmonth(moment),
            "gender_number": C.gender_code(F.col("gender")),
        }
    )
    return settle(explore.correlation(coded, MEMBER_NUMBERS))


RAW_MEMBER_NUMBERS = ["city", "bd", "registered_via", "registration_init_time"]


@query(
    "correlation_members",
    with_steps({"members": VIEWS["whole_members"]}, _correlation_sql("members", RAW_MEMBER_NUMBERS)),
)
def correlation_members(spark, folder):
    return settle(explore.correlation(retail.members(spark, folder), RAW_MEMBER_NUMBERS))


@query(
    "correlation_transactions",
    with_steps(transaction_steps(), _correlation_sql("paid_rows", ["is_churn", *PAYMENT_CODES])),
)
def correlation_transactions(spark, folder):
    distinct = cleaning.drop_duplicate_rows(_payments(spark, folder))
    return settle(explore.correlation(distinct, ["is_churn", *PAYMENT_CODES]))


def _density_sql(column: str) -> str:
    return f"""
SELECT '{column}' AS "column", CAST(point AS INT) AS point, {rounded('start + point * step', 4)} AS x,
       {rounded('sum(n * exp(-0.5 * pow((start + point * step - value) / width, 2))) / (total * width * sqrt(2 * pi()))', 4)} AS density
FROM (SELECT {column}::DOUBLE AS value, count(*) AS n FROM label_logs WHERE {column} IS NOT NULL GROUP BY 1)
CROSS JOIN (SELECT total, width, low - 3 * width AS start, (high - low + 6 * width) / 199 AS step
            FROM (SELECT count({column}) AS total, min({column})::DOUBLE AS low, max({column})::DOUBLE AS high,
                         stddev_samp({column}) * pow(count({column}), -0.2) AS width FROM label_logs))
CROSS JOIN (SELECT unnest(range(200)) AS point)
GROUP BY point, start, step, total, width"""


@query("density", with_steps(LABEL_LOGS, " UNION ALL ".join(_density_sql(m) for m in LOG_MEASURES)))
def density(spark, folder):
    curves = explore.density(_logs(spark, folder), LOG_MEASURES)
    return settle(curves, 4)
