"""Shared parts of the catalog: inputs, comparable output columns and SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from refrain.plans.features import Inputs
from refrain.sources import retail
from refrain.sources.schemas import DAY_GAP, LOG_MEASURES

Query = Callable[[SparkSession, str], DataFrame]
MEAN_MEASURES = [*LOG_MEASURES, DAY_GAP]


class FolderInputs(Inputs):
    """The raw tables of a folder, each derived when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.__dict__.update(spark=spark, folder=folder)

    @cached_property
    def labels(self):
        return retail.labels(self.spark, self.folder)

    @cached_property
    def members(self):
        return retail.members(self.spark, self.folder, whole=False)

    @cached_property
    def transactions(self):
        return retail.transactions(self.spark, self.folder, whole=False)

    @cached_property
    def user_logs(self):
        return retail.user_logs(self.spark, self.folder)


def inputs(spark: SparkSession, folder: str) -> Inputs:
    return FolderInputs(spark, folder)


def _nudge(digits: int) -> float:
    """A small part of the last digit, added before rounding so that exact ties, where two
    engines' last bits decide, are moved off the rounding edge."""
    return float(f"1.37e-{digits + 2}")


def settle(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded and dates as text, so that results compare equal across engines."""
    rules = {
        "double": f"round(`{{0}}` + {_nudge(digits)!r}D, {digits}) AS `{{0}}`",
        "date": "date_format(`{0}`, 'yyyy-MM-dd') AS `{0}`",
        "timestamp": "date_format(`{0}`, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS `{0}`",
    }
    return df.selectExpr(*[rules.get(kind, "`{0}`").format(name) for name, kind in df.dtypes])


def rounded(expression: str, digits: int = 6) -> str:
    return f"round(({expression}) + {_nudge(digits)!r}, {digits})"


def rounded_columns(names: Iterable[str], digits: int = 6) -> str:
    return ", ".join(f"{rounded(n, digits)} AS {n}" for n in names)


def moment_text(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def with_steps(steps: dict[str, str], select: str) -> str:
    """A SELECT over named steps, each of which may use the ones before it."""
    ctes = ",\n".join(f"{name} AS ({text.strip()})" for name, text in steps.items())
    return f"WITH {ctes}\n{select.strip()}"


def member_steps(split: str = "train", cutoff: str = "2017-02-28") -> dict[str, str]:
    return {
        "label": retail.DUCKDB_VIEWS[split],
        "members": retail.DUCKDB_VIEWS["members"],
        "label_members": "SELECT * FROM label LEFT JOIN members USING (msno)",
        "member_known": f"""
SELECT *, CASE WHEN bd > 5 AND bd < 80 THEN CAST(bd AS DOUBLE) END AS age,
       CASE WHEN day < TIMESTAMP '{cutoff}' THEN day END AS registered
FROM (SELECT *, try_strptime(CAST(registration_init_time AS VARCHAR), '%Y%m%d') AS day FROM label_members)""",
        "member_means": """
SELECT avg(age) AS mean_age, make_timestamp((sum(epoch_us(registered)) // count(registered))::BIGINT) AS mean_day
FROM member_known""",
        "member_features": """
SELECT msno, is_churn, coalesce(city, 0) AS city, coalesce(age, mean_age) AS bd,
       coalesce(registered_via, 0) AS registered_via,
       coalesce(registered, mean_day) AS registration_init_time
FROM member_known CROSS JOIN member_means""",
    }


def transaction_steps(split: str = "train") -> dict[str, str]:
    return {
        "label": retail.DUCKDB_VIEWS[split],
        "transactions": retail.DUCKDB_VIEWS["transactions"],
        "paid_rows": """
SELECT DISTINCT msno, is_churn, payment_method_id, payment_plan_days, plan_list_price, actual_amount_paid,
       is_auto_renew, transaction_date, membership_expire_date, is_cancel
FROM label LEFT JOIN transactions USING (msno)""",
        "paid": """
SELECT *, try_strptime(CAST(transaction_date AS VARCHAR), '%Y%m%d') AS paid_day,
       try_strptime(CAST(membership_expire_date AS VARCHAR), '%Y%m%d') AS expire_day,
       plan_list_price - actual_amount_paid AS difference,
       CASE WHEN plan_list_price > actual_amount_paid THEN 1 ELSE 0 END AS has_paid_less,
       CASE WHEN plan_list_price < actual_amount_paid THEN 1 ELSE 0 END AS has_paid_more,
       CASE WHEN payment_plan_days = 0 THEN actual_amount_paid
            ELSE actual_amount_paid / payment_plan_days END AS paid_per_day
FROM paid_rows""",
        "method_rank": """
SELECT msno, payment_method_id, row_number() OVER (PARTITION BY msno ORDER BY n DESC, payment_method_id) AS place
FROM (SELECT msno, payment_method_id, count(*) AS n FROM paid
      WHERE payment_method_id IS NOT NULL GROUP BY ALL)""",
        "paid_totals": """
SELECT msno, avg(payment_plan_days) AS payment_plan_days_mean, avg(plan_list_price) AS plan_list_price_mean,
       avg(actual_amount_paid) AS actual_amount_paid_mean,
       CAST(sum(has_paid_less) AS BIGINT) AS amount_paid_less,
       CAST(sum(has_paid_more) AS BIGINT) AS amount_paid_more,
       CAST(coalesce(sum(is_cancel), 0) AS BIGINT) AS amount_cancels,
       avg(paid_per_day) AS mean_paid_per_day, count(DISTINCT paid_day) AS amount_transactions,
       CAST(coalesce(sum(is_auto_renew), 0) AS BIGINT) AS total_autorenew,
       min(paid_day) AS first_transaction, max(paid_day) AS last_transaction
FROM paid GROUP BY msno""",
        "transaction_features": """
SELECT paid_totals.*, payment_method_id AS most_freq_payment_method,
       total_autorenew / nullif(amount_transactions, 0) AS percent_of_autorenew
FROM paid_totals LEFT JOIN (SELECT * FROM method_rank WHERE place = 1) USING (msno)""",
    }


def log_steps(split: str = "train") -> dict[str, str]:
    measures = ", ".join(LOG_MEASURES)
    clipped = ", ".join(f"CASE WHEN {m} < 0 THEN 0 ELSE {m} END AS {m}" for m in LOG_MEASURES)
    known = " AND ".join(f"{m} IS NOT NULL" for m in ["date", *LOG_MEASURES])
    sums = ", ".join(f"{_sum(m)} AS {m}_sum" for m in MEAN_MEASURES)
    means = ", ".join(f"avg({m}) AS {m}_mean" for m in MEAN_MEASURES)
    monthly_means = ", ".join(f"avg({m}) AS {m}_mean_monthly" for m in MEAN_MEASURES)
    monthly_sums = ", ".join(f"{_sum(m)} AS {m}_sum_monthly" for m in LOG_MEASURES)
    pivot = [
        f"max(CASE WHEN month_rank = {r} THEN {m}_mean_monthly END) AS {m}_mean_monthly_{r}"
        for m in MEAN_MEASURES
        for r in (1, 2, 3)
    ] + [
        f"coalesce(max(CASE WHEN month_rank = {r} THEN {m}_sum_monthly END), 0) AS {m}_sum_monthly_{r}"
        for m in LOG_MEASURES
        for r in (1, 2, 3)
    ]
    return {
        "label": retail.DUCKDB_VIEWS[split],
        "user_logs": retail.DUCKDB_VIEWS["user_logs"],
        "log_rows": f"SELECT DISTINCT msno, date, {measures} FROM label JOIN user_logs USING (msno) WHERE {known}",
        "clean_logs": f"""
SELECT msno, date, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, {clipped},
       coalesce(date_diff('day', lag(date) OVER (PARTITION BY msno ORDER BY date, {measures}), date), 0)
         AS {DAY_GAP}
FROM log_rows""",
        "log_totals": f"""
SELECT msno, {means}, {sums}, min(date) AS first_login, max(date) AS last_login, count(*) AS amount_of_logins
FROM clean_logs GROUP BY msno""",
        "log_months": f"""
SELECT msno, year, month, CAST(row_number() OVER (PARTITION BY msno ORDER BY year DESC, month DESC) AS INT) AS month_rank,
       {monthly_means}, {monthly_sums}
FROM clean_logs GROUP BY msno, year, month""",
        "log_pivot": f"SELECT msno, {', '.join(pivot)} FROM log_months WHERE month_rank < 4 GROUP BY msno",
        "log_features": "SELECT * FROM log_totals JOIN log_pivot USING (msno)",
    }


def _sum(measure: str) -> str:
    return f"sum({measure})" if measure == "total_secs" else f"CAST(sum({measure}) AS BIGINT)"


def total_columns() -> dict[str, list[str]]:
    return {
        "double": [*[f"{m}_mean" for m in MEAN_MEASURES], "total_secs_sum"],
        "other": [f"{m}_sum" for m in MEAN_MEASURES if m != "total_secs"],
    }


def pivot_columns() -> dict[str, list[str]]:
    ranks = (1, 2, 3)
    return {
        "double": [f"{m}_mean_monthly_{r}" for m in MEAN_MEASURES for r in ranks]
        + [f"total_secs_sum_monthly_{r}" for r in ranks],
        "other": [f"{m}_sum_monthly_{r}" for m in LOG_MEASURES if m != "total_secs" for r in ranks],
    }


GAP_DAYS = {
    "diff_first_last_transaction": ("first_transaction", "last_transaction"),
    "diff_max_min_log": ("last_login", "first_login"),
    "diff_first_log_registration": ("first_login", "registration_init_time"),
    "days_since_last_transaction": ("TIMESTAMP '2017-03-31'", "last_transaction"),
    "days_since_registration": ("TIMESTAMP '2017-03-31'", "registration_init_time"),
    "diff_days_last_login_last_transaction": ("first_login", "last_transaction"),
    "days_since_last_login": ("TIMESTAMP '2017-03-31'", "last_login"),
}
ONE_HOT_DOMAIN = {
    "registered_via": range(0, 7),
    "city": range(0, 25),
    "registration_init_time_year": range(2010, 2018),
    "registration_init_time_month": range(1, 13),
}


def final_steps(split: str = "train") -> dict[str, str]:
    gaps = ", ".join(
        f"CAST(floor((epoch_us(CAST({a} AS TIMESTAMP)) - epoch_us(CAST({b} AS TIMESTAMP))) / 86400000000.0) AS BIGINT)"
        f" AS {name}"
        for name, (a, b) in GAP_DAYS.items()
    )
    block = ", ".join(f"CASE WHEN {c} = {v} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {c}_{v}" for c, vs in ONE_HOT_DOMAIN.items() for v in vs)
    return {
        **member_steps(split),
        **transaction_steps(split),
        **log_steps(split),
        "joined": """
SELECT * FROM member_features LEFT JOIN transaction_features USING (msno) LEFT JOIN log_features USING (msno)""",
        "gaps": f"""
SELECT *, {gaps}, CASE WHEN amount_of_logins > 5 THEN 0 ELSE 1 END AS rare_user,
       year(registration_init_time) AS registration_init_time_year,
       month(registration_init_time) AS registration_init_time_month
FROM joined""",
        "final": f"""
SELECT * EXCLUDE (registered_via, city, registration_init_time_year, registration_init_time_month,
                  last_login, first_login, registration_init_time, first_transaction, last_transaction),
       {block}
FROM gaps""",
    }
