"""Catalog: sources, sinks, row rules, joins, duplicates and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.catalog.common import (
    GAP_DAYS,
    Query,
    final_steps,
    inputs,
    log_steps,
    member_steps,
    moment_text,
    rounded,
    rounded_columns,
    settle,
    transaction_steps,
    with_steps,
)
from refrain.functions import columns as C
from refrain.operators import cleaning, joins, profiles
from refrain.plans import features
from refrain.sources import files, retail, schemas
from refrain.sources.schemas import DAY_GAP, LOG_MEASURES
from refrain.sources.storage import fresh_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
VIEWS = retail.DUCKDB_VIEWS
MEASURES = ", ".join(LOG_MEASURES)
LOGS_WITH_TEXT_DATE = f"msno, strftime(date, '%Y-%m-%d') AS date, {rounded_columns(['total_secs'])}, " + ", ".join(
    LOG_MEASURES[:-1]
)


def query(name: str, sql: str | None = None):
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def paid_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct transaction rows of the training members with their derived columns."""
    tables = inputs(spark, folder)
    joined = joins.left_join_facts(tables.label("train"), tables.transactions)
    return cleaning.with_transaction_columns(cleaning.drop_duplicate_rows(joined))


# Sources and sinks


@query(
    "csv_roundtrip",
    with_steps(
        {"transactions": VIEWS["whole_transactions"]},
        f"""
SELECT msno, payment_method_id, payment_plan_days, {rounded_columns(['plan_list_price', 'actual_amount_paid'])},
       is_auto_renew, transaction_date, membership_expire_date, is_cancel FROM transactions""",
    ),
)
def csv_roundtrip(spark, folder):
    path = fresh_path(spark, "transactions-csv")
    files.write_csv(retail.transactions(spark, folder), path)
    back = files.read_csv(spark, path, schemas.TRANSACTIONS)
    return settle(back.withColumn("msno", F.col("msno").cast("bigint")))


# The log file of the checked loads: rows as lines, some of them damaged by what they hold.
DAMAGE = {"not 9 fields": "num_unq = 29", "no int in num_100": "num_100 = 39", "no such day in date": "num_25 = -2"}


def _loaded_logs(spark: SparkSession, folder: str) -> files.CheckedRows:
    """The logs written as CSV lines, damaged where ``DAMAGE`` says, and loaded with their rejects set aside."""
    path = fresh_path(spark, "logs-lines")
    extra, no_number, no_day = DAMAGE.values()
    cells = {c: F.col(c).cast("string") for c in LOG_MEASURES}
    day = F.when(F.expr(no_day), "20170231").otherwise(F.date_format("date", "yyyyMMdd"))
    cells["num_100"] = F.when(F.expr(no_number), "many").otherwise(cells["num_100"])
    texts = [F.coalesce(c, F.lit("")) for c in (F.col("msno").cast("string"), day, *cells.values())]
    line = F.concat(F.concat_ws(",", *texts), F.when(F.expr(extra), ",more").otherwise(""))
    lines = retail.user_logs(spark, folder).select(line.alias(",".join(schemas.USER_LOGS.names)))
    # One column named like the header, written without quotes: a text file with a header line in each part.
    lines.write.options(header=True, quote="", sep="\t").csv(path)
    return files.load_csv(spark, path, schemas.USER_LOGS, fresh_path(spark, "logs"), days=("date",))


@query(
    "logs_csv",
    with_steps(
        {"user_logs": VIEWS["user_logs"]},
        f"SELECT {LOGS_WITH_TEXT_DATE} FROM user_logs WHERE NOT (" + " OR ".join(DAMAGE.values()) + ")",
    ),
)
def logs_csv(spark, folder):
    """Log rows from CSV files with bad lines: those that fit, dates parsed."""
    rows = _loaded_logs(spark, folder).rows
    return settle(rows.withColumn("msno", F.col("msno").cast("bigint")))


@query(
    "logs_csv_rejects",
    with_steps(
        {"user_logs": VIEWS["user_logs"]},
        "SELECT CASE "
        + " ".join(f"WHEN {rule} THEN '{reason}'" for reason, rule in DAMAGE.items())
        + " END AS reason, count(*) AS lines FROM user_logs WHERE "
        + " OR ".join(DAMAGE.values())
        + " GROUP BY reason",
    ),
)
def logs_csv_rejects(spark, folder):
    """The lines of the same files that do not fit, counted by reason."""
    return _loaded_logs(spark, folder).rejects.groupBy("reason").agg(F.count("*").alias("lines"))


@query("parquet_roundtrip", with_steps({"user_logs": VIEWS["user_logs"]}, f"SELECT {LOGS_WITH_TEXT_DATE} FROM user_logs"))
def parquet_roundtrip(spark, folder):
    """Writes the logs as a folder of chunk files by month, and reads the folder as one table."""
    path = fresh_path(spark, "logs-chunks")
    logs = retail.user_logs(spark, folder)
    months = logs.withColumn("chunk", F.date_format("date", "yyyyMM"))
    files.write_parquet(months, path, partition_by=("chunk",))
    return settle(files.read_parquet(spark, path).select(*logs.columns))


@query(
    "label_source",
    with_steps(
        {"train": VIEWS["train"], "test": VIEWS["test"]},
        "SELECT *, 'train' AS split FROM train UNION ALL SELECT *, 'test' AS split FROM test",
    ),
)
def label_source(spark, folder):
    labels = retail.labels(spark, folder)
    picked = [files.label_source(labels, s).withColumn("split", F.lit(s)) for s in files.SPLITS]
    return joins.union_by_name(*picked)


@query(
    "limit_n",
    with_steps(
        {"user_logs": VIEWS["user_logs"]},
        f"SELECT {LOGS_WITH_TEXT_DATE} FROM (SELECT * FROM user_logs ORDER BY msno, date, "
        + ", ".join(f"{m} NULLS FIRST" for m in LOG_MEASURES)
        + " LIMIT 500)",
    ),
)
def limit_n(spark, folder):
    return settle(files.first_rows(retail.user_logs(spark, folder), 500, "msno", "date", *LOG_MEASURES))


@query(
    "date_parse",
    with_steps(
        {"transactions": VIEWS["whole_transactions"]},
        f"""
SELECT msno, transaction_date, {moment_text("try_strptime(CAST(transaction_date AS VARCHAR), '%Y%m%d')")} AS paid_on,
       {moment_text("try_strptime(CAST(membership_expire_date AS VARCHAR), '%Y%m%d')")} AS expires_on
FROM transactions""",
    ),
)
def date_parse(spark, folder):
    rows = retail.transactions(spark, folder)
    return settle(
        rows.select(
            "msno",
            "transaction_date",
            C.parse_day(F.col("transaction_date")).alias("paid_on"),
            C.parse_day(F.col("membership_expire_date")).alias("expires_on"),
        )
    )


@query(
    "date_format_text",
    with_steps(
        {"transactions": VIEWS["whole_transactions"]},
        """
SELECT msno, substr(CAST(transaction_date AS VARCHAR), 1, 4) || '-' || substr(CAST(transaction_date AS VARCHAR), 5, 2)
         || '-' || substr(CAST(transaction_date AS VARCHAR), 7) AS paid_on,
       substr(CAST(membership_expire_date AS VARCHAR), 1, 4) || '-'
         || substr(CAST(membership_expire_date AS VARCHAR), 5, 2) || '-'
         || substr(CAST(membership_expire_date AS VARCHAR), 7) AS expires_on
FROM transactions""",
    ),
)
def date_format_text(spark, folder):
    return retail.transactions(spark, folder).select(
        "msno",
        C.day_text(F.col("transaction_date")).alias("paid_on"),
        C.day_text(F.col("membership_expire_date")).alias("expires_on"),
    )


# Transaction row rules


@query(
    "tx_price_flags",
    with_steps(
        transaction_steps(),
        f"""
SELECT msno, {rounded('difference')} AS diff_planned_paid, has_paid_less, has_paid_more FROM paid""",
    ),
)
def tx_price_flags(spark, folder):
    return settle(paid_rows(spark, folder).select("msno", "diff_planned_paid", "has_paid_less", "has_paid_more"))


@query(
    "tx_paid_per_day",
    with_steps(transaction_steps(), f"SELECT msno, payment_plan_days, {rounded_columns(['paid_per_day'])} FROM paid"),
)
def tx_paid_per_day(spark, folder):
    return settle(paid_rows(spark, folder).select("msno", "payment_plan_days", "paid_per_day"))


@query(
    "tx_autorenew_ratio",
    with_steps(
        transaction_steps(),
        f"""
SELECT msno, total_autorenew, amount_transactions, {rounded_columns(['percent_of_autorenew'])}
FROM transaction_features""",
    ),
)
def tx_autorenew_ratio(spark, folder):
    profile = features.transaction_features(inputs(spark, folder), "train")
    return settle(profile.select("msno", "total_autorenew", "amount_transactions", "percent_of_autorenew"))


@query(
    "tx_dedup",
    with_steps(
        transaction_steps(),
        f"""
SELECT msno, is_churn, payment_method_id, payment_plan_days,
       {rounded_columns(['plan_list_price', 'actual_amount_paid'])},
       is_auto_renew, transaction_date, membership_expire_date, is_cancel FROM paid_rows""",
    ),
)
def tx_dedup(spark, folder):
    tables = inputs(spark, folder)
    return settle(cleaning.drop_duplicate_rows(joins.left_join_facts(tables.label("train"), tables.transactions)))


# Member row rules


def _members(spark, folder, *names):
    return settle(features.member_features(inputs(spark, folder), "train").select("msno", *names))


@query("age_clean", with_steps(member_steps(), f"SELECT msno, {rounded_columns(['bd'])} FROM member_features"))
def age_clean(spark, folder):
    return _members(spark, folder, "bd")


@query("member_fill_zero", with_steps(member_steps(), "SELECT msno, city, registered_via FROM member_features"))
def member_fill_zero(spark, folder):
    return _members(spark, folder, "city", "registered_via")


@query(
    "registration_clean",
    with_steps(
        member_steps(),
        f"SELECT msno, {moment_text('registration_init_time')} AS registration_init_time FROM member_features",
    ),
)
def registration_clean(spark, folder):
    return _members(spark, folder, "registration_init_time")


@query(
    "date_parts",
    with_steps(
        member_steps(),
        """
SELECT msno, CAST(year(day) AS INT) AS year, CAST(month(day) AS INT) AS month, CAST(day(day) AS INT) AS day,
       dayname(day) AS weekday FROM member_known""",
    ),
)
def date_parts(spark, folder):
    tables = inputs(spark, folder)
    moment = C.parse_day(F.col("registration_init_time"))
    return joins.left_join_profiles(tables.label("train"), tables.members).select(
        "msno",
        F.year(moment).alias("year"),
        F.month(moment).alias("month"),
        F.dayofmonth(moment).alias("day"),
        F.date_format(moment, "EEEE").alias("weekday"),
    )


@query(
    "gender_code",
    with_steps(
        member_steps(),
        "SELECT msno, gender, CASE WHEN gender = 'male' THEN 0 ELSE 1 END AS gender_number FROM label_members",
    ),
)
def gender_code(spark, folder):
    tables = inputs(spark, folder)
    joined = joins.left_join_profiles(tables.label("train"), tables.members)
    return joined.select("msno", "gender", C.gender_code(F.col("gender")).alias("gender_number"))


@query("left_join_members", with_steps(member_steps(), "SELECT * FROM label_members"))
def left_join_members(spark, folder):
    tables = inputs(spark, folder)
    return joins.left_join_profiles(tables.label("train"), tables.members)


# Log row rules


@query(
    "log_clean",
    with_steps(
        log_steps(),
        f"SELECT msno, strftime(date, '%Y-%m-%d') AS date, {', '.join(LOG_MEASURES[:-1])}, "
        f"{rounded_columns(['total_secs'])} FROM clean_logs",
    ),
)
def log_clean(spark, folder):
    return settle(features.clean_logs(inputs(spark, folder), "train"))


@query(
    "log_day_gap",
    with_steps(
        log_steps(),
        f"SELECT c.msno, strftime(c.date, '%Y-%m-%d') AS date, CAST({DAY_GAP} AS INT) AS {DAY_GAP} FROM clean_logs c",
    ),
)
def log_day_gap(spark, folder):
    tables = inputs(spark, folder)

    def gaps(logs: DataFrame) -> DataFrame:
        return cleaning.with_day_gap(cleaning.drop_duplicate_rows(logs.dropna("any")))

    return settle(joins.over_members(tables.user_logs, tables.label("train"), gaps).select("msno", "date", DAY_GAP))


@query(
    "member_history",
    with_steps(
        {"train": VIEWS["train"], "transactions": VIEWS["transactions"]},
        f"""
SELECT msno, transaction_date, payment_method_id, {rounded_columns(['actual_amount_paid'])}
FROM train JOIN transactions USING (msno) WHERE payment_plan_days = 30
ORDER BY msno, transaction_date DESC, payment_method_id, actual_amount_paid""",
    ),
)
def member_history(spark, folder):
    """Rows with one plan length, each member's newest payment first."""
    tables = inputs(spark, folder)
    rows = joins.left_join_facts(tables.label("train"), tables.transactions).filter(F.col("payment_plan_days") == 30)
    picked = rows.select("msno", "transaction_date", "payment_method_id", "actual_amount_paid")
    return settle(picked).orderBy("msno", F.desc("transaction_date"), "payment_method_id", "actual_amount_paid")


@query(
    "dedup_keep_last",
    with_steps(
        {"transactions": VIEWS["whole_transactions"]},
        f"""
SELECT msno, transaction_date, payment_method_id, {rounded_columns(['plan_list_price'])}
FROM (SELECT *, row_number() OVER (PARTITION BY msno ORDER BY transaction_date, payment_method_id, plan_list_price) AS place
      FROM transactions) WHERE place = 1""",
    ),
)
def dedup_keep_last(spark, folder):
    rows = retail.transactions(spark, folder).select("msno", "transaction_date", "payment_method_id", "plan_list_price")
    return settle(cleaning.keep_last(rows, "msno", "transaction_date"))


@query(
    "union_by_name",
    with_steps(
        {"train": VIEWS["train"], "members": VIEWS["whole_members"]},
        """
SELECT msno, is_churn, NULL::INT AS city, NULL::VARCHAR AS gender FROM train
UNION ALL SELECT msno, NULL AS is_churn, city, gender FROM members""",
    ),
)
def union_by_name(spark, folder):
    tables = inputs(spark, folder)
    members = retail.members(spark, folder)
    return joins.union_by_name(tables.label("train"), members.select("gender", "city", "msno"))


# Rules over the joined member table


@query(
    "date_gaps",
    with_steps(final_steps(), f"SELECT msno, {', '.join(GAP_DAYS)} FROM gaps"),
)
def date_gaps(spark, folder):
    joined = features.joined_features(inputs(spark, folder), "train")
    return features.with_date_gaps(joined).select("msno", *GAP_DAYS)


@query("rare_user", with_steps(final_steps(), "SELECT msno, amount_of_logins, rare_user FROM gaps"))
def rare_user(spark, folder):
    tables = inputs(spark, folder)
    logins = features.log_features(tables, "train").select("msno", "amount_of_logins")
    joined = joins.left_join_profiles(tables.label("train"), logins)
    return joined.select("msno", "amount_of_logins", C.rare_flag(F.col("amount_of_logins")).alias("rare_user"))


@query(
    "fill_sentinel",
    with_steps(
        transaction_steps(),
        "SELECT msno, "
        + ", ".join(
            f"{rounded(f'coalesce({c}, -99.0)', 4)} AS {c}"
            for c in profiles.TRANSACTION_PROFILE
            if c not in ("first_transaction", "last_transaction")
        )
        + " FROM transaction_features",
    ),
)
def fill_sentinel(spark, folder):
    profile = features.transaction_features(inputs(spark, folder), "train")
    names = [c for c in profiles.TRANSACTION_PROFILE if c not in ("first_transaction", "last_transaction")]
    typed = profile.select("msno", *[F.col(c).cast("double").alias(c) for c in names])
    return settle(cleaning.fill_sentinel(typed, names), 4)
