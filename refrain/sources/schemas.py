"""Declared schemas of the four raw tables; nothing is ever inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

LABEL = T.StructType(
    [
        T.StructField("msno", T.StringType()),
        T.StructField("is_churn", T.IntegerType()),
    ]
)

SUBMISSION = T.StructType(
    [
        T.StructField("msno", T.StringType()),
        T.StructField("is_churn", T.DoubleType()),
    ]
)

MEMBERS = T.StructType(
    [
        T.StructField("msno", T.StringType()),
        T.StructField("city", T.IntegerType()),
        T.StructField("bd", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("registered_via", T.IntegerType()),
        T.StructField("registration_init_time", T.IntegerType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("msno", T.StringType()),
        T.StructField("payment_method_id", T.IntegerType()),
        T.StructField("payment_plan_days", T.IntegerType()),
        T.StructField("plan_list_price", T.DoubleType()),
        T.StructField("actual_amount_paid", T.DoubleType()),
        T.StructField("is_auto_renew", T.IntegerType()),
        T.StructField("transaction_date", T.IntegerType()),
        T.StructField("membership_expire_date", T.IntegerType()),
        T.StructField("is_cancel", T.IntegerType()),
    ]
)

USER_LOGS = T.StructType(
    [
        T.StructField("msno", T.StringType()),
        T.StructField("date", T.IntegerType()),
        T.StructField("num_25", T.IntegerType()),
        T.StructField("num_50", T.IntegerType()),
        T.StructField("num_75", T.IntegerType()),
        T.StructField("num_985", T.IntegerType()),
        T.StructField("num_100", T.IntegerType()),
        T.StructField("num_unq", T.IntegerType()),
        T.StructField("total_secs", T.DoubleType()),
    ]
)

# The seven listening measures of a daily log row, in their file order.
LOG_MEASURES = ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs"]
DAY_GAP = "days_between_logins"
