"""The five churn inputs, derived from an order-and-event star schema stored as parquet.

Each function is one lazy projection of the given tables, so its size follows theirs.
``DUCKDB_VIEWS`` states the same tables as SQL, for checking results in another engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _yyyymmdd(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def _repeat_when(df: DataFrame, condition: Column) -> DataFrame:
    """Every row once, and twice where the condition holds, in a single pass."""
    copies = F.sequence(F.lit(1), F.when(condition, 2).otherwise(1))
    return df.select("*", F.explode(copies).alias("copy")).drop("copy")


def labels(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    customer = _table(spark, folder, "customer")
    key = F.col("c_custkey")
    churned = F.when(F.col("c_acctbal") < 0, 1).otherwise(0)
    return {
        "train": customer.filter(key % 5 != 0).select(key.alias("msno"), churned.alias("is_churn")),
        "test": customer.filter(key % 5 == 0).select(key.alias("msno"), F.lit(0).alias("is_churn")),
    }


def members(spark: SparkSession, folder: str, whole: bool = True) -> DataFrame:
    """One row per customer; without ``whole``, some labels find no member, as a left join needs."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    registered = F.date_add(F.lit("2010-01-01").cast("date"), ((key * 7) % 2700).cast("int"))
    return (
        _table(spark, folder, "customer")
        .filter(F.lit(whole) | (key % 11 != 3))
        .select(
            key.alias("msno"),
            F.col("c_nationkey").alias("city"),
            F.floor(F.col("c_acctbal") / 100).cast("int").alias("bd"),
            F.when(segment == "BUILDING", "male").when(segment == "MACHINERY", "female").alias("gender"),
            F.when(key % 7 > 0, (key % 7).cast("int")).alias("registered_via"),
            _yyyymmdd(registered).alias("registration_init_time"),
        )
    )


def transactions(spark: SparkSession, folder: str, whole: bool = True) -> DataFrame:
    """One row per order line, some twice; without ``whole``, some labels have none."""
    item = _table(spark, folder, "lineitem")
    order = _table(spark, folder, "orders").filter(F.lit(whole) | (F.col("o_custkey") % 17 != 4))
    paid = (
        F.round(F.col("l_extendedprice") * 100)
        * (100 - F.round(F.col("l_discount") * 100))
        * (100 + F.round(F.col("l_tax") * 100))
    )
    bad_day = (F.col("l_orderkey") % 13 == 0) & (F.col("l_linenumber") == 7)
    rows = item.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    return _repeat_when(rows, F.col("l_orderkey") % 40 == 0).select(
        F.col("o_custkey").alias("msno"),
        F.col("l_linenumber").alias("payment_method_id"),
        (F.col("l_quantity").cast("int") % 31).alias("payment_plan_days"),
        F.round("l_extendedprice", 2).alias("plan_list_price"),
        (F.floor(paid / 1e4) / 1e2).alias("actual_amount_paid"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("is_auto_renew"),
        F.when(bad_day, 20171345).otherwise(_yyyymmdd(F.col("l_shipdate"))).alias("transaction_date"),
        _yyyymmdd(F.col("o_orderdate")).alias("membership_expire_date"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_cancel"),
    )


def user_logs(spark: SparkSession, folder: str) -> DataFrame:
    event, units = F.col("event_id"), F.floor("value").cast("int")
    rows = _repeat_when(_table(spark, folder, "events"), event % 50 == 0)
    return rows.select(
        F.col("user_id").alias("msno"),
        F.date_add(F.lit("2016-10-01").cast("date"), ((event * 13) % 150).cast("int")).alias("date"),
        (units % 20 - 2).alias("num_25"),
        F.when(event % 97 != 0, units % 10).alias("num_50"),
        (units % 7).alias("num_75"),
        (units % 5).alias("num_985"),
        (units % 40).alias("num_100"),
        (units % 30).alias("num_unq"),
        F.round(F.col("value") - 20, 2).alias("total_secs"),
    )


DUCKDB_VIEWS = {
    "train": """
SELECT c_custkey AS msno, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS is_churn
FROM customer WHERE c_custkey % 5 <> 0""",
    "test": """
SELECT c_custkey AS msno, 0 AS is_churn FROM customer WHERE c_custkey % 5 = 0""",
    "members": """
SELECT msno, city, bd, gender, registered_via,
       CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS registration_init_time
FROM (SELECT c_custkey AS msno, c_nationkey AS city,
             CAST(floor(c_acctbal / 100) AS INT) AS bd,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'male' WHEN 'MACHINERY' THEN 'female' END AS gender,
             CASE WHEN c_custkey % 7 > 0 THEN CAST(c_custkey % 7 AS INT) END AS registered_via,
             DATE '2010-01-01' + CAST((c_custkey * 7) % 2700 AS INT) AS d
      FROM customer WHERE c_custkey % 11 <> 3) m""",
    "transactions": """
WITH t AS (
  SELECT o_custkey AS msno, l_linenumber AS payment_method_id,
         CAST(l_quantity AS INT) % 31 AS payment_plan_days,
         round(l_extendedprice, 2) AS plan_list_price,
         floor(round(l_extendedprice * 100) * (100 - round(l_discount * 100)) * (100 + round(l_tax * 100)) / 1e4) / 1e2 AS actual_amount_paid,
         CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_auto_renew,
         CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 7 THEN 20171345
              ELSE CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT) END AS transaction_date,
         CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INT) AS membership_expire_date,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_cancel, l_orderkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 17 <> 4)
SELECT msno, payment_method_id, payment_plan_days, plan_list_price, actual_amount_paid,
       is_auto_renew, transaction_date, membership_expire_date, is_cancel FROM t
UNION ALL
SELECT msno, payment_method_id, payment_plan_days, plan_list_price, actual_amount_paid,
       is_auto_renew, transaction_date, membership_expire_date, is_cancel FROM t WHERE l_orderkey % 40 = 0""",
    "user_logs": """
WITH l AS (
  SELECT event_id, user_id AS msno, DATE '2016-10-01' + CAST((event_id * 13) % 150 AS INT) AS date,
         CAST(floor(value) AS INT) % 20 - 2 AS num_25,
         CASE WHEN event_id % 97 <> 0 THEN CAST(floor(value) AS INT) % 10 END AS num_50,
         CAST(floor(value) AS INT) % 7 AS num_75, CAST(floor(value) AS INT) % 5 AS num_985,
         CAST(floor(value) AS INT) % 40 AS num_100, CAST(floor(value) AS INT) % 30 AS num_unq,
         round(value - 20, 2) AS total_secs
  FROM events)
SELECT msno, date, num_25, num_50, num_75, num_985, num_100, num_unq, total_secs FROM l
UNION ALL
SELECT msno, date, num_25, num_50, num_75, num_985, num_100, num_unq, total_secs FROM l WHERE event_id % 50 = 0""",
}
DUCKDB_VIEWS |= {
    "whole_members": DUCKDB_VIEWS["members"].replace("WHERE c_custkey % 11 <> 3", ""),
    "whole_transactions": DUCKDB_VIEWS["transactions"].replace("WHERE o_custkey % 17 <> 4", ""),
}
