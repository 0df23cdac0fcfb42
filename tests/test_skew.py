"""A member with half of all rows, and a row copied thousands of times, against plain pandas."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from refrain.operators import cleaning, profiles
from refrain.plans import features

MEASURES = profiles.LOG_MEASURES


@pytest.fixture(scope="module")
def hot_logs(spark):
    share = F.pmod(F.xxhash64("id"), F.lit(1000))
    rows = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("m"), (share % 40).cast("string"))).alias("msno"),
        F.date_add(F.lit("2016-01-05").cast("date"), (share % 200).cast("int")).alias("date"),
        *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(50)) - 3).cast("int").alias(m) for i, m in enumerate(MEASURES[:-1])],
        (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(100000)) / 100 - 50).alias("total_secs"),
    )
    copied = rows.filter("msno = 'hot'").orderBy("date", *MEASURES).limit(1)
    return rows.unionByName(copied.select("*", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("col"))


def by_pandas(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.dropna().drop_duplicates().copy()
    pdf["date"] = pd.to_datetime(pdf["date"])
    pdf = pdf.sort_values(["msno", "date"])
    pdf["days_between_logins"] = pdf.groupby("msno")["date"].diff().dt.days.fillna(0)
    names = [*MEASURES, "days_between_logins"]
    pdf[names] = pdf[names].clip(lower=0)
    groups = pdf.groupby("msno")[names]
    month = pdf["date"].dt.to_period("M")
    newest = pdf[month == pdf.groupby("msno")["date"].transform("max").dt.to_period("M")].groupby("msno")[names]
    return pd.concat(
        [
            groups.mean().add_suffix("_mean"),
            groups.sum().add_suffix("_sum"),
            newest.mean().add_suffix("_mean_monthly_1"),
            groups.size().rename("amount_of_logins"),
        ],
        axis=1,
    )


def test_log_profile_with_a_hot_member(hot_logs):
    expected = by_pandas(hot_logs.toPandas())
    got = features.profile_logs(hot_logs).toPandas().set_index("msno").loc[expected.index, list(expected.columns)]
    pd.testing.assert_frame_equal(got.astype(float), expected.astype(float), rtol=1e-9, check_index_type=False)


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_states_of_any_split_merge_to_the_same(hot_logs, parts):
    rows = cleaning.clean_log_rows(hot_logs)
    whole = profiles.log_profile(profiles.rank_months(profiles.month_states(rows)))
    split = rows.withColumn("part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)))
    merged = profiles.merge_states(profiles.month_states(split, "part"))
    again = profiles.log_profile(profiles.rank_months(merged))
    # Sums of seconds depend on the order of addition in the last bits only.
    exact = [c for c in whole.columns if "total_secs" not in c]
    assert whole.select(exact).exceptAll(again.select(exact)).count() == 0


def test_no_task_of_the_member_shuffle_sees_raw_rows(hot_logs):
    """What meets per member is one state per month: at most seven of them here."""
    states = profiles.month_states(cleaning.clean_log_rows(hot_logs))
    most = states.groupBy("msno").count().agg(F.max("count")).first()[0]
    assert most <= 7 and hot_logs.filter("msno = 'hot'").count() > 10000


def test_transaction_profile_with_a_hot_member(spark):
    """Half of the payments are one member's, copies and days that do not parse among them."""
    share = F.pmod(F.xxhash64("id"), F.lit(500)).cast("int")
    rows = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(1 + share % 30).alias("msno"),
        F.when(share % 9 > 0, share % 4).alias("payment_method_id"),
        F.when(share % 11 > 0, share % 31).alias("payment_plan_days"),
        F.when(share % 13 > 0, share / 4).alias("plan_list_price"),
        (share / 5).alias("actual_amount_paid"),
        (share % 2).alias("is_auto_renew"),
        F.when(share % 17 == 0, 20171345).otherwise(20170101 + share % 28).alias("transaction_date"),
        F.lit(20170301).alias("membership_expire_date"),
        (share % 3 % 2).alias("is_cancel"),
    )
    rows = rows.unionByName(rows.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("col"))
    pdf = rows.toPandas().drop_duplicates()
    pdf["day"] = pd.to_datetime(pdf["transaction_date"], format="%Y%m%d", errors="coerce")
    groups = pdf.groupby("msno")
    counts = pdf.dropna(subset="payment_method_id").groupby(["msno", "payment_method_id"]).size().rename("n").reset_index()
    best = counts.sort_values(["n", "payment_method_id"], ascending=[False, True]).groupby("msno")["payment_method_id"].first()
    expected = pd.concat(
        [
            groups["payment_plan_days"].mean().rename("payment_plan_days_mean"),
            groups["plan_list_price"].mean().rename("plan_list_price_mean"),
            groups["actual_amount_paid"].mean().rename("actual_amount_paid_mean"),
            best.rename("most_freq_payment_method"),
            groups["is_cancel"].sum().rename("amount_cancels"),
            groups["is_auto_renew"].sum().rename("total_autorenew"),
            groups["day"].nunique().rename("amount_transactions"),
        ],
        axis=1,
    )
    got = features.profile_transactions(rows).toPandas().set_index("msno")
    pd.testing.assert_frame_equal(
        got.loc[expected.index, list(expected.columns)].astype(float), expected.astype(float), rtol=1e-9, check_index_type=False
    )
    assert (got["first_transaction"].loc[expected.index].dt.date == groups["day"].min().dt.date).all()
    assert (got["last_transaction"].loc[expected.index].dt.date == groups["day"].max().dt.date).all()
