"""Shape of the plans: no Python, no single-task window, no cross product, columns pruned."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from refrain.catalog.common import inputs
from refrain.plans import features

FEATURES = ["tx_profile", "members_features", "logs_profile", "partial_merge", "final_dataset", "log_day_gap"]
EXPLORE = ["freq_table", "describe", "describe_transactions", "correlation", "density", "crosstab_churn", "roc_auc"]


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", FEATURES + EXPLORE)
def test_plan_is_distributed(spark, small_folder, name):
    plan = plan_of(entry.queries()[name](spark, small_folder))
    for word in ("PythonUDF", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    for window in re.findall(r"windowspecdefinition\((.*?)\)", plan):
        assert not re.match(r"[\w#]+ (ASC|DESC)", window)  # partitioned before it is ordered


def test_profile_never_shuffles_raw_rows_by_member(spark, small_folder):
    """Raw payments are shuffled by the whole row; only pre-aggregated states go by member."""
    plan = plan_of(features.transaction_features(inputs(spark, small_folder), "train"))
    keys = re.findall(r"hashpartitioning\((.*?), \d+\)", plan)
    raw = [k for k in keys if "membership_expire_date" in k]
    assert raw and all("plan_list_price" in k and "msno" in k for k in raw)


def test_scans_read_only_needed_columns(spark, small_folder):
    plan = plan_of(features.member_features(inputs(spark, small_folder), "train"))
    assert "c_name" not in plan


def test_members_are_read_once_for_the_rows_and_once_for_their_means(spark, small_folder):
    tables = inputs(spark, small_folder)
    plan = plan_of(features.member_features(tables, "train"))
    scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\nOutput \[\d+\]: \[([^\]]*)\]", plan)
    assert len(set(scans)) == 4  # labels and members for the rows, and again for the two means, whose subquery is shared


def test_without_broadcast_results_are_the_same(spark, small_folder):
    query = entry.queries()["final_dataset"]
    expected = sorted(map(str, query(spark, small_folder).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, query(spark, small_folder).collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_payments_are_not_doubled_for_their_two_groupings(spark, small_folder):
    """Days and methods are counted from the same distinct rows, which go on by member and part of the days."""
    plan = plan_of(features.transaction_features(inputs(spark, small_folder), "train"))
    assert "Expand" not in plan
    keys = re.findall(r"hashpartitioning\((.*?), \d+\)", plan)
    assert any(re.fullmatch(r"msno#\d+L?, part#\d+L?", k) for k in keys)
