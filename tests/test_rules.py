"""Literal rows, one behaviour each."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from refrain.functions import columns as C
from refrain.operators import cleaning, explore, joins, onehot, ordering, profiles
from refrain.plans import features
from refrain.sources import files, schemas

PAID = (
    "msno string, payment_method_id int, payment_plan_days int, plan_list_price double, actual_amount_paid double,"
    " is_auto_renew int, transaction_date int, membership_expire_date int, is_cancel int"
)
LOGS = "msno string, date date, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, total_secs double"


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def paid(spark, *rows):
    return spark.createDataFrame(list(rows), PAID)


def tx_inputs(spark, members, rows):
    label = spark.createDataFrame([(m, 0) for m in members], "msno string, is_churn int")
    return features.Inputs({"train": label}, transactions=paid(spark, *rows))


def log_row(member, day, value=1, secs=1.0):
    return (member, dt.date.fromisoformat(day), *[value] * 6, secs)


def test_mode_takes_smallest_value_of_a_tie(spark):
    rows = spark.createDataFrame([("a", m) for m in (3, 1, 3, 1, None)], "msno string, m int")
    assert one(profiles.most_frequent(rows, "msno", "m", "mode")).mode == 1
    inputs = tx_inputs(
        spark, ["a"], [("a", m, 30, 1.0 + i, 1.0, 0, 20160101, 20160201, 0) for i, m in enumerate((3, 1, 3, 1, None))]
    )
    assert one(features.transaction_features(inputs, "train")).most_freq_payment_method == 1


def test_member_without_transactions(spark):
    row = one(features.transaction_features(tx_inputs(spark, ["a"], [("b", 1, 1, 1.0, 1.0, 0, 20160101, 20160101, 0)]), "train"))
    zeros = ["amount_paid_less", "amount_paid_more", "amount_cancels", "total_autorenew", "amount_transactions"]
    assert [row[c] for c in zeros] == [0] * 5
    assert row.most_freq_payment_method is None and row.plan_list_price_mean is None
    assert row.percent_of_autorenew is None and row.first_transaction is None


def test_zero_plan_and_null_price(spark):
    rows = cleaning.with_transaction_columns(
        paid(spark, ("a", 1, 0, 120.0, 100.0, 0, 20160101, 20160101, 0), ("a", 1, 10, None, 100.0, 0, 20160101, 20160101, 0))
    ).orderBy("payment_plan_days")
    zero, null = rows.collect()
    assert zero.paid_per_day == 100.0 and zero.has_paid_less == 1
    assert (null.has_paid_less, null.has_paid_more, null.paid_per_day) == (0, 0, 10.0)


def test_dedup_happens_before_dates_are_parsed(spark):
    rows = [("a", 1, 10, 5.0, 5.0, 0, day, 20160101, 1) for day in (20171345, 20171346, 20171346, 20160229)]
    row = one(features.transaction_features(tx_inputs(spark, ["a"], rows), "train"))
    assert row.amount_cancels == 3 and row.amount_transactions == 1
    assert row.first_transaction == row.last_transaction == dt.datetime(2016, 2, 29)


def test_age_and_registration_gaps_take_the_mean(spark):
    rows = [(10, 20160101), (90, 20160102), (5, 20170301), (80, None), (None, 20171345)]
    members = spark.createDataFrame(
        [(str(i), 1, bd, None, None, day) for i, (bd, day) in enumerate(rows)], schemas.MEMBERS
    )
    label = spark.createDataFrame([(str(i), 0) for i in range(6)], "msno string, is_churn int")
    out = features.member_features(features.Inputs({"train": label}, members=members), "train").orderBy("msno").collect()
    assert [r.bd for r in out] == [10.0] * 6
    noon = dt.datetime(2016, 1, 1, 12)
    assert [r.registration_init_time for r in out] == [dt.datetime(2016, 1, 1), dt.datetime(2016, 1, 2)] + [noon] * 4
    assert [r.city for r in out] == [1] * 5 + [0] and [r.registered_via for r in out] == [0] * 6
    assert out[0].asDict().keys() == {"msno", "is_churn", "city", "bd", "registered_via", "registration_init_time"}


@pytest.mark.parametrize(
    "later, earlier, days",
    [("2017-03-31 00:00:00", "2016-01-01 12:00:00", 454), ("2016-01-01 00:00:00", "2016-01-01 12:00:00", -1)],
)
def test_day_gaps_round_down(spark, later, earlier, days):
    columns = [F.lit(t).cast("timestamp") for t in (later, earlier)]
    assert one(spark.range(1).select(C.whole_days(*columns).alias("d"))).d == days


def test_scalar_rules(spark):
    rows = spark.createDataFrame([(5,), (6,), (None,)], "n int")
    assert [r[0] for r in rows.select(C.rare_flag(F.col("n"))).collect()] == [1, 0, 1]
    rows = spark.createDataFrame([(-1,), (0,), (2,), (None,)], "n int")
    assert [r[0] for r in rows.select(C.clip_low(F.col("n"))).collect()] == [0, 0, 2, None]
    rows = spark.createDataFrame([(20171345,), (20160229,), (None,)], "d int")
    assert [r[0] for r in rows.select(C.parse_day(F.col("d"))).collect()] == [None, dt.datetime(2016, 2, 29), None]
    assert [r[0] for r in rows.select(C.day_text(F.col("d"))).collect()] == ["2017-13-45", "2016-02-29", None]
    rows = spark.createDataFrame([("male",), ("female",), (None,)], "g string")
    assert [r[0] for r in rows.select(C.gender_code(F.col("g"))).collect()] == [0, 1, 1]


def test_duplicates_with_nulls_are_one_row(spark):
    rows = spark.createDataFrame([(None, 1), (None, 1)], "a int, b int")
    assert cleaning.drop_duplicate_rows(rows).count() == 1
    assert one(explore.duplicate_rows(rows)).duplicates == 1


def test_keep_last_leaves_the_smallest(spark):
    rows = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, v int, w string")
    assert sorted(map(tuple, cleaning.keep_last(rows, "k", "v").collect())) == [("a", 1, "y"), ("b", 2, "z")]


def test_left_join_keeps_unmatched_and_repeats_matched(spark):
    label = spark.createDataFrame([("a", 0), ("b", 1), (None, 1)], "msno string, is_churn int")
    facts = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "msno string, x int")
    got = sorted(joins.left_join_facts(label, facts).collect(), key=str)
    want = sorted(label.join(facts, "msno", "left").collect(), key=str)
    assert got == want


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_over_members_same_with_and_without_broadcast(spark, threshold):
    label = spark.createDataFrame([("a", 0), ("b", 1)], "msno string, is_churn int")
    logs = spark.createDataFrame([log_row(m, f"2016-0{i}-01") for m in "abc" for i in (1, 2)], LOGS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = joins.over_members(logs, label, features.profile_logs)
        assert sorted(r.msno for r in out.collect()) == ["a", "b"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_day_gap_on_repeated_days(spark):
    logs = spark.createDataFrame(
        [log_row("a", "2016-01-01"), log_row("a", "2016-01-01", 2), log_row("a", "2016-01-05"), log_row("b", "2016-02-01")],
        LOGS,
    )
    got = sorted((r.msno, r.date.isoformat(), r.days_between_logins) for r in cleaning.with_day_gap(logs).collect())
    assert got == [("a", "2016-01-01", 0), ("a", "2016-01-01", 0), ("a", "2016-01-05", 4), ("b", "2016-02-01", 0)]


def test_month_gap_sums_equal_row_gaps(spark):
    days = ["2016-01-03", "2016-01-03", "2016-01-20", "2016-03-02", "2016-03-09", "2016-07-01"]
    logs = spark.createDataFrame([log_row("a", d, i) for i, d in enumerate(days)], LOGS)
    by_row = (
        cleaning.with_day_gap(logs)
        .groupBy(F.year("date"), F.month("date"))
        .agg(F.sum("days_between_logins"))
        .collect()
    )
    ranked = profiles.rank_months(profiles.month_states(logs)).select("year", "month", "days_between_logins").collect()
    assert sorted(map(tuple, by_row)) == sorted(map(tuple, ranked)) == [(2016, 1, 17), (2016, 3, 49), (2016, 7, 114)]


def test_pivot_with_one_month(spark):
    row = one(features.profile_logs(spark.createDataFrame([log_row("a", "2016-01-01", 4)], LOGS)))
    assert row.num_25_mean_monthly_1 == 4.0 and row.num_25_sum_monthly_1 == 4
    assert row.num_25_mean_monthly_2 is None and row.num_25_sum_monthly_3 == 0
    assert len(row) == 65 and "days_between_logins_sum_monthly_1" not in row.asDict()


def test_rank_one_is_the_newest_month_with_logs(spark):
    logs = spark.createDataFrame([log_row("a", d, i) for i, d in enumerate(["2015-12-01", "2016-01-01", "2016-05-01"])], LOGS)
    ranked = profiles.rank_months(profiles.month_states(logs)).orderBy("month_rank").collect()
    assert [(r.year, r.month) for r in ranked] == [(2016, 5), (2016, 1), (2015, 12)]


def test_split_must_be_known(spark):
    with pytest.raises(ValueError):
        files.label_source({}, "dev")


def test_too_many_categories_are_refused(spark):
    with pytest.raises(ValueError):
        onehot.fit_categories(spark.range(30).withColumnRenamed("id", "c"), ["c"], limit=10)


def test_one_hot_rows_sum_to_one(spark):
    df = spark.createDataFrame([(1,), (3,), (1,)], "c int")
    out = onehot.one_hot(df, onehot.fit_categories(df, ["c"]))
    assert out.columns == ["c_1", "c_3"] and all(sum(r) == 1.0 for r in out.collect())
    vectors = onehot.one_hot_vectors(["c"]).fit(df).transform(df)
    assert all(r.c_vector.size == 2 and r.c_vector.values.sum() == 1.0 for r in vectors.collect())


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1, 1.0, 5), (2, 3.0, 5), (3, None, 5)], "a int, b double, c int")
    got = {(r.column, r.other): r.r for r in explore.correlation(df, ["a", "b", "c"]).collect()}
    assert got[("a", "c")] is None and got[("c", "c")] is None
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(1.0)


def test_ratio_without_stayers_is_null(spark):
    df = spark.createDataFrame([("x", 1), ("y", 0), ("y", 1)], "g string, is_churn int")
    got = {r.value: r.ratio for r in explore.churn_crosstab(df, ["g"]).collect()}
    assert got == {"x": None, "y": 1.0}


def test_describe_of_an_empty_column(spark):
    df = spark.createDataFrame([(1, None), (4, None)], "a int, b int")
    rows = {r.column: r for r in explore.describe(df, ["a", "b"]).collect()}
    assert rows["b"]["count"] == 0 and rows["b"].mean is None
    assert (rows["a"].q25, rows["a"].q50, rows["a"].max) == (1.75, 2.5, 4.0)


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_running_totals_do_not_depend_on_the_cuts(spark, buckets):
    values = [(v * 37 % 101) for v in range(400)] + [5] * 300  # one value holds most rows
    counts = spark.createDataFrame([(v,) for v in values], "value int").groupBy("value").count().withColumn("g", F.lit("x"))
    got = {r.value: r.below_count for r in ordering.running_totals(counts, "g", "value", ["count"], buckets).collect()}
    assert got == {v: sum(x < v for x in values) for v in set(values)}


def test_exact_quantiles_match_percentile(spark):
    df = spark.range(1001).select((F.pow(F.col("id"), 1.7) % 97).alias("x"))
    want = one(df.agg(F.percentile("x", [0.25, 0.5, 0.75]).alias("q"))).q
    got = one(ordering.exact_quantiles(ordering.value_counts(df, ["x"]), {"a": 0.25, "b": 0.5, "c": 0.75}))
    assert [got.a, got.b, got.c] == pytest.approx(want)


@pytest.mark.parametrize("values", ["spread", "ties", "ends", "odd"])
def test_quantiles_by_selection_match_percentile(spark, values):
    n = 60_007
    x = {
        "spread": F.pow(F.pmod(F.xxhash64("id"), F.lit(10**6)), 1.7),
        "ties": F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(20)).cast("double")),
        "ends": F.when(F.col("id") < 50_000, float("-inf")).otherwise(F.col("id").cast("double")),
        "odd": F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("id") * -0.5),
    }[values]
    df = spark.range(n).select(x.alias("x"), F.lit(3).alias("one"), F.lit(None).cast("int").alias("none"))
    want = one(df.agg(F.percentile("x", [0.25, 0.5, 0.75]).alias("q"))).q
    rows = {r.column: r for r in explore.describe(df, ["x", "one", "none"]).collect()}
    got = [rows["x"][q] for q in ("q25", "q50", "q75")]
    if values == "ends":  # interpolation between equal infinities is the infinity
        want = [float("-inf")] * 3
    assert got == pytest.approx(want, nan_ok=True)
    assert rows["one"].q50 == 3 and rows["none"]["count"] == 0 and rows["none"].q50 is None


def test_only_values_near_a_quantile_are_counted_singly(spark):
    df = spark.range(200_000).select(F.col("id").cast("double").alias("x"))
    counts = ordering.counts_near(df, ordering.summaries(df, ["x"], [0.25, 0.5]))
    got = one(counts.agg(F.sum("n").alias("rows"), F.count("*").alias("kept"), F.count_if(~F.col("near")).alias("gaps")))
    assert got.rows == 200_000 and got.gaps == 3 and got.kept < 2 * 200_000 * 12 / ordering.ACCURACY


def test_cuts_do_not_depend_on_the_order_of_rows(spark):
    counts = spark.range(3000).select(F.lit("g").alias("g"), (F.col("id") * 1.5).alias("value"), F.lit(1).alias("n"))
    totals = [
        ordering.running_totals(counts.repartition(parts, "value"), "g", "value", ["n"], 16) for parts in (1, 5)
    ]
    assert totals[0].exceptAll(totals[1]).count() == 0
    assert one(totals[1].agg(F.max("below_n").alias("most"))).most == 2999


def test_auc_counts_ties_half(spark):
    scored = spark.createDataFrame([("m", 0.1, 0), ("m", 0.5, 1), ("m", 0.5, 0), ("m", 0.9, 1)], "model string, score double, is_churn int")
    assert one(ordering.auc_by_model(scored)).auc == pytest.approx(3.5 / 4)


def test_csv_and_log_dates(spark, tmp_path):
    raw = spark.createDataFrame([("a", 20160131, *[1] * 6, 2.5), ("a", 20160231, *[1] * 6, 2.5)], schemas.USER_LOGS)
    files.write_csv(raw, str(tmp_path / "logs"))
    back = files.read_logs_csv(spark, str(tmp_path / "logs"), schemas.USER_LOGS)
    assert sorted((r.date is None, r.date) for r in back.collect()) == [(False, dt.date(2016, 1, 31)), (True, None)]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Madrid", "America/New_York"])
def test_day_gaps_do_not_depend_on_the_zone(spark, zone):
    from refrain.functions.columns import parse_day, whole_days

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(20170101, 20170331), (20171001, 20171101), (20170331, 20170101)], "a int, b int")
        got = [r[0] for r in df.select(whole_days(parse_day(F.col("b")), parse_day(F.col("a")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [89, 31, -89]


def test_csv_with_another_column_order_is_refused(spark, tmp_path):
    from refrain.sources import files, schemas

    (tmp_path / "labels.csv").write_text("is_churn,msno\n1,a\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "labels.csv"), schemas.LABEL).collect()


def test_described_columns_are_computed_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(5_000).select(F.col("id").cast("double").alias("a"), F.lit(1).alias("b")).mapInArrow(seen, "a double, b int")
    rows = {r.column: r for r in explore.describe(df, ["a", "b"]).collect()}
    assert read.value == 5_000
    assert (rows["a"]["count"], rows["a"].q25, rows["a"].q50, rows["b"].max) == (5_000, 1249.75, 2499.5, 1.0)
