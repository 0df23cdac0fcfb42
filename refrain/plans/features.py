"""Feature pipelines for members, transactions and logs, and the final member table.

Labels hold one row per member. Every function returns a lazy plan, except that learning the
one-hot categories runs one job over the members.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.functions import columns as C
from refrain.operators import cleaning, joins, profiles
from refrain.operators.onehot import MAX_CATEGORIES, fit_categories, one_hot
from refrain.sources.files import label_source

# The anchor date, the one-hot columns and the dates that give way to gaps.
ANCHOR = "2017-03-31"
ONE_HOT_COLUMNS = ["registered_via", "city", "registration_init_time_year", "registration_init_time_month"]
DATE_COLUMNS = ["last_login", "first_login", "registration_init_time", "first_transaction", "last_transaction"]


@dataclass(frozen=True)
class Inputs:
    """The raw tables: label tables by split, and the three fact tables."""

    labels: dict[str, DataFrame]
    members: DataFrame | None = None
    transactions: DataFrame | None = None
    user_logs: DataFrame | None = None

    def label(self, split: str) -> DataFrame:
        return label_source(self.labels, split)


def member_features(inputs: Inputs, split: str, cutoff: str = cleaning.CUTOFF) -> DataFrame:
    """Label rows with age, city, channel and registration date, all gaps filled.

    Members hold one row per member, so no key is hot and a plain left join will do. The means are taken over the same
    join: a label without a member has nulls there, which they skip.
    """
    joined = cleaning.fill_zero_codes(joins.left_join_profiles(inputs.label(split), inputs.members))
    return cleaning.fill_member_means(joined, joined, cutoff=cutoff).drop("gender")


def profile_transactions(rows: DataFrame) -> DataFrame:
    return profiles.transaction_profile(cleaning.drop_duplicate_rows(rows))


def profile_logs(rows: DataFrame) -> DataFrame:
    states = profiles.month_states(cleaning.clean_log_rows(rows))
    return profiles.log_profile(profiles.rank_months(states))


def transaction_features(inputs: Inputs, split: str) -> DataFrame:
    """Payment profile of every labelled member; one without payments has sums 0 and means null."""
    keys = inputs.label(split).select("msno")
    profile = joins.over_members(inputs.transactions, keys, profile_transactions)
    zeros = {name: 0 for name in [*profiles.TRANSACTION_SUMS, "amount_transactions"]}
    return keys.filter("msno IS NOT NULL").distinct().join(profile, "msno", "left").fillna(zeros)


def log_features(inputs: Inputs, split: str) -> DataFrame:
    """Listening profile of every labelled member that has complete log rows."""
    return joins.over_members(inputs.user_logs, inputs.label(split).dropna("any"), profile_logs)


def clean_logs(inputs: Inputs, split: str) -> DataFrame:
    """Distinct complete log rows of labelled members, measures clipped at 0."""
    return joins.over_members(inputs.user_logs, inputs.label(split).dropna("any"), cleaning.clean_log_rows)


def joined_features(inputs: Inputs, split: str) -> DataFrame:
    return joins.left_join_profiles(
        member_features(inputs, split),
        transaction_features(inputs, split),
        log_features(inputs, split),
    )


def with_date_gaps(df: DataFrame, anchor: str = ANCHOR) -> DataFrame:
    """Whole-day gaps between events and to the anchor day.

    ``diff_first_last_transaction`` is first minus last, hence never positive, and
    ``diff_days_last_login_last_transaction`` starts from the first login: both as defined
    by the study this feature set comes from.
    """
    end = F.lit(anchor).cast("timestamp")
    first_login, last_login = (F.col(c).cast("timestamp") for c in ("first_login", "last_login"))
    registered = F.col("registration_init_time")
    first_paid, last_paid = F.col("first_transaction"), F.col("last_transaction")
    return df.withColumns(
        {
            "diff_first_last_transaction": C.whole_days(first_paid, last_paid),
            "diff_max_min_log": C.whole_days(last_login, first_login),
            "diff_first_log_registration": C.whole_days(first_login, registered),
            "days_since_last_transaction": C.whole_days(end, last_paid),
            "days_since_registration": C.whole_days(end, registered),
            "diff_days_last_login_last_transaction": C.whole_days(first_login, last_paid),
            "days_since_last_login": C.whole_days(end, last_login),
        }
    )


def with_registration_parts(df: DataFrame) -> DataFrame:
    moment = F.col("registration_init_time")
    return df.withColumns(
        {
            "registration_init_time_year": F.year(moment),
            "registration_init_time_month": F.month(moment),
        }
    )


def final_dataset(
    inputs: Inputs,
    split: str,
    categories: dict[str, list[int]] | None = None,
    anchor: str = ANCHOR,
    limit: int = MAX_CATEGORIES,
) -> DataFrame:
    """One wide numeric row per label row.

    Categories are learned from the split itself unless given; learning them needs only the
    member features, so that one small job never touches the fact tables. A column of more than
    ``limit`` categories is refused.
    """
    if categories is None:
        categories = learn_categories(inputs, split, limit)
    gaps = with_date_gaps(joined_features(inputs, split), anchor)
    flagged = gaps.withColumn("rare_user", C.rare_flag(F.col("amount_of_logins")))
    encoded = one_hot(with_registration_parts(flagged), categories)
    return encoded.drop(*DATE_COLUMNS)


def learn_categories(inputs: Inputs, split: str, limit: int = MAX_CATEGORIES) -> dict[str, list[int]]:
    return fit_categories(with_registration_parts(member_features(inputs, split)), ONE_HOT_COLUMNS, limit)


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("msno", "is_churn")]
