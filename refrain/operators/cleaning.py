"""Row cleaning: duplicates, nulls, imputation and the per-column rules of each raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from refrain.functions import columns as C
from refrain.sources.schemas import DAY_GAP, LOG_MEASURES

CUTOFF = "2017-02-28"
SENTINEL = -99.0


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, nulls equal. Copies are combined before the shuffle, which is keyed on
    the whole row, so neither a hot member nor a mass of copies lands in one task."""
    return df.dropDuplicates()


def keep_last(df: DataFrame, key: str, descending: str) -> DataFrame:
    """One row per key: the last one after a descending sort, i.e. the smallest value.

    An aggregate rather than a window, so a hot key is reduced before it is shuffled. Equal
    values are settled by the remaining columns; nulls sort last, hence survive.
    """
    rest = [c for c in df.columns if c not in (key, descending)]
    rank = F.struct(F.col(descending).isNotNull().alias("known"), F.col(descending), *[F.col(c) for c in rest])
    kept = df.groupBy(key).agg(F.min(rank).alias("kept"))
    return kept.select(*[F.col(c) if c == key else F.col(f"kept.{c}").alias(c) for c in df.columns])


def fill_member_means(
    df: DataFrame, known: DataFrame, low: float = 5, high: float = 80, cutoff: str = CUTOFF
) -> DataFrame:
    """Age and registration date with their gaps filled by the mean of the usable values.

    An age outside the open range, a date that does not parse and a date at or past the cutoff
    are gaps. ``known`` holds the rows the means are taken over. Both means come from one
    one-row subquery inside the plan, so nothing runs before the result is asked for.
    """
    age = C.within(F.col("bd"), low, high).cast("double")
    moment = C.before(C.parse_day(F.col("registration_init_time")), cutoff)
    means = known.select(F.struct(F.avg(age).alias("age"), C.mean_moment(moment).alias("moment"))).scalar()
    return df.withColumns(
        {
            "bd": F.coalesce(age, means.getField("age")),
            "registration_init_time": F.coalesce(moment, means.getField("moment")),
        }
    )


def fill_zero_codes(df: DataFrame) -> DataFrame:
    return df.fillna({"city": 0, "registered_via": 0})


def fill_sentinel(df: DataFrame, columns: list[str], value: float = SENTINEL) -> DataFrame:
    return df.fillna(value, subset=columns)


def with_transaction_columns(df: DataFrame) -> DataFrame:
    """Parsed dates, price difference, price flags and price per plan day."""
    difference = F.col("plan_list_price") - F.col("actual_amount_paid")
    return df.select(
        *[c for c in df.columns if c not in ("transaction_date", "membership_expire_date")],
        C.parse_day(F.col("transaction_date")).alias("transaction_date"),
        C.parse_day(F.col("membership_expire_date")).alias("membership_expire_date"),
        difference.alias("diff_planned_paid"),
        C.positive_flag(difference).alias("has_paid_less"),
        C.positive_flag(-difference).alias("has_paid_more"),
        C.paid_per_day(F.col("actual_amount_paid"), F.col("payment_plan_days")).alias("paid_per_day"),
    )


def clean_log_rows(logs: DataFrame) -> DataFrame:
    """Complete, distinct log rows with negative measures raised to 0."""
    distinct = drop_duplicate_rows(logs.dropna("any"))
    return distinct.withColumns({m: C.clip_low(F.col(m)) for m in LOG_MEASURES})


def with_day_gap(rows: DataFrame, key: str = "msno", day: str = "date") -> DataFrame:
    """Days since the member's previous log row; 0 on the first row and on further rows of a day.

    Only one row of a day can have a gap, so the window runs over a member's distinct days, bounded by
    the calendar, whatever the number of rows. That row is the one with the day's smallest row hash: a
    number, which a hash aggregate folds before the shuffle, and which the rows meet again by joining on
    member and day, where a hot day can be split. Of n different rows of a day, two carry the gap only if
    the smallest of n 64-bit hashes occurs twice. Repeated rows carry it each, so callers drop them first.
    """
    mark = F.xxhash64(*[c for c in rows.columns if c != key])
    previous = F.lag(day).over(Window.partitionBy(key).orderBy(day))
    days = (
        rows.groupBy(key, day)
        .agg(F.min(mark).alias("carrier"))
        .withColumn("gap", F.coalesce(F.datediff(day, previous), F.lit(0)))
    )
    gap = F.when(mark == F.col("carrier"), F.col("gap")).otherwise(0)
    return rows.join(days, [key, day]).select(*rows.columns, gap.alias(DAY_GAP))
