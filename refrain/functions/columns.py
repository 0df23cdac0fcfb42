"""Scalar rules of the feature build as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000
NULL_LABEL = "NAN"


def parse_day(day: Column) -> Column:
    """yyyymmdd number -> timestamp at midnight; a day that does not exist gives null."""
    return F.try_to_timestamp(day.cast("string"), F.lit("yyyyMMdd"))


def day_text(day: Column) -> Column:
    """yyyymmdd number -> yyyy-mm-dd text by slicing, with no validity check."""
    digits = day.cast("bigint").cast("string")
    parts = [F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 12)]
    return F.when(day.isNotNull(), F.concat_ws("-", *parts))


def _wall_micros(moment: Column) -> Column:
    """Microseconds on the wall clock since 1970, so that every day has the same length in any zone."""
    moment = moment.cast("timestamp")
    seconds = (F.hour(moment) * 3600 + F.minute(moment) * 60).cast("bigint")
    fraction = (F.date_part(F.lit("SECOND"), moment) * 1_000_000).cast("bigint")
    return F.unix_date(moment.cast("date")).cast("bigint") * MICROS_PER_DAY + seconds * 1_000_000 + fraction


def whole_days(later: Column, earlier: Column) -> Column:
    """Days from ``earlier`` to ``later``, rounded down (also below zero), time of day included."""
    micros = _wall_micros(later) - _wall_micros(earlier)
    return ((micros - F.pmod(micros, F.lit(MICROS_PER_DAY))) / MICROS_PER_DAY).cast("bigint")


def positive_flag(value: Column) -> Column:
    """1 above zero, else 0; null counts as not above."""
    return F.when(value > 0, 1).otherwise(0)


def paid_per_day(paid: Column, days: Column) -> Column:
    """Price of one plan day; a zero-day plan costs its whole price."""
    return F.when(days == 0, paid).otherwise(F.try_divide(paid, days))


def within(value: Column, low: float, high: float) -> Column:
    """The value when strictly between the bounds, else null."""
    return F.when((value > low) & (value < high), value)


def before(moment: Column, cutoff: str) -> Column:
    """The moment when strictly before the cutoff day, else null."""
    return F.when(moment < F.lit(cutoff).cast("timestamp"), moment)


def clip_low(value: Column) -> Column:
    """Negative values become 0; null stays null."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def rare_flag(logins: Column, limit: int = 5) -> Column:
    """0 above ``limit`` logins, else 1; no logins at all is rare too."""
    return F.when(logins > limit, 0).otherwise(1)


def label_null(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(NULL_LABEL))


def unlabel_null(value: Column, type_name: str) -> Column:
    return F.nullif(value, F.lit(NULL_LABEL)).cast(type_name)


def gender_code(gender: Column) -> Column:
    """0 for male; 1 for anything else, null included."""
    return F.when(gender == "male", 0).otherwise(1)


def mean_moment(moment: Column) -> Column:
    """Mean timestamp to the microsecond, null when there is none."""
    micros = F.unix_micros(moment)
    total, known = F.sum(micros.cast("decimal(20,0)")), F.count(micros)
    return F.timestamp_micros(F.floor(F.try_divide(total, known)).cast("bigint"))


def hash_share(key: Column, seed: int | str) -> Column:
    """A repeatable number in [0, 1) from the key's md5, the same in any engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))
