"""Times, durations and the priority built from them."""

from pyspark.sql import Column, functions as F

_TIMEOUT = r"^\s*(?:(\d+)-)?(\d+):(\d+)\s*$"


def timeout_minutes(timeout: Column) -> Column:
    """``D-HH:MM`` or ``HH:MM`` to minutes; anything else is 0. More minutes than a long holds are its greatest."""
    days, hours, minutes = (F.regexp_extract(timeout, _TIMEOUT, i) for i in (1, 2, 3))
    most = F.lit((1 << 63) - 1)

    def number(digits):
        # Digits that no DECIMAL(30) holds exceed a long however they are weighted.
        value = F.coalesce(digits.try_cast("decimal(30,0)"), F.lit("1" + 29 * "0").cast("decimal(30,0)"))
        return F.when(digits == "", F.lit(0).cast("decimal(30,0)")).otherwise(value).cast("decimal(38,0)")

    total = F.try_add(F.try_add(number(days) * 1440, number(hours) * 60), number(minutes))
    return F.when(minutes == "", F.lit(0).cast("bigint")).when(
        F.coalesce(minutes, F.lit("")) != "", F.coalesce(F.least(total, most.cast("decimal(38,0)")).cast("bigint"), most)
    ).otherwise(F.lit(0).cast("bigint"))


def priority_ratio(size: Column, timeout: Column) -> Column:
    """Input bytes per allowed minute; null when there is no usable timeout."""
    return F.try_divide(size.cast("double"), timeout_minutes(timeout).cast("double"))


def hms(seconds: Column) -> Column:
    """Whole seconds as ``HH:MM:SS`` with unbounded hours; under a second or unknown is zero."""
    whole = F.when(seconds >= 1, F.floor(seconds)).otherwise(F.lit(0)).cast("bigint")
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(whole / 3600).cast("bigint"),
        F.floor((whole % 3600) / 60).cast("bigint"),
        whole % 60,
    )


def elapsed_seconds(since: Column, until: Column) -> Column:
    return F.timestamp_diff("SECOND", since.cast("timestamp"), until.cast("timestamp"))


def elapsed(since: Column, until: Column) -> Column:
    return hms(elapsed_seconds(since, until))


def epoch_to_utc(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def to_utc(ts: Column, zone: Column | None = None) -> Column:
    """A naive time is taken as UTC; one tagged with a zone is converted."""
    return ts.cast("timestamp") if zone is None else F.to_utc_timestamp(ts, F.coalesce(zone, F.lit("UTC")))


def earliest(*columns: Column) -> Column:
    """The smallest of several values, ignoring nulls."""
    return F.least(*columns)


def latest(*columns: Column) -> Column:
    return F.greatest(*columns)
