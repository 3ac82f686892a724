"""Date and time functions on columns; none depends on the session time zone unless it says so."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EXCHANGE_ZONE = "America/New_York"
MIDNIGHT = "00:00:00"
SUNDAY, SATURDAY = 1, 7
NANOS_PER_SECOND = 1_000_000_000


def millis_to_timestamp(millis: Column) -> Column:
    """Epoch milliseconds to a zone-free UTC timestamp."""
    seconds = (millis.cast("decimal(18,0)") / 1000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def day_key(day: Column) -> Column:
    """Integer yyyymmdd key of a date; plain arithmetic, no text round trip."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def is_weekend(day: Column) -> Column:
    """True on Saturday and Sunday, False otherwise and for NULL."""
    return F.when(F.dayofweek(day).isin(SUNDAY, SATURDAY), True).otherwise(False)


def calendar_columns(day: Column) -> dict[str, Column]:
    """The attributes of the date dimension, in table order after the keys."""
    return {
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "day_of_week": F.date_format(day, "EEEE"),
        "week_of_year": F.weekofyear(day),
        "is_weekend": is_weekend(day),
        "is_holiday": F.lit(False),
    }


def trading_day(today: Column, days_back: int = 1) -> Column:
    """The day ``days_back`` before ``today``, moved back to Friday from a weekend; no holidays."""
    day = F.date_sub(today, days_back)
    weekday = F.dayofweek(day)
    return (
        F.when(weekday == SATURDAY, F.date_sub(day, 1))
        .when(weekday == SUNDAY, F.date_sub(day, 2))
        .otherwise(day)
    )


def exchange_today() -> Column:
    """Today's date at the exchange."""
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(EXCHANGE_ZONE), F.localtimestamp()))


def landing_day(today: Column) -> Column:
    """Date stamped on a landing file: the day before the crawl."""
    return F.date_sub(today, 1)


def time_of_day(nanos: Column) -> Column:
    """Nanoseconds since midnight to HH:MM:SS, hours beyond a day wrap; NULL gives midnight."""
    seconds = F.floor(nanos / NANOS_PER_SECOND)

    def two_digits(value: Column) -> Column:
        return F.lpad(value.cast("int").cast("string"), 2, "0")

    text = F.concat_ws(
        ":",
        two_digits(F.floor(seconds / 3600) % 24),
        two_digits(F.floor(seconds / 60) % 60),
        two_digits(seconds % 60),
    )
    return F.when(nanos.isNull(), MIDNIGHT).otherwise(text)


def market_time(text: Column) -> Column:
    """HH:MM or HH:MM:SS to HH:MM:SS, NULL for anything else."""
    ok = text.rlike(r"^([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d)?$")
    parts = F.split(text, ":")
    padded = F.concat_ws(
        ":", F.lpad(parts[0], 2, "0"), parts[1], F.coalesce(F.get(parts, F.lit(2)), F.lit("00"))
    )
    return F.when(ok, padded)
