"""Numeric, conditional and default-value functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MONEY_TYPE, MONEY_SCALE, MONEY_UNIT = "decimal(18,4)", 10_000, "0.0001"
TREND_UP, TREND_DOWN, TREND_FLAT = "up", "down", "unchanged"


def present(text: Column) -> Column:
    """True if a text is neither NULL nor empty; never NULL."""
    return F.coalesce(text != "", F.lit(False))


def flag(value: Column) -> Column:
    """Truth of a flag as it stands in a feed: False for NULL, false, zero and what is empty, else True.

    Any other text is true, "no" as well; JSON values arrive as texts, so the text "false" counts as false.
    """
    text = value.cast("string")
    empty = text.isin("", "false", "[]", "{}") | F.coalesce(text.try_cast("double") == 0, F.lit(False))
    return ~F.coalesce(empty, F.lit(True))


def whole_number(text: Column) -> Column:
    """Integer written in a text, NULL if it is not a whole number or out of range."""
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("int"))


def price_trend(change: Column) -> Column:
    """Direction of an unrounded price change; NULL counts as unchanged."""
    return (
        F.when(change > 0, TREND_UP).when(change < 0, TREND_DOWN).otherwise(TREND_FLAT)
    )


def money(value: Column) -> Column:
    """Four-place decimal of a double, NULL where it does not fit.

    Rounds the scaled double half away from zero, as the warehouse columns do on insert; a plain
    cast would round the shortest decimal text instead and differ on ties.
    """
    units = F.round(value * MONEY_SCALE).try_cast("decimal(18,0)")
    return (units * F.lit(MONEY_UNIT).cast("decimal(4,4)")).cast(MONEY_TYPE)


def share_volume(value: Column) -> Column:
    """Whole shares, fraction cut off; NaN and out-of-range values give NULL."""
    return value.try_cast("bigint")
