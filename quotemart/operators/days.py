"""Replacing whole days of a fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_KEYS = ["date_key", "company_key", "industry_key", "exchange_key"]


def replace_days(old: DataFrame, fresh: DataFrame, touched: DataFrame) -> DataFrame:
    """Remove every touched day from ``old`` and add ``fresh``.

    ``touched`` holds the distinct days of the input bars, so a day whose bars all lost their
    company empties. A calendar bounds it (some 250 days a year), hence the broadcast.
    """
    days = touched.select("date_key").distinct()
    return old.join(F.broadcast(days), "date_key", "left_anti").unionByName(fresh)


def drop_null_keys(fact: DataFrame, keys: Sequence[str] = FACT_KEYS) -> DataFrame:
    """Remove rows lacking any key."""
    return fact.dropna("any", subset=list(keys))
