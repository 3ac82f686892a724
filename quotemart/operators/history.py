"""Dimension changes: append as current, or expire and reinsert changed rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemart.functions.text import normal_name, normal_ticker
from quotemart.operators.keys import assign_keys
from quotemart.operators.upsert import differs, shaped

NaturalKey = Callable[[], dict[str, Column]]


def company_key() -> dict[str, Column]:
    """Natural key of the company dimension."""
    return {"_ticker": normal_ticker(F.col("company_ticker"))}


def exchange_key() -> dict[str, Column]:
    """Natural key of the exchange dimension."""
    return {"_exchange": normal_name(F.col("exchange_name"))}


def industry_key() -> dict[str, Column]:
    """Natural key of the industry dimension."""
    return {
        "_sector": normal_name(F.col("industry_sector")),
        "_industry": normal_name(F.col("industry_name")),
    }


def current(dim: DataFrame) -> DataFrame:
    """The current rows of a dimension."""
    return dim.where("is_current")


def append_current(dim: DataFrame, rows: DataFrame, natural: NaturalKey, key: str) -> DataFrame:
    """Append all rows as current and expire nothing, so every run adds a full copy."""
    added = assign_keys(rows, list(natural().values()), key, dim).withColumn("is_current", F.lit(True))
    return dim.unionByName(shaped(added, dim.schema))


def expire_and_insert(dim: DataFrame, rows: DataFrame, natural: NaturalKey, key: str) -> DataFrame:
    """Keep unchanged rows with their keys, expire changed ones and insert their new version.

    Rows absent from the source stay current; nothing is ever deleted. ``rows`` holds one row per
    natural key.
    """
    names = natural()
    attributes = [c for c in dim.columns if c not in (key, "is_current")]
    changed = F.lit(False)
    for c in attributes:
        changed = changed | differs(c, f"_other_{c}")

    def other(df: DataFrame) -> DataFrame:
        keyed = df.withColumns(names)
        return keyed.select(
            *names, *[F.col(c).alias(f"_other_{c}") for c in attributes], F.lit(True).alias("_matched")
        )

    now_current = current(dim).withColumns(names)
    expired = (
        now_current.join(other(rows), list(names), "left")
        .withColumn("is_current", ~F.coalesce(F.col("_matched") & changed, F.lit(False)))
        .select(*dim.columns)
    )
    fresh = (
        rows.withColumns(names)
        .join(other(current(dim)), list(names), "left")
        .where(F.col("_matched").isNull() | changed)
        .select(*rows.columns)
    )
    added = assign_keys(fresh, list(names.values()), key, dim).withColumn("is_current", F.lit(True))
    past = dim.where(~F.col("is_current"))
    return past.unionByName(expired).unionByName(shaped(added, dim.schema))
