"""Set-wise table changes; each returns the new content of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quotemart.operators.dedup import keep_first
from quotemart.operators.keys import assign_keys


def differs(left: str, right: str) -> Column:
    """Null-safe inequality."""
    return ~F.col(left).eqNullSafe(F.col(right))


def update_rows(
    old: DataFrame,
    new: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
    stamp: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Replace ``columns`` of the rows of ``old`` that ``new`` names; NULLs replace values too.

    Whether a row is named is told by a marker, not by its values. ``stamp`` moves to ``now`` only
    on rows where a value changed. ``new`` must have one row per key.
    """
    source = new.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_named"))
    changed = F.lit(False)
    for c in columns:
        changed = changed | differs(c, f"_new_{c}")
    values = {c: F.when(F.col("_named"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    if stamp:
        values[stamp] = F.when(F.col("_named") & changed, now).otherwise(F.col(stamp))
    joined = old.join(source, list(on), "left")
    return joined.select(*[values[c].alias(c) if c in values else F.col(c) for c in old.columns])


def new_rows(old: DataFrame, new: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key ``old`` does not hold."""
    return new.join(old.select(*on), list(on), "left_anti")


def shaped(
    df: DataFrame, schema: StructType, stamp: str | None = None, now: Column | None = None
) -> DataFrame:
    """Columns and types of ``schema``; the stamp is set, other absent columns become NULL."""
    held = set(df.columns)
    columns = []
    for field in schema.fields:
        if field.name == stamp:
            value = now
        elif field.name in held:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def upsert(
    old: DataFrame,
    new: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
    key: str,
    stamp: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Update the rows ``new`` names and append the others under fresh keys."""
    kept = update_rows(old, new, on, columns, stamp, now)
    added = assign_keys(new_rows(old, new, on), [F.col(c) for c in on], key, old)
    return kept.unionByName(shaped(added, old.schema, stamp, now))


def insert_absent(
    old: DataFrame,
    new: DataFrame,
    on: Sequence[str],
    key: str | None = None,
    stamp: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Append the rows whose natural key is absent; rows already there stay as they are."""
    added = new_rows(old, new, on)
    if key:
        added = assign_keys(added, [F.col(c) for c in on], key, old)
    return old.unionByName(shaped(added, old.schema, stamp, now))


def upsert_sic(
    old: DataFrame, new: DataFrame, stamp: str | None = None, now: Column | None = None
) -> DataFrame:
    """Upsert SIC rows, whose id comes with the data and whose (industry, sector) is unique too.

    Every row claims its pair, known and unknown ids alike. A claim on a pair that another old row
    holds is dropped; of the others the first claim on a pair wins. A known id that wins takes the
    pair, an unknown one is added; who loses changes nothing. ``new`` holds pos, sic_id,
    sic_industry, sic_sector with one row per id.
    """
    pair = ["sic_industry", "sic_sector"]
    held = old.select(F.col("sic_id").alias("_holder"), *[F.col(c).alias(f"_{c}") for c in pair])
    taken = (
        (F.col("sic_industry") == F.col("_sic_industry"))
        & (F.col("sic_sector") == F.col("_sic_sector"))
        & (F.col("sic_id") != F.col("_holder"))
    )
    winners = keep_first(new.join(held, taken, "left_anti"), pair, [F.col("pos")])
    updated = update_rows(old, winners, ["sic_id"], pair, stamp, now)
    return updated.unionByName(shaped(new_rows(old, winners, ["sic_id"]), old.schema, stamp, now))


# Natural key and replaceable columns of the companies table.
COMPANY_KEY = ["company_ticker", "company_is_delisted"]
COMPANY_COLUMNS = [
    "company_name",
    "company_cik",
    "company_exchange_id",
    "company_industry_id",
    "company_sic_id",
    "company_category",
    "company_currency",
    "company_location",
]


def merge_companies(
    old: DataFrame, resolved: DataFrame, stamp: str | None = None, now: Column | None = None
) -> DataFrame:
    """Apply resolved company rows: the last row of a known key, the first of a new one.

    ``resolved`` comes from ``resolve_companies``; rejected rows are dropped before ranking, so
    they never hide a valid row of the same key.
    """
    valid = resolved.where(F.col("disposition").isin("inserted", "updated"))
    order = F.when(F.col("known"), -F.col("pos")).otherwise(F.col("pos"))
    winners = keep_first(valid, COMPANY_KEY, [order])
    kept = update_rows(old, winners.where("known"), COMPANY_KEY, COMPANY_COLUMNS, stamp, now)
    added = assign_keys(
        winners.where(~F.col("known")), [F.col(c) for c in COMPANY_KEY], "company_id", old
    )
    return kept.unionByName(shaped(added, old.schema, stamp, now))
