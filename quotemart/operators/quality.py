"""Constraint checks; every check gives rows (table, rule, columns, violations)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ConstraintError(ValueError):
    """A table breaks its constraints."""


def _column_counts(df: DataFrame, table: str, rule: str, broken: Mapping[str, Column]) -> DataFrame:
    """Violations of several columns from a single pass over the table."""
    counts = [
        F.struct(F.lit(c).alias("columns"), F.count(F.when(bad, 1)).alias("violations"))
        for c, bad in broken.items()
    ]
    found = df.agg(F.array(*counts).alias("found")).select(F.inline("found"))
    return found.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), "columns", "violations")


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per required column."""
    return _column_counts(df, table, "not null", {c: F.col(c).isNull() for c in columns})


def max_length(df: DataFrame, table: str, bounds: Mapping[str, int]) -> DataFrame:
    """Texts longer than their bound, per column."""
    return _column_counts(df, table, "length", {c: F.length(c) > n for c, n in bounds.items()})


def unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part is never a repetition."""
    repeated = (
        df.dropna("any", subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table"),
        F.lit("unique").alias("rule"),
        F.lit(", ".join(key)).alias("columns"),
        "violations",
    )


def foreign_keys(
    child: DataFrame, table: str, references: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Child rows whose key has no parent, per key column; NULL keys pass.

    ``references`` maps an integer column to its parent and the parent's column. One pass over the
    child counts its rows per column and key before the join, so a hot key costs one row.
    """
    pairs = [
        F.struct(F.lit(c).alias("columns"), F.col(c).cast("long").alias("key")) for c in references
    ]
    used = (
        child.select(F.inline(F.array(*pairs)))
        .where("key IS NOT NULL")
        .groupBy("columns", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    held = reduce(
        DataFrame.unionByName,
        [
            parent.select(F.lit(c).alias("columns"), F.col(p).cast("long").alias("key"))
            for c, (parent, p) in references.items()
        ],
    )
    lost = used.join(held, ["columns", "key"], "left_anti").select("columns", "n")
    none = child.sparkSession.createDataFrame([(c, 0) for c in references], lost.schema)
    return (
        lost.unionByName(none)
        .groupBy("columns")
        .agg(F.sum("n").alias("violations"))
        .select(F.lit(table).alias("table"), F.lit("foreign key").alias("rule"), "columns", "violations")
    )


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """All checks in one result."""
    return reduce(DataFrame.unionByName, checks)


def require(checks: Sequence[DataFrame]) -> None:
    """Raise if any check found violations; at most one row per check reaches the driver."""
    broken = report(checks).where("violations > 0").collect()
    if broken:
        raise ConstraintError("; ".join(f"{r.table}: {r.rule} ({r.columns}) x {r.violations}" for r in broken))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
            for name, df in tables.items()
        ],
    )
