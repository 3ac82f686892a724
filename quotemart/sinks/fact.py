"""The daily fact: a Parquet table partitioned by day, replaced by whole days once they are checked."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from quotemart.operators import quality
from quotemart.operators.days import FACT_KEYS
from quotemart.schemas import FACT, SCHEMAS
from quotemart.sinks.daytable import DayTable

DAY = "date_key"
# A fact row takes some 50 bytes: about 500 MB per task.
ROWS_PER_TASK = 10_000_000
TASKS_PER_CORE = 4


def fact_table(spark: SparkSession, path: str) -> DayTable:
    """The fact below a path."""
    return DayTable(spark, path, DAY, SCHEMAS[FACT])


def init_fact(spark: SparkSession, path: str) -> None:
    """Make the table empty."""
    fact_table(spark, path).clear()


def read_fact(spark: SparkSession, path: str, days: list[int] | None = None) -> DataFrame:
    """The table in its column order, or some of its days; filters on the day prune partitions."""
    return fact_table(spark, path).read(days)


def sizes_of(touched: DataFrame) -> dict[int, int]:
    """Bars of each day; a calendar bounds the days."""
    return {r[DAY]: r["bars"] for r in touched.select(DAY, "bars").collect()}


def spread(sizes: dict[int, int], cores: int, rows: int | None = None) -> tuple[int, int]:
    """How the rows are gathered for the write: tasks, and slices of a day.

    The largest day decides the slices, so that each fits in one task; a slice goes to one task and
    into one file. There are as many tasks as slices of days, but no more than the cores can use or
    the rows need, at so many ``rows`` a task, by default ``ROWS_PER_TASK``.
    """
    rows = ROWS_PER_TASK if rows is None else rows
    slices = max(1, -(-max(sizes.values(), default=0) // rows))
    needed = max(TASKS_PER_CORE * cores, -(-sum(sizes.values()) // rows))
    return max(1, min(len(sizes) * slices, needed)), slices


def write_days(
    fact: DataFrame, path: str, sizes: Mapping[int, int], references: Mapping[str, tuple[DataFrame, str]] | None = None
) -> dict[str, int]:
    """Replace every day of ``sizes`` by its rows in ``fact``; returns rows, days, emptied days and dropped rows.

    ``fact`` should come gathered by day, see ``spread``. Rows are written aside first. Rows without
    a day are dropped and counted; a null in any other key, or a key that ``references`` does not
    hold, raises, and the table stays as it was. Then one rename lets all days count at once: a day
    without rows is emptied by it, too.
    """
    table = fact_table(fact.sparkSession, path)
    staged = table.stage(fact, [k for k in FACT_KEYS if k != DAY])
    try:
        missing = [f"{FACT}: not null ({c}) x {n}" for c, n in staged.nulls.items() if n]
        if missing:
            raise quality.ConstraintError("; ".join(missing))
        if references:
            quality.require([quality.foreign_keys(staged.rows, FACT, references)])
    except Exception:
        table.discard(staged)
        raise
    emptied = table.publish(staged, sizes)
    return {"rows": sum(staged.days.values()), "days": len(staged.days), "emptied": len(emptied), "dropped": staged.dropped}
