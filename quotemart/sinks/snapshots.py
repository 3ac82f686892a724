"""Writing table snapshots and removing old ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quotemart.sources import files
from quotemart.sources.snapshots import COMPLETE, snapshot_tokens


def write_snapshot(df: DataFrame, table: str, column: str, token: str) -> int:
    """Write one snapshot over a former one of the same token and return its rows.

    Rows are counted by the write itself. An empty result leaves no snapshot.
    """
    target = f"{table}/{column}={token}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(target)
    rows = seen.get["rows"]
    if rows == 0:
        files.delete(df.sparkSession, target)
    return rows


def write_snapshots(df: DataFrame, table: str, column: str) -> list[str]:
    """Write the snapshots that ``column`` names, over former ones of these tokens, and return the tokens.

    All are written by one job, and count as complete once all of it has ended; other snapshots stay.
    Rows without a token raise.
    """
    spark = df.sparkSession
    token = F.when(F.col(column).isNull(), F.raise_error(F.lit(f"rows without {column}"))).otherwise(F.col(column).cast("string"))
    seen = Observation()
    # One token for each snapshot.
    rows = df.withColumn(column, token).observe(seen, F.array_sort(F.collect_set(column)).alias("tokens"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(table)
    for name in (tokens := seen.get["tokens"]):
        files.write_text(spark, f"{table}/{column}={name}/{COMPLETE}", "")
    return tokens


def write_json(df: DataFrame, folder: str, column: str, token: str) -> None:
    """Write one snapshot of a processed entity as JSON lines."""
    df.write.mode("overwrite").json(f"{folder}/{column}={token}")


def keep_latest(spark: SparkSession, table: str, column: str, keep: int = 1) -> list[str]:
    """Delete all but the newest complete snapshots and return the tokens removed."""
    old = snapshot_tokens(spark, table, column)[:-keep]
    for token in old:
        files.delete(spark, f"{table}/{column}={token}")
    return old
