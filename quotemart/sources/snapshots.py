"""Reading table snapshots and finding the latest one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quotemart.sources import files

COMPLETE = "_SUCCESS"


def snapshot_tokens(spark: SparkSession, table: str, column: str) -> list[str]:
    """Tokens of the completely written snapshots of a table, oldest first."""
    prefix = f"{column}="
    names = [n for n in files.names(spark, table) if n.startswith(prefix)]
    done = [n for n in names if files.exists(spark, f"{table}/{n}/{COMPLETE}")]
    return sorted(n[len(prefix) :] for n in done)


def latest_token(spark: SparkSession, table: str, column: str) -> str | None:
    """Greatest token of a table."""
    tokens = snapshot_tokens(spark, table, column)
    return tokens[-1] if tokens else None


def read_snapshot(
    spark: SparkSession, table: str, column: str, schema: StructType, token: str | None = None
) -> DataFrame:
    """One snapshot, by default the latest; only its folder is listed. Empty if there is none."""
    token = token or latest_token(spark, table, column)
    if token is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table}/{column}={token}")


def read_all_snapshots(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """All snapshots of a table with their token column."""
    return spark.read.schema(schema).parquet(table)


def only_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows of the greatest token; a single-row semi join, so no rows are shuffled."""
    newest = df.agg(F.max(column).alias(column))
    return df.join(F.broadcast(newest), column, "left_semi")
