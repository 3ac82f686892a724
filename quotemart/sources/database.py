"""Reading the source tables from a relational database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotemart.operators.upsert import shaped
from quotemart.schemas import SCHEMAS, SOURCE_TABLES

# The numeric key each table is split by.
SPLIT_KEYS = {
    "regions": "region_id",
    "exchanges": "exchange_id",
    "industries": "industry_id",
    "sicindustries": "sic_id",
    "companies": "company_id",
}


def bounds_query(table: str) -> str:
    """Query for the key range of a table."""
    key = SPLIT_KEYS[table]
    return f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}"


def split_options(table: str, low: int | None, high: int | None, partitions: int) -> dict[str, str]:
    """Reader options that cut a table into key ranges, none for an empty or one-row table."""
    if low is None or high is None or low >= high or partitions < 2:
        return {"dbtable": table}
    return {
        "dbtable": table,
        "partitionColumn": SPLIT_KEYS[table],
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(partitions),
    }


def read_table(
    spark: SparkSession, table: str, url: str, properties: dict[str, str] | None = None, partitions: int = 16
) -> DataFrame:
    """One source table, read in key ranges by parallel tasks."""
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    span = reader.option("query", bounds_query(table)).load().first()
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    rows = reader.options(**split_options(table, span[0], span[1], partitions)).load()
    return shaped(rows, SCHEMAS[table])


def read_source(
    spark: SparkSession, url: str, properties: dict[str, str] | None = None, partitions: int = 16
) -> dict[str, DataFrame]:
    """All source tables."""
    return {t: read_table(spark, t, url, properties, partitions) for t in SOURCE_TABLES}
