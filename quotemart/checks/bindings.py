"""The given tables seen as feeds and source tables.

They keep traps on purpose: dangling and NULL keys, padding, mixed case, repeated rows, and one key
that holds a third of the company feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemart.operators.dedup import keep_first


# Column types of the given tables the checks read; stated, so opening a table reads no footer.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Given:
    """The given tables of one folder and what is derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table, opened once so that equal scans can be shared."""
        if name not in self.opened:
            self.opened[name] = self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]

    def regions(self) -> DataFrame:
        """Regions; times in nanoseconds, region 4 without an opening time."""
        key = F.col("r_regionkey")
        hour = 3_600_000_000_000
        return self.table("region").select(
            key.alias("region_id"),
            F.col("r_name").alias("region_name"),
            F.lit("Equity").alias("region_market_type"),
            F.when(key != 4, (key.cast("long") + 7) * hour).alias("region_local_open"),
            ((key.cast("long") + 15) * hour).alias("region_local_close"),
        )

    def exchanges(self) -> DataFrame:
        """Exchanges with padded names; one names a region that does not exist."""
        key = F.col("n_nationkey")
        return self.table("nation").select(
            key.alias("exchange_id"),
            F.when(key == 24, 99).otherwise(F.col("n_regionkey")).alias("exchange_region_id"),
            F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("exchange_name"),
        )

    def industries(self) -> DataFrame:
        """Industries 0, 1, ... by name."""
        names = self.table("part").select("p_type").distinct()
        # A handful of part types, at most one row each.
        rank = F.array_position(names_list(names, "p_type"), F.col("p_type")).cast("int") - 1
        return names.select(
            rank.alias("industry_id"),
            F.col("p_type").alias("industry_name"),
            F.concat(F.lit("Sector "), F.substring("p_type", 1, 1)).alias("industry_sector"),
        )

    def sics(self) -> DataFrame:
        """SIC rows 7000, 7001, ... by brand name."""
        names = self.table("part").select("p_brand").distinct()
        rank = F.array_position(names_list(names, "p_brand"), F.col("p_brand")).cast("int") - 1
        return names.select(
            (rank + 7000).alias("sic_id"),
            F.col("p_brand").alias("sic_industry"),
            F.concat(F.lit("SIC "), "p_brand").alias("sic_sector"),
        )

    def companies(self) -> DataFrame:
        """Companies with NULL and dangling industries, NULL SIC codes and padded mixed-case tickers."""
        key = F.col("s_suppkey")
        text = key.cast("string")
        return self.table("supplier").select(
            key.alias("company_id"),
            F.col("s_nationkey").alias("company_exchange_id"),
            F.when(key % 10 != 9, key % 7).alias("company_industry_id"),
            F.when(key % 4 != 3, key % 5 + 7000).alias("company_sic_id"),
            F.col("s_name").alias("company_name"),
            F.lpad(text, 10, "0").alias("company_cik"),
            F.concat(F.lit(" Sup"), text, F.lit(" ")).alias("company_ticker"),
            F.when(F.col("s_acctbal") < 0, 1).otherwise(0).alias("company_is_delisted"),
            F.lit("Domestic").alias("company_category"),
            F.lit("USA").alias("company_location"),
        )

    def companies_relisted(self) -> DataFrame:
        """Companies, and every third one again under the opposite flag and an upper-case ticker."""
        rows = self.companies()
        again = rows.where("company_id % 3 = 0").withColumns(
            {
                "company_id": F.col("company_id") + 1_000_000_000,
                "company_ticker": F.upper("company_ticker"),
                "company_is_delisted": 1 - F.col("company_is_delisted"),
                "company_location": F.lit("Relisted"),
            }
        )
        return rows.unionByName(again)

    def raw_bars(self) -> DataFrame:
        """Bars with several rows per ticker and time."""
        opened = F.col("l_extendedprice")
        closed = opened * (1 - F.col("l_discount") + F.col("l_tax"))
        return self.table("lineitem").select(
            F.concat(F.lit("SUP"), F.col("l_suppkey").cast("string")).alias("ticker"),
            (F.col("l_shipdate") + F.make_dt_interval(hours=F.lit(20))).alias("timestamp"),
            opened.alias("open"),
            closed.alias("close"),
            F.greatest(opened, closed).alias("high"),
            F.least(opened, closed).alias("low"),
            (F.col("l_quantity") + 0.5).alias("volume"),
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
        )

    def bars(self) -> DataFrame:
        """The first bar per ticker and time."""
        order = ["l_orderkey", "l_linenumber", "l_partkey", "open", "close", "volume"]
        kept = keep_first(self.raw_bars(), ["ticker", "timestamp"], [F.col(c) for c in order])
        return kept.drop("l_orderkey", "l_linenumber", "l_partkey")

    def markets(self) -> DataFrame:
        """A market per region listing its nations, a blank element and an exchange all regions share."""
        # 25 nations in all.
        listed = self.table("nation").groupBy("n_regionkey").agg(
            F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("_nations")
        )
        names = F.array_join(F.transform("_nations", lambda n: n["n_name"]), " , ")
        rows = self.table("region").join(listed, F.col("r_regionkey") == F.col("n_regionkey"))
        return rows.select(
            F.col("r_regionkey").alias("pos"),
            F.col("r_name").alias("region"),
            F.lit("Equity").alias("market_type"),
            F.concat(names, F.lit(", ,NATION_0")).alias("primary_exchanges"),
            F.lit("09:30").alias("local_open"),
            F.lit("16:00").alias("local_close"),
        )

    def market_feed(self) -> DataFrame:
        """A market entry per customer: few regions, many exchanges, ragged lists."""
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("pos"),
            F.when(key % 50 == 0, "").otherwise(F.col("c_mktsegment")).alias("region"),
            F.concat(F.lit("Type "), F.col("c_nationkey").cast("string")).alias("market_type"),
            F.concat(
                F.lit(" \tHUB\n, ,"),
                F.col("c_mktsegment"),
                F.lit(" X , EX"),
                (key - key % 4).cast("string"),
                F.lit(",, "),
            ).alias("primary_exchanges"),
            F.when(key % 7 == 0, "25:00").when(key % 4 != 2, "9:30").alias("local_open"),
            F.lit("16:00:05").alias("local_close"),
        )

    def company_feed(self) -> DataFrame:
        """A raw company row per customer; a third of them share one ticker."""
        key = F.col("c_custkey")
        text = key.cast("string")
        industry = (
            F.when(key % 13 == 0, "MISSING")
            .when(key % 3 == 0, "ECONOMY")
            .when(key % 3 == 1, "SMALL")
            .otherwise("LARGE")
        )
        code = (key % 30 + 7000).cast("string")
        return self.table("customer").select(
            key.alias("pos"),
            F.concat(F.lit("C"), text).alias("id"),
            F.when(key % 41 != 0, F.col("c_name")).alias("name"),
            F.when(key % 37 == 0, "")
            .when(key % 53 == 0, "TOOLONGTICKER")
            .when(key % 3 == 0, "THOT")
            .otherwise(F.concat(F.lit("T"), (key - key % 2).cast("string")))
            .alias("ticker"),
            F.when(key % 43 == 0, "").otherwise(F.lpad(text, 10, "0")).alias("cik"),
            F.lit(None).cast("string").alias("cusip"),
            F.when(key % 29 == 0, "UNKNOWN")
            .when(key % 31 == 0, "")
            .otherwise(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")))
            .alias("exchange"),
            F.when(key % 17 == 0, "no")
            .when(key % 23 == 0, "2")
            .when(key % 11 == 0, "0.0")
            .when(key % 7 == 0, "")
            .when(key % 19 != 0, (F.col("c_acctbal") < 0).cast("string"))
            .alias("isDelisted"),
            F.when(key % 5 != 0, F.col("c_mktsegment")).alias("category"),
            F.when(key % 47 != 0, F.concat(F.lit("Sector "), F.substring(industry, 1, 1))).alias("sector"),
            industry.alias("industry"),
            F.when(key % 10 == 0, None)
            .when(key % 9 == 0, "abc")
            .when(key % 8 == 0, F.concat(code, F.lit(".0")))
            .otherwise(F.concat(F.lit(" "), code))
            .alias("sic"),
            F.lit("USD").alias("currency"),
            F.concat(F.lit("Loc "), F.col("c_nationkey").cast("string")).alias("location"),
        )

    def loaded_exchanges(self) -> DataFrame:
        """Exchanges as the source database holds them."""
        return self.table("nation").select(
            (F.col("n_nationkey") + 1).alias("exchange_id"),
            (F.col("n_regionkey") + 1).alias("exchange_region_id"),
            F.col("n_name").alias("exchange_name"),
        )

    def loaded_companies(self) -> DataFrame:
        """Companies as the source database holds them before a batch."""
        key = F.col("s_suppkey")
        text = key.cast("string")
        return self.table("supplier").select(
            (key + 1).cast("int").alias("company_id"),
            (F.col("s_nationkey") + 1).alias("company_exchange_id"),
            F.lit(0).alias("company_industry_id"),
            F.lit(7000).alias("company_sic_id"),
            F.col("s_name").alias("company_name"),
            F.lpad(text, 10, "0").alias("company_cik"),
            F.concat(F.lit("T"), text).alias("company_ticker"),
            (F.col("s_acctbal") < 0).alias("company_is_delisted"),
            F.lit("Old").alias("company_category"),
            F.lit("USD").alias("company_currency"),
            F.lit("Old").alias("company_location"),
        )


def names_list(names: DataFrame, column: str) -> Column:
    """The sorted distinct names as a scalar subquery; used for the few part types and brands only."""
    listed = names.agg(F.array_sort(F.collect_set(column)).alias("names"))
    return listed.scalar()
