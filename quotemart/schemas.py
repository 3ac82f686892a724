"""Table schemas and their constraints."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns, types and bounds every table has.
_SCHEMAS = {
    "regions": "region_id int, region_name string, region_market_type string, region_local_open string, "
    "region_local_close string, region_update_time_stamp timestamp_ntz",
    "industries": "industry_id int, industry_name string, industry_sector string, "
    "industry_update_time_stamp timestamp_ntz",
    "sicindustries": "sic_id int, sic_industry string, sic_sector string, "
    "sicindustry_update_time_stamp timestamp_ntz",
    "exchanges": "exchange_id int, exchange_region_id int, exchange_name string, "
    "exchange_update_time_stamp timestamp_ntz",
    "companies": "company_id int, company_exchange_id int, company_industry_id int, company_sic_id int, "
    "company_name string, company_cik string, company_ticker string, company_is_delisted boolean, "
    "company_category string, company_currency string, company_location string, "
    "company_update_time_stamp timestamp_ntz",
    "bars": "ticker string, open double, high double, low double, close double, volume double, vwap double, "
    "timestamp timestamp_ntz, transactions bigint, otc boolean",
    "bar_files": "file string, bytes bigint, modified bigint, days array<int>, readable boolean",
    "dim_date": "date_key int, full_date timestamp_ntz, day int, month int, year int, quarter int, "
    "day_of_week string, week_of_year int, is_weekend boolean, is_holiday boolean",
    "dim_company": "company_key int, company_ticker string, company_name string, company_category string, "
    "company_cik string, company_is_delisted boolean, company_location string, is_current boolean",
    "dim_industry": "industry_key int, industry_sector string, industry_name string, sic_industry string, "
    "sic_sector string, is_current boolean",
    "dim_exchange": "exchange_key int, exchange_name string, region_name string, region_market_type string, "
    "region_local_open string, region_local_close string, is_current boolean",
    "fact_stock_daily": "date_key int, company_key int, industry_key int, exchange_key int, "
    "open_price decimal(18,4), high_price decimal(18,4), low_price decimal(18,4), "
    "close_price decimal(18,4), volume bigint, price_change decimal(18,4), price_trend string",
}
_TYPES = {
    "int": T.IntegerType(),
    "array<int>": T.ArrayType(T.IntegerType()),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(18,4)": T.DecimalType(18, 4),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs; unlike a DDL parse it needs no running session."""
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS = {name: _schema(columns) for name, columns in _SCHEMAS.items()}

SOURCE_TABLES = ["regions", "exchanges", "industries", "sicindustries", "companies"]
DIMENSIONS = ["dim_date", "dim_company", "dim_industry", "dim_exchange"]
FACT = "fact_stock_daily"

STAMPS = {
    "regions": "region_update_time_stamp",
    "industries": "industry_update_time_stamp",
    "sicindustries": "sicindustry_update_time_stamp",
    "exchanges": "exchange_update_time_stamp",
    "companies": "company_update_time_stamp",
}

REQUIRED = {
    "regions": ["region_id", "region_name", "region_market_type", "region_local_open", "region_local_close"],
    "industries": ["industry_id", "industry_name", "industry_sector"],
    "sicindustries": ["sic_id", "sic_industry", "sic_sector"],
    "exchanges": ["exchange_id", "exchange_region_id", "exchange_name"],
    "companies": [
        "company_id",
        "company_exchange_id",
        "company_name",
        "company_cik",
        "company_ticker",
        "company_is_delisted",
    ],
    "dim_date": ["date_key"],
    "dim_company": ["company_key"],
    "dim_industry": ["industry_key"],
    "dim_exchange": ["exchange_key"],
    "fact_stock_daily": ["date_key", "company_key", "industry_key", "exchange_key"],
}

UNIQUE = {
    "regions": [["region_id"], ["region_name"]],
    "industries": [["industry_id"], ["industry_name", "industry_sector"]],
    "sicindustries": [["sic_id"], ["sic_industry", "sic_sector"]],
    "exchanges": [["exchange_id"], ["exchange_name"]],
    "companies": [["company_id"], ["company_ticker", "company_is_delisted"]],
    "dim_date": [["date_key"]],
    "dim_company": [["company_key"]],
    "dim_industry": [["industry_key"]],
    "dim_exchange": [["exchange_key"]],
}

# (table, column) -> (parent table, parent column)
FOREIGN = {
    ("exchanges", "exchange_region_id"): ("regions", "region_id"),
    ("companies", "company_exchange_id"): ("exchanges", "exchange_id"),
    ("companies", "company_industry_id"): ("industries", "industry_id"),
    ("companies", "company_sic_id"): ("sicindustries", "sic_id"),
    ("fact_stock_daily", "date_key"): ("dim_date", "date_key"),
    ("fact_stock_daily", "company_key"): ("dim_company", "company_key"),
    ("fact_stock_daily", "industry_key"): ("dim_industry", "industry_key"),
    ("fact_stock_daily", "exchange_key"): ("dim_exchange", "exchange_key"),
}

LENGTHS = {
    "regions": {"region_name": 50, "region_market_type": 50},
    "industries": {"industry_name": 255, "industry_sector": 255},
    "sicindustries": {"sic_industry": 255, "sic_sector": 255},
    "exchanges": {"exchange_name": 100},
    "companies": {
        "company_name": 255,
        "company_cik": 20,
        "company_ticker": 10,
        "company_category": 255,
        "company_currency": 10,
        "company_location": 255,
    },
}
