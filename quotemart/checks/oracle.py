"""SQL giving the rows of the check queries, written for DuckDB over the given tables."""

from __future__ import annotations

import re

# Named parts; a query pulls in the parts its text names.
PARTS = {
    "fx_regions": """
        SELECT r_regionkey AS region_id, r_name AS region_name, 'Equity' AS region_market_type,
            CASE WHEN r_regionkey = 4 THEN NULL ELSE CAST(7 + r_regionkey AS BIGINT) * 3600000000000 END AS region_local_open,
            CAST(15 + r_regionkey AS BIGINT) * 3600000000000 AS region_local_close
        FROM region""",
    "fx_exchanges": """
        SELECT n_nationkey AS exchange_id, CASE WHEN n_nationkey = 24 THEN 99 ELSE n_regionkey END AS exchange_region_id,
            concat(' ', n_name, ' ') AS exchange_name
        FROM nation""",
    "fx_industries": """
        SELECT DISTINCT dense_rank() OVER (ORDER BY p_type) - 1 AS industry_id, p_type AS industry_name,
            concat('Sector ', substr(p_type, 1, 1)) AS industry_sector
        FROM part""",
    "fx_sicindustries": """
        SELECT DISTINCT 7000 + dense_rank() OVER (ORDER BY p_brand) - 1 AS sic_id, p_brand AS sic_industry,
            concat('SIC ', p_brand) AS sic_sector
        FROM part""",
    "fx_companies": """
        SELECT s_suppkey AS company_id, s_nationkey AS company_exchange_id,
            CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_suppkey % 7 END AS company_industry_id,
            CASE WHEN s_suppkey % 4 = 3 THEN NULL ELSE 7000 + s_suppkey % 5 END AS company_sic_id,
            s_name AS company_name, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS company_cik,
            concat(' Sup', CAST(s_suppkey AS VARCHAR), ' ') AS company_ticker,
            CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS company_is_delisted,
            'Domestic' AS company_category, 'USA' AS company_location
        FROM supplier""",
    "fx_bars_raw": """
        SELECT concat('SUP', CAST(l_suppkey AS VARCHAR)) AS ticker, l_shipdate + INTERVAL '20' HOUR AS "timestamp",
            l_extendedprice AS open, l_extendedprice * (1 - l_discount + l_tax) AS close,
            greatest(l_extendedprice, l_extendedprice * (1 - l_discount + l_tax)) AS high,
            least(l_extendedprice, l_extendedprice * (1 - l_discount + l_tax)) AS low,
            l_quantity + 0.5 AS volume, l_orderkey, l_linenumber, l_partkey
        FROM lineitem""",
    "fx_bars": """
        SELECT ticker, "timestamp", open, high, low, close, volume
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker, "timestamp"
            ORDER BY l_orderkey, l_linenumber, l_partkey, open, close, volume) AS rn FROM fx_bars_raw) q
        WHERE rn = 1""",
    "fx_markets": """
        SELECT r_regionkey AS pos, r_name AS region, 'Equity' AS market_type,
            concat(string_agg(n_name, ' , ' ORDER BY n_nationkey), ', ,NATION_0') AS primary_exchanges,
            '09:30' AS local_open, '16:00' AS local_close
        FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name""",
    "market_feed": """
        SELECT c_custkey AS pos, CASE WHEN c_custkey % 50 = 0 THEN '' ELSE c_mktsegment END AS region,
            concat('Type ', CAST(c_nationkey AS VARCHAR)) AS market_type,
            concat(' ', chr(9), 'HUB', chr(10), ', ,', c_mktsegment, ' X , EX',
                CAST(c_custkey - c_custkey % 4 AS VARCHAR), ',, ') AS primary_exchanges,
            CASE WHEN c_custkey % 7 = 0 THEN '25:00' WHEN c_custkey % 4 <> 2 THEN '9:30' END AS local_open, '16:00:05' AS local_close
        FROM customer""",
    "industry_choice": """
        SELECT *, CASE WHEN c_custkey % 13 = 0 THEN 'MISSING' WHEN c_custkey % 3 = 0 THEN 'ECONOMY'
            WHEN c_custkey % 3 = 1 THEN 'SMALL' ELSE 'LARGE' END AS industry
        FROM customer""",
    "company_feed": """
        SELECT c_custkey AS pos, concat('C', CAST(c_custkey AS VARCHAR)) AS id,
            CASE WHEN c_custkey % 41 <> 0 THEN c_name END AS name,
            CASE WHEN c_custkey % 37 = 0 THEN '' WHEN c_custkey % 53 = 0 THEN 'TOOLONGTICKER'
                WHEN c_custkey % 3 = 0 THEN 'THOT'
                ELSE concat('T', CAST(c_custkey - c_custkey % 2 AS VARCHAR)) END AS ticker,
            CASE WHEN c_custkey % 43 = 0 THEN '' ELSE lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS cik,
            CASE WHEN c_custkey % 29 = 0 THEN 'UNKNOWN' WHEN c_custkey % 31 = 0 THEN ''
                ELSE concat('NATION_', CAST(c_nationkey AS VARCHAR)) END AS exchange,
            CASE WHEN c_custkey % 17 = 0 OR c_custkey % 23 = 0 THEN true WHEN c_custkey % 11 = 0 OR c_custkey % 7 = 0 THEN false
                WHEN c_custkey % 19 <> 0 THEN c_acctbal < 0 END AS isDelisted,
            CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS category,
            CASE WHEN c_custkey % 47 <> 0 THEN concat('Sector ', substr(industry, 1, 1)) END AS sector,
            industry,
            CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 9 = 0 THEN 'abc'
                WHEN c_custkey % 8 = 0 THEN concat(CAST(7000 + c_custkey % 30 AS VARCHAR), '.0')
                ELSE concat(' ', CAST(7000 + c_custkey % 30 AS VARCHAR)) END AS sic,
            'USD' AS currency, concat('Loc ', CAST(c_nationkey AS VARCHAR)) AS location
        FROM industry_choice""",
    "loaded_companies": """
        SELECT s_suppkey + 1 AS company_id, s_nationkey + 1 AS company_exchange_id, 0 AS company_industry_id,
            7000 AS company_sic_id, s_name AS company_name, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS company_cik,
            concat('T', CAST(s_suppkey AS VARCHAR)) AS company_ticker, s_acctbal < 0 AS company_is_delisted,
            'Old' AS company_category, 'USD' AS company_currency, 'Old' AS company_location
        FROM supplier""",
    "company_checked": """
        SELECT f.*, coalesce(isDelisted, false) AS delisted, n_nationkey + 1 AS exchange_id, i.industry_id AS industry_id,
            s.sic_id AS sic_id, l.company_id IS NOT NULL AS known,
            CASE WHEN coalesce(ticker, '') = '' OR coalesce(name, '') = '' OR coalesce(cik, '') = '' THEN 'no ticker, name or cik'
                WHEN n_nationkey IS NULL AND exchange <> '' THEN 'unknown exchange'
                WHEN n_nationkey IS NULL THEN 'no exchange'
                WHEN length(ticker) > 10 OR length(cik) > 20 OR length(name) > 255 THEN 'too long' END AS fault
        FROM company_feed f
        LEFT JOIN nation ON n_name = exchange
        LEFT JOIN fx_industries i ON i.industry_name = industry AND i.industry_sector = sector
        LEFT JOIN fx_sicindustries s ON s.sic_id =
            CASE WHEN regexp_full_match(trim(sic), '[+-]?[0-9]+') THEN TRY_CAST(trim(sic) AS INTEGER) END
        LEFT JOIN loaded_companies l ON l.company_ticker = ticker
            AND l.company_is_delisted = coalesce(isDelisted, false)""",
    "company_batch": """
        SELECT *, CASE WHEN fault IN ('no ticker, name or cik', 'no exchange') THEN 'skipped'
                WHEN fault IS NOT NULL THEN 'error' WHEN known THEN 'updated'
                WHEN place = 1 THEN 'inserted' ELSE 'skipped' END AS disposition,
            CASE WHEN fault IS NULL AND NOT known AND place > 1 THEN 'repeated in batch' ELSE fault END AS reason
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker, delisted, fault IS NULL ORDER BY pos) AS place,
            row_number() OVER (PARTITION BY ticker, delisted, fault IS NULL ORDER BY pos DESC) AS place_from_end
            FROM company_checked) q""",
    "exchange_batch": """
        SELECT s_suppkey AS pos, CASE WHEN s_suppkey % 13 = 0 THEN '' ELSE s_name END AS exchange_name,
            CASE WHEN s_suppkey % 17 = 0 THEN 'NOWHERE' WHEN s_suppkey % 19 = 0 THEN lower(r_name) ELSE r_name END AS region
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "exchange_resolved": """
        SELECT pos, exchange_name, b.region, r_regionkey AS exchange_region_id,
            CASE WHEN exchange_name = '' THEN 'skipped' WHEN r_regionkey IS NULL THEN 'error' ELSE 'inserted' END AS disposition,
            CASE WHEN exchange_name = '' THEN 'no name' WHEN r_regionkey IS NULL THEN 'unknown region' END AS reason
        FROM exchange_batch b LEFT JOIN region ON r_name = b.region""",
    "date_rows": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS TIMESTAMP) AS full_date,
            CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year,
            CAST(quarter(d) AS INTEGER) AS quarter, dayname(d) AS day_of_week, CAST(week(d) AS INTEGER) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend, false AS is_holiday
        FROM (SELECT DISTINCT CAST("timestamp" AS DATE) AS d FROM fx_bars_raw) q""",
    "dim_company_rows": """
        SELECT company_ticker, company_name, company_category, company_cik,
            company_is_delisted = 1 AS company_is_delisted, company_location
        FROM fx_companies""",
    "dim_company": """
        SELECT row_number() OVER (ORDER BY md5(lower(trim(company_ticker)))) AS company_key, *, true AS is_current
        FROM dim_company_rows""",
    "dim_exchange_rows": """
        SELECT exchange_name, region_name, region_market_type,
            CASE WHEN region_local_open IS NULL THEN '00:00:00'
                ELSE concat(lpad(CAST(region_local_open // 3600000000000 AS VARCHAR), 2, '0'), ':00:00') END AS region_local_open,
            CASE WHEN region_local_close IS NULL THEN '00:00:00'
                ELSE concat(lpad(CAST(region_local_close // 3600000000000 AS VARCHAR), 2, '0'), ':00:00') END AS region_local_close
        FROM fx_exchanges LEFT JOIN fx_regions ON exchange_region_id = region_id""",
    "dim_exchange": """
        SELECT row_number() OVER (ORDER BY md5(trim(exchange_name))) AS exchange_key, *, true AS is_current
        FROM dim_exchange_rows""",
    "dim_industry_rows": """
        SELECT industry_sector, industry_name, sic_industry, sic_sector
        FROM (SELECT *, row_number() OVER (PARTITION BY industry_sector, industry_name
                ORDER BY sic_id NULLS LAST, company_id) AS rn
            FROM fx_companies LEFT JOIN fx_industries ON company_industry_id = industry_id
            LEFT JOIN fx_sicindustries ON company_sic_id = sic_id
            WHERE industry_sector IS NOT NULL AND industry_name IS NOT NULL) q
        WHERE rn = 1""",
    "dim_industry": """
        SELECT row_number() OVER (ORDER BY md5(concat(industry_sector, '_', industry_name))) AS industry_key, *,
            true AS is_current
        FROM dim_industry_rows""",
    "fact": """
        SELECT date_key, company_key, industry_key, exchange_key,
            CAST(CAST(open AS DECIMAL(18,4)) AS DOUBLE) AS open_price, CAST(CAST(high AS DECIMAL(18,4)) AS DOUBLE) AS high_price,
            CAST(CAST(low AS DECIMAL(18,4)) AS DOUBLE) AS low_price, CAST(CAST(close AS DECIMAL(18,4)) AS DOUBLE) AS close_price,
            volume, CAST(CAST(price_change AS DECIMAL(18,4)) AS DOUBLE) AS price_change,
            CASE WHEN price_change > 0 THEN 'up' WHEN price_change < 0 THEN 'down' ELSE 'unchanged' END AS price_trend
        FROM (
            SELECT DISTINCT CAST(strftime(b."timestamp", '%Y%m%d') AS INTEGER) AS date_key, CAST(c.company_key AS INTEGER) AS company_key,
                CAST(i.industry_key AS INTEGER) AS industry_key, CAST(e.exchange_key AS INTEGER) AS exchange_key,
                b.open, b.high, b.low, b.close, CAST(floor(b.volume) AS BIGINT) AS volume, b.close - b.open AS price_change
            FROM fx_bars b
            JOIN fx_companies fc ON trim(lower(b.ticker)) = trim(lower(fc.company_ticker))
            JOIN dim_company c ON trim(lower(b.ticker)) = trim(lower(c.company_ticker))
            JOIN fx_exchanges fe ON fc.company_exchange_id = fe.exchange_id
            JOIN dim_exchange e ON trim(fe.exchange_name) = trim(e.exchange_name)
            JOIN fx_industries fi ON fc.company_industry_id = fi.industry_id
            JOIN dim_industry i ON trim(fi.industry_name) = trim(i.industry_name)
                AND trim(fi.industry_sector) = trim(i.industry_sector)) q""",
    "first_dim": """
        SELECT CAST(row_number() OVER (ORDER BY md5(lower(trim(company_ticker)))) AS INTEGER) AS company_key, r.*,
            true AS is_current
        FROM dim_company_rows r WHERE CAST(company_cik AS BIGINT) % 7 <> 3""",
    "next_rows": """
        SELECT * REPLACE (CASE WHEN CAST(company_cik AS BIGINT) % 5 = 0 THEN 'Moved' ELSE company_location END AS company_location)
        FROM dim_company_rows WHERE CAST(company_cik AS BIGINT) % 11 <> 4 OR CAST(company_cik AS BIGINT) % 7 = 3""",
}

ORACLE = {
    "fact_stock_daily": "SELECT * FROM fact",
    "dim_date": "SELECT * FROM date_rows",
    "dim_company": """
        SELECT company_ticker, company_name, company_category, company_cik, company_is_delisted = 1 AS company_is_delisted,
            company_location
        FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(company_ticker)) ORDER BY company_is_delisted, company_id) AS rn
            FROM (SELECT * FROM fx_companies UNION ALL
                SELECT * REPLACE (company_id + 1000000000 AS company_id, upper(company_ticker) AS company_ticker,
                    1 - company_is_delisted AS company_is_delisted, 'Relisted' AS company_location)
                FROM fx_companies WHERE company_id % 3 = 0) u) q
        WHERE rn = 1""",
    "dim_exchange": "SELECT * FROM dim_exchange_rows",
    "dim_industry": "SELECT * FROM dim_industry_rows",
    "bars_dedup_first": "SELECT * FROM fx_bars",
    "bars_unreadable": "SELECT event_id FROM events WHERE event_id % 17 = 0",
    "bars_key_fallback": """
        SELECT event_id, CASE WHEN event_id % 10 <> 4 THEN event_type END AS ticker,
            CAST(json_extract_string(props, '$.k') AS DOUBLE) AS open, CAST(NULL AS DOUBLE) AS high,
            CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS close,
            CAST(json_extract_string(props, '$.k') AS DOUBLE) + 0.5 AS volume, CAST(NULL AS DOUBLE) AS vwap,
            make_timestamp(event_id * 86400123 * 1000) AS "timestamp", event_id AS transactions,
            CASE event_id % 3 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS otc,
            event_id * 86400123 AS millis
        FROM events WHERE event_id % 17 <> 0""",
    "price_trend_by_bar": """
        SELECT l_orderkey, l_linenumber, l_partkey, ticker,
            CAST(CAST(close - open AS DECIMAL(18,4)) AS DOUBLE) AS price_change,
            CASE WHEN close - open > 0 THEN 'up' WHEN close - open < 0 THEN 'down' ELSE 'unchanged' END AS price_trend
        FROM fx_bars_raw""",
    "exchange_explode": """
        SELECT min(pos) AS pos, md5(name) AS id, name, arg_min(region, pos) AS region, arg_min(market_type, pos) AS market_type,
            arg_min_null(local_open, pos) AS local_open, arg_min(local_close, pos) AS local_close
        FROM (SELECT * REPLACE (trim(name) AS name) FROM
            (SELECT *, unnest(string_split(primary_exchanges, ',')) AS name FROM fx_markets) u) q
        WHERE name <> '' GROUP BY name""",
    "exchanges_first_wins": r"""
        SELECT min(pos) AS pos, md5(name) AS id, name, arg_min(region, pos) AS region, arg_min(market_type, pos) AS market_type,
            arg_min_null(local_open, pos) AS local_open, arg_min(local_close, pos) AS local_close
        FROM (SELECT * REPLACE (regexp_replace(name, '^\s+|\s+$', '', 'g') AS name) FROM
            (SELECT *, unnest(string_split(primary_exchanges, ',')) AS name FROM market_feed) u) q
        WHERE name <> '' GROUP BY name""",
    "regions_first_wins": """
        SELECT min(pos) AS pos, md5(region) AS id, region, arg_min(market_type, pos) AS market_type,
            arg_min_null(local_open, pos) AS local_open, arg_min(local_close, pos) AS local_close
        FROM market_feed WHERE region <> '' GROUP BY region""",
    "industries_first_wins": """
        SELECT min(p_partkey) AS pos, md5(concat(CASE WHEN sector IS NULL THEN 'None' ELSE sector END, '_', industry)) AS id, sector, industry
        FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 = 3 THEN '' WHEN p_partkey % 9 <> 0 THEN p_type END AS sector, p_brand AS industry
            FROM part WHERE p_partkey % 8 <> 0) q
        GROUP BY sector, industry""",
    "sic_first_wins": """
        SELECT min(p_partkey) AS pos, md5(CAST(p_size AS VARCHAR)) AS id, CAST(p_size AS VARCHAR) AS sic,
            arg_min_null(CASE WHEN p_partkey % 5 <> 0 THEN p_type END, p_partkey) AS sicSector,
            arg_min(p_brand, p_partkey) AS sicIndustry
        FROM part WHERE p_partkey % 8 <> 0 GROUP BY p_size""",
    "sic_int_cast": """
        SELECT p_partkey AS pos, CASE WHEN p_partkey % 6 IN (0, 3) THEN CAST(replace(p_brand, 'Brand#', '') AS INTEGER) END AS sic_id,
            CASE WHEN p_partkey % 6 IN (0, 3) THEN 'inserted' ELSE 'skipped' END AS disposition,
            CASE WHEN p_partkey % 6 NOT IN (0, 3) THEN 'bad number' END AS reason
        FROM part WHERE p_partkey % 6 <> 1""",
    "markets_envelope": """
        SELECT c_custkey, n AS pos, c_mktsegment AS region, 'Equity' AS market_type,
            CASE WHEN c_custkey % 2 = 0 THEN '09:30' ELSE '' END AS local_open, '' AS local_close, c_name AS primary_exchanges
        FROM customer, (VALUES (0), (1)) AS twice(n) WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0""",
    "company_projection": """
        SELECT id, name, ticker, cik, exchange, isDelisted, category, sector, industry, sic, currency, location FROM company_feed
        UNION ALL
        SELECT id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM company_feed""",
    "companies_per_exchange_limit": """
        SELECT pos, c_name, exchange FROM (
            SELECT c_custkey AS pos, c_name, c_mktsegment AS exchange,
                row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS rn
            FROM customer) q
        WHERE rn <= 50""",
    "company_lists_union": """
        WITH ends AS (SELECT c_mktsegment AS seg, max(c_custkey) + 1 AS n FROM customer GROUP BY c_mktsegment)
        SELECT CAST(c_custkey + coalesce((SELECT sum(n) FROM ends WHERE seg < c_mktsegment), 0) AS BIGINT) AS pos, c_name, c_mktsegment
        FROM customer WHERE c_mktsegment IS NOT NULL""",
    "resolve_exchange_rows": "SELECT * FROM exchange_resolved",
    "resolve_company_rows": """
        SELECT pos, ticker AS company_ticker, delisted AS company_is_delisted, exchange_id AS company_exchange_id,
            CAST(industry_id AS INTEGER) AS company_industry_id, CAST(sic_id AS INTEGER) AS company_sic_id, known, disposition, reason
        FROM company_batch""",
    "load_dispositions": """
        SELECT 'companies' AS entity, disposition, count(*) AS "rows" FROM company_batch GROUP BY disposition
        UNION ALL SELECT 'exchanges', disposition, count(*) FROM exchange_resolved GROUP BY disposition
        UNION ALL SELECT 'regions', disposition, count(*) FROM
            (SELECT CASE WHEN arg_min_null(local_open, pos) = '9:30' THEN 'inserted' ELSE 'skipped' END AS disposition
            FROM market_feed WHERE region <> '' GROUP BY region) q GROUP BY disposition
        UNION ALL SELECT 'industries', CASE WHEN sector IS NULL THEN 'skipped' ELSE 'inserted' END, count(*) FROM
            (SELECT DISTINCT sector, industry FROM company_feed) q GROUP BY ALL""",
    "upsert_regions": """
        WITH old AS (SELECT CAST(c_custkey + 1 AS INTEGER) AS region_id, c_name AS region_name, c_mktsegment AS region_market_type,
                '09:30:00' AS region_local_open, '16:00:00' AS region_local_close FROM customer WHERE c_custkey % 2 = 0),
            new AS (SELECT c_name AS region_name, 'Equity' AS region_market_type, '08:00:00' AS region_local_open,
                CASE WHEN c_custkey % 9 <> 0 THEN '17:00:00' END AS region_local_close FROM customer WHERE c_custkey % 2 = 1 OR c_custkey % 3 = 0)
        SELECT o.* FROM old o ANTI JOIN new n USING (region_name)
        UNION ALL SELECT o.region_id, n.* FROM old o JOIN new n USING (region_name)
        UNION ALL SELECT CAST((SELECT max(region_id) FROM old) + row_number() OVER (ORDER BY md5(region_name)) AS INTEGER), n.*
            FROM new n ANTI JOIN old o USING (region_name)""",
    "upsert_exchanges": """
        WITH old AS (SELECT CAST(c_custkey + 1 AS INTEGER) AS exchange_id, c_nationkey + 1 AS exchange_region_id, c_name AS exchange_name
                FROM customer WHERE c_custkey % 2 = 0),
            new AS (SELECT (c_nationkey + 1) % 25 + 1 AS exchange_region_id, c_name AS exchange_name
                FROM customer WHERE c_custkey % 2 = 1 OR c_custkey % 3 = 0)
        SELECT o.* FROM old o ANTI JOIN new n USING (exchange_name)
        UNION ALL SELECT o.exchange_id, n.* FROM old o JOIN new n USING (exchange_name)
        UNION ALL SELECT CAST((SELECT max(exchange_id) FROM old) + row_number() OVER (ORDER BY md5(exchange_name)) AS INTEGER), n.*
            FROM new n ANTI JOIN old o USING (exchange_name)""",
    "upsert_sic_codes": """
        WITH old AS (SELECT p_partkey AS sic_id, p_partkey AS src FROM part WHERE p_partkey % 2 = 0),
            new AS (SELECT p_partkey AS sic_id, CASE WHEN p_partkey % 5 = 0 THEN p_partkey - p_partkey % 2 + 2
                WHEN p_partkey % 7 = 0 THEN -7 ELSE -p_partkey - 100 END AS src FROM part WHERE p_partkey % 2 = 1 OR p_partkey % 3 = 0),
            effective AS (SELECT n.* FROM new n
                WHERE NOT EXISTS (SELECT 1 FROM old h WHERE h.src = n.src AND h.sic_id <> n.sic_id)
                AND NOT EXISTS (SELECT 1 FROM new e WHERE e.src = n.src AND e.sic_id < n.sic_id
                    AND NOT EXISTS (SELECT 1 FROM old h WHERE h.src = e.src AND h.sic_id <> e.sic_id)))
        SELECT CAST(sic_id AS INTEGER) AS sic_id, concat('I', CAST(src AS VARCHAR)) AS sic_industry,
            concat('S', CAST(src % 7 AS VARCHAR)) AS sic_sector
        FROM (SELECT coalesce(o.sic_id, e.sic_id) AS sic_id, coalesce(e.src, o.src) AS src
            FROM old o FULL JOIN effective e ON o.sic_id = e.sic_id) q""",
    "insert_industries": """
        WITH pairs AS (SELECT DISTINCT p_brand AS industry_name, p_type AS industry_sector FROM part),
            old AS (SELECT CAST(row_number() OVER (ORDER BY md5(concat(industry_name, '_', industry_sector))) AS INTEGER) AS industry_id, *
                FROM pairs WHERE length(industry_name) % 2 = 0)
        SELECT * FROM old
        UNION ALL SELECT CAST((SELECT max(industry_id) FROM old)
            + row_number() OVER (ORDER BY md5(concat(industry_name, '_', industry_sector))) AS INTEGER), p.*
        FROM pairs p WHERE length(industry_name) % 2 <> 0""",
    "companies_insert_update": """
        WITH winners AS (SELECT * FROM company_batch WHERE disposition = 'inserted'
            OR (disposition = 'updated' AND place_from_end = 1))
        SELECT * REPLACE (CAST(company_id AS INTEGER) AS company_id, CAST(company_industry_id AS INTEGER) AS company_industry_id,
            CAST(company_sic_id AS INTEGER) AS company_sic_id) FROM (
        SELECT l.* FROM loaded_companies l WHERE NOT EXISTS (SELECT 1 FROM winners w
            WHERE w.ticker = l.company_ticker AND w.delisted = l.company_is_delisted)
        UNION ALL
        SELECT l.company_id, w.exchange_id, w.industry_id, w.sic_id, w.name, w.cik, w.ticker, w.delisted,
            w.category, w.currency, w.location
        FROM loaded_companies l JOIN winners w ON w.ticker = l.company_ticker AND w.delisted = l.company_is_delisted
        UNION ALL
        SELECT (SELECT max(company_id) FROM loaded_companies)
                + row_number() OVER (ORDER BY md5(concat(w.ticker, '_', CAST(w.delisted AS VARCHAR)))),
            w.exchange_id, w.industry_id, w.sic_id, w.name, w.cik, w.ticker, w.delisted, w.category, w.currency, w.location
        FROM winners w WHERE NOT w.known) q""",
    "dim_date_insert_absent": "SELECT * REPLACE (year < 1999 AS is_holiday) FROM date_rows",
    "fact_replace_days": """
        SELECT * REPLACE (CASE WHEN date_key % 10 = 5 THEN volume + 1 ELSE volume END AS volume)
        FROM fact WHERE date_key % 10 <> 0""",
    "fact_null_purge": "SELECT * FROM fact WHERE company_key % 10 <> 0",
    "dims_append_current": """
        SELECT * FROM first_dim
        UNION ALL SELECT CAST((SELECT max(company_key) FROM first_dim)
            + row_number() OVER (ORDER BY md5(lower(trim(company_ticker)))) AS INTEGER), n.*, true FROM next_rows n""",
    "dims_scd2": """
        WITH fresh AS (SELECT n.* FROM next_rows n WHERE NOT EXISTS (SELECT 1 FROM first_dim f
            WHERE f.company_ticker = n.company_ticker AND f.company_location = n.company_location))
        SELECT f.* REPLACE (NOT EXISTS (SELECT 1 FROM fresh x WHERE x.company_ticker = f.company_ticker) AS is_current)
        FROM first_dim f
        UNION ALL SELECT CAST((SELECT max(company_key) FROM first_dim)
            + row_number() OVER (ORDER BY md5(lower(trim(company_ticker)))) AS INTEGER), n.*, true FROM fresh n""",
    "surrogate_keys": """
        SELECT c_name, CAST((SELECT max(c_custkey) FROM customer WHERE c_custkey % 2 = 0)
            + row_number() OVER (ORDER BY md5(c_name)) AS INTEGER) AS id
        FROM customer WHERE c_custkey % 2 = 1""",
    "latest_snapshot": """
        SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y_%m_01') AS token,
            CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS snapshot_date
        FROM orders WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)""",
    "trading_date_rollback": """
        SELECT CAST(d AS TIMESTAMP) AS today,
            CAST(d - 1 - CASE isodow(d - 1) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS TIMESTAMP) AS trading_day,
            CAST(d - 3 - CASE isodow(d - 3) WHEN 6 THEN 1 WHEN 7 THEN 2 ELSE 0 END AS TIMESTAMP) AS trading_day_3,
            CAST(d - 1 AS TIMESTAMP) AS landing_day
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) q""",
    "time_of_day_texts": """
        SELECT o_orderkey, coalesce(clock, '00:00:00') AS local_open,
            CASE WHEN o_orderkey % 13 <> 0 THEN coalesce(clock, '00:00:00') END AS spelled
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN
            strftime(to_timestamp(o_orderkey * 7919 % 86400) AT TIME ZONE 'UTC', '%H:%M:%S') END AS clock FROM orders) q""",
    "quality_not_null": """
        WITH counted(t, c, v) AS (
            SELECT 'regions', unnest(['region_id', 'region_name', 'region_market_type', 'region_local_close']), 0
            UNION ALL SELECT 'regions', 'region_local_open', count(*) FILTER (region_local_open IS NULL) FROM fx_regions
            UNION ALL SELECT 'industries', unnest(['industry_id', 'industry_name', 'industry_sector']), 0
            UNION ALL SELECT 'sicindustries', unnest(['sic_id', 'sic_industry', 'sic_sector']), 0
            UNION ALL SELECT 'exchanges', unnest(['exchange_id', 'exchange_region_id', 'exchange_name']), 0
            UNION ALL SELECT 'companies', unnest(['company_id', 'company_exchange_id', 'company_name', 'company_cik',
                'company_ticker', 'company_is_delisted']), 0
            UNION ALL SELECT 'dim_date', 'date_key', count(*) FILTER (date_key IS NULL) FROM date_rows
            UNION ALL SELECT 'dim_company', 'company_key', count(*) FILTER (company_key IS NULL) FROM dim_company
            UNION ALL SELECT 'dim_industry', 'industry_key', count(*) FILTER (industry_key IS NULL) FROM dim_industry
            UNION ALL SELECT 'dim_exchange', 'exchange_key', count(*) FILTER (exchange_key IS NULL) FROM dim_exchange
            UNION ALL SELECT 'fact_stock_daily', unnest(['date_key', 'company_key', 'industry_key', 'exchange_key']),
                count(*) FILTER (date_key IS NULL) FROM fact)
        SELECT t AS "table", 'not null' AS "rule", c AS "columns", CAST(v AS BIGINT) AS violations FROM counted""",
    "quality_unique": """
        WITH counted(t, c, v) AS (
            SELECT 'companies', 'company_ticker, company_is_delisted', count(*) FROM (
                SELECT 1 FROM fx_companies GROUP BY substr(company_ticker, 1, 6), company_is_delisted HAVING count(*) > 1) q
            UNION ALL SELECT 'companies', 'company_id', 0
            UNION ALL SELECT 'regions', unnest(['region_id', 'region_name']), 0
            UNION ALL SELECT 'industries', unnest(['industry_id', 'industry_name, industry_sector']), 0
            UNION ALL SELECT 'sicindustries', unnest(['sic_id', 'sic_industry, sic_sector']), 0
            UNION ALL SELECT 'exchanges', unnest(['exchange_id', 'exchange_name']), 0
            UNION ALL SELECT 'dim_date', 'date_key', 0 UNION ALL SELECT 'dim_company', 'company_key', 0
            UNION ALL SELECT 'dim_industry', 'industry_key', 0 UNION ALL SELECT 'dim_exchange', 'exchange_key', 0)
        SELECT t AS "table", 'unique' AS "rule", c AS "columns", CAST(v AS BIGINT) AS violations FROM counted""",
    "quality_foreign_keys": """
        WITH counted(t, c, v) AS (
            SELECT 'exchanges', 'exchange_region_id', count(*) FROM fx_exchanges
                WHERE exchange_region_id NOT IN (SELECT region_id FROM fx_regions)
            UNION ALL SELECT 'companies', 'company_exchange_id', count(*) FROM fx_companies
                WHERE company_exchange_id NOT IN (SELECT exchange_id FROM fx_exchanges)
            UNION ALL SELECT 'companies', 'company_industry_id', count(*) FROM fx_companies
                WHERE company_industry_id NOT IN (SELECT industry_id FROM fx_industries)
            UNION ALL SELECT 'companies', 'company_sic_id', count(*) FROM fx_companies
                WHERE company_sic_id NOT IN (SELECT sic_id FROM fx_sicindustries)
            UNION ALL SELECT 'fact_stock_daily', 'date_key', count(*) FROM fact
                WHERE date_key NOT IN (SELECT date_key FROM date_rows)
            UNION ALL SELECT 'fact_stock_daily', 'company_key', count(*) FROM fact
                WHERE company_key NOT IN (SELECT company_key FROM dim_company)
            UNION ALL SELECT 'fact_stock_daily', 'industry_key', count(*) FROM fact
                WHERE industry_key NOT IN (SELECT industry_key FROM dim_industry)
            UNION ALL SELECT 'fact_stock_daily', 'exchange_key', count(*) FROM fact
                WHERE exchange_key NOT IN (SELECT exchange_key FROM dim_exchange))
        SELECT t AS "table", 'foreign key' AS "rule", c AS "columns", CAST(v AS BIGINT) AS violations FROM counted""",
    "quality_length": """
        WITH counted(t, c, v) AS (
            SELECT 'companies', 'company_name', count(*) FILTER (length(name) > 255) FROM company_feed
            UNION ALL SELECT 'companies', 'company_cik', count(*) FILTER (length(cik) > 20) FROM company_feed
            UNION ALL SELECT 'companies', 'company_ticker', count(*) FILTER (length(ticker) > 10) FROM company_feed
            UNION ALL SELECT 'companies', 'company_category', count(*) FILTER (length(category) > 255) FROM company_feed
            UNION ALL SELECT 'companies', 'company_currency', count(*) FILTER (length(currency) > 10) FROM company_feed
            UNION ALL SELECT 'companies', 'company_location', count(*) FILTER (length(location) > 255) FROM company_feed
            UNION ALL SELECT 'customer', 'c_name', count(*) FILTER (length(c_name) > 10) FROM customer
            UNION ALL SELECT 'customer', 'c_mktsegment', count(*) FILTER (length(c_mktsegment) > 9) FROM customer)
        SELECT t AS "table", 'length' AS "rule", c AS "columns", CAST(v AS BIGINT) AS violations FROM counted""",
    "table_counts": """
        SELECT 'region' AS "table", count(*) AS "rows" FROM region
        UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'customer', count(*) FROM customer
        UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part
        UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
        UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'fact_stock_daily', count(*) FROM fact""",
    "retention_latest": """
        SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year
        FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
    "source_load": r"""
        WITH good_regions AS (SELECT region FROM market_feed WHERE region <> '' GROUP BY region
                HAVING arg_min_null(local_open, pos) = '9:30'),
            named AS (SELECT pos, region, regexp_replace(unnest(string_split(primary_exchanges, ',')), '^\s+|\s+$', '', 'g') AS name
                FROM market_feed),
            good_exchanges AS (SELECT name FROM named WHERE name <> '' GROUP BY name
                HAVING arg_min(region, pos) IN (SELECT region FROM good_regions)),
            feed AS (SELECT *, coalesce(isDelisted, false) AS delisted,
                CASE WHEN exchange IN ('', 'UNKNOWN') THEN exchange WHEN category IS NOT NULL THEN concat(category, ' X')
                    ELSE 'HUB' END AS listed_at FROM company_feed),
            valid AS (SELECT *, row_number() OVER (PARTITION BY ticker, delisted ORDER BY pos) AS rn FROM feed
                WHERE ticker <> '' AND name IS NOT NULL AND cik <> '' AND length(ticker) <= 10
                    AND listed_at IN (SELECT name FROM good_exchanges))
        SELECT ticker AS company_ticker, delisted AS company_is_delisted, name AS company_name, cik AS company_cik,
            listed_at AS exchange_name, CASE WHEN sector IS NOT NULL THEN industry END AS industry_name, sector AS industry_sector,
            CASE WHEN regexp_full_match(trim(sic), '[0-9]+') THEN CAST(trim(sic) AS INTEGER) END AS company_sic_id,
            category AS company_category, location AS company_location
        FROM valid WHERE rn = 1""",
    "parquet_roundtrip": "SELECT * FROM fx_bars",
    "warehouse_load": "SELECT * FROM fact",
}
ORACLE["bars_by_day_batches"] = ORACLE["bars_from_lines"] = ORACLE["bars_dedup_first"]
ORACLE["fact_publish_days"] = ORACLE["fact_replace_days"]
ORACLE["json_roundtrip"] = ORACLE["exchanges_first_wins"]


def needed(text: str) -> list[str]:
    """Parts a text names, directly or through other parts, in definition order."""
    found: set[str] = set()
    waiting = [text]
    while waiting:
        words = set(re.findall(r"(?:FROM|JOIN)\s+(\w+)", waiting.pop()))
        for name in words & (PARTS.keys() - found):
            found.add(name)
            waiting.append(PARTS[name])
    return [name for name in PARTS if name in found]


def sql(name: str) -> str:
    """Full text of a query with the parts it needs."""
    text = ORACLE[name].strip()
    parts = [f"{p} AS ({PARTS[p]})" for p in needed(text)]
    if not parts:
        return text
    if text.startswith("WITH "):
        parts.append(text[5:])
        return "WITH " + ",\n".join(parts)
    return "WITH " + ",\n".join(parts) + "\n" + text
