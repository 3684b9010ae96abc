"""Raw snapshots derived from the order, customer, line item and supplier tables.

The statements are plain SQL that Spark and DuckDB both run (`{name}` stands for a
table), so that the operators and their oracle start from the same rows, dirty ones included:
missing and blank keys, missing, zero and negative amounts, missing places, rates and dates, padded and
lower-case text, unknown levels, ratings and flags, rates out of range, an entity whose outflows and eligible
values are negative, and many versions of the same key.  Assets and pledged items both read every line item."""

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("orders", "customer", "lineitem", "supplier")

# The eight countries with currency, rate and risk.  The entities are invented; between them
# they have every business line, two lines in one name, and none.
GEO_SQL = """
SELECT * FROM (VALUES
 (0,'Germany','GER','EUR',CAST(1.0   AS DECIMAL(8,4)),'low',   3,'Rhein Asset Management','Rhein Retail Bank','Rhein Corporate Bank'),
 (1,'France','FRA','EUR',CAST(1.0   AS DECIMAL(8,4)),'low',   2,'Loire Investment House','Loire Private Banking',NULL),
 (2,'United Kingdom','UNI','GBP',CAST(1.17  AS DECIMAL(8,4)),'medium',3,'Thames Holdings','Thames Wealth Partners','Thames Trading Desk'),
 (3,'Switzerland','SWI','CHF',CAST(1.05  AS DECIMAL(8,4)),'low',   2,'Aare Private Banking','Aare Corporate and Retail',NULL),
 (4,'Italy','ITA','EUR',CAST(1.0   AS DECIMAL(8,4)),'high',  2,'Arno Consumer Credit','Arno SME Bank',NULL),
 (5,'Spain','SPA','EUR',CAST(1.0   AS DECIMAL(8,4)),'high',  2,'Ebro Consumer Bank','Ebro Commercial Bank',NULL),
 (6,'Poland','POL','PLN',CAST(0.22  AS DECIMAL(8,4)),'medium',1,'Vistula Savings',NULL,NULL),
 (7,'Sweden','SWE','SEK',CAST(0.095 AS DECIMAL(8,4)),'low',   2,'Malar Digital','Malar Nordic',NULL)
) AS g(ci,country,code3,ccy,fx,risk,ns,s0,s1,s2)
"""

# The category values in the statements below are fixed: the row rules know them.
BALANCES_SQL = """
WITH j AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, c.c_mktsegment AS seg, g.*,
         CASE WHEN g.ci = 7 AND o.o_custkey % 7 = 0 THEN 'Malar Run-off' WHEN o.o_orderkey % 113 = 0 THEN NULL
              ELSE CASE o.o_custkey % g.ns WHEN 0 THEN g.s0 WHEN 1 THEN g.s1 ELSE g.s2 END END AS sub,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS bd, o.o_orderdate AS ts,
         CAST(CASE WHEN o.o_orderkey % 131 = 0 THEN 0 WHEN o.o_orderkey % 89 = 0 THEN -o.o_totalprice ELSE o.o_totalprice END AS DECIMAL(18,2)) AS amt,
         CASE (o.o_orderkey + o.o_custkey) % 7 WHEN 0 THEN 'Overnight' WHEN 1 THEN '7-day' WHEN 2 THEN '30-day'
              WHEN 3 THEN '90-day' WHEN 4 THEN '180-day' WHEN 5 THEN '1-year' ELSE '>1-year' END AS mb
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {geo} g ON c.c_nationkey % 8 = g.ci)
SELECT
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 127 = 0 THEN '  ' ELSE CONCAT(CASE WHEN k % 7 = 0 THEN ' ' ELSE '' END, 'ACC', code3, LPAD(CAST(ck AS STRING), CAST(GREATEST(6, LENGTH(CAST(ck AS STRING))) AS INT), '0')) END AS account_id,
  CASE WHEN k % 109 = 0 THEN NULL ELSE CONCAT(country, CASE WHEN k % 11 = 0 THEN ' ' ELSE '' END) END AS country,
  sub AS subsidiary,
  CASE k % 8 WHEN 0 THEN 'Current Account' WHEN 1 THEN 'Savings Account' WHEN 2 THEN 'Term Deposit' WHEN 3 THEN 'Corporate Account'
       WHEN 4 THEN 'Investment Account' WHEN 5 THEN 'Escrow Account' WHEN 6 THEN 'Money Market Account' ELSE 'Treasury Account' END AS account_type,
  ccy AS currency,
  CAST(amt AS STRING) AS balance_local,
  CASE WHEN k % 83 = 0 THEN NULL ELSE CAST(CAST(ROUND(amt * fx, 2) AS DECIMAL(18,2)) AS STRING) END AS balance_eur,
  CASE WHEN seg IN ('HOUSEHOLD','AUTOMOBILE') THEN 'Retail' WHEN seg IN ('BUILDING','FURNITURE') THEN 'Corporate' ELSE 'Institutional' END AS customer_segment,
  mb AS maturity_bucket,
  CASE WHEN k % 137 = 0 THEN NULL WHEN sub = 'Malar Run-off' THEN '-0.0500' ELSE CAST(CAST((CASE risk WHEN 'high' THEN 1500 + (k * 37) % 2500 WHEN 'medium' THEN 500 + (k * 37) % 1500 ELSE 300 + (k * 37) % 700 END) * CAST(0.0001 AS DECIMAL(8,4)) AS DECIMAL(8,4)) AS STRING) END AS weighted_outflow_rate,
  CASE WHEN k % 139 = 0 THEN 'X' ELSE CONCAT(CASE WHEN k % 5 = 0 THEN ' ' ELSE '' END, CASE WHEN mb IN ('180-day','1-year','>1-year') THEN (CASE WHEN k % 3 = 0 THEN 'y' ELSE 'Y' END) ELSE (CASE WHEN k % 3 = 0 THEN 'n' ELSE 'N' END) END) END AS stable_funding_flag,
  CASE WHEN k % 149 = 0 THEN NULL ELSE CAST(bd - CAST(k % 91 AS INT) AS STRING) END AS last_transaction_date,
  CAST(CAST(ROUND(amt * CAST((85 + k % 31) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(6,2)), 2) AS DECIMAL(18,2)) AS STRING) AS average_balance_30d,
  CASE k % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS balance_volatility,
  CAST(bd AS STRING) AS business_date,
  CAST(ts AS STRING) AS created_timestamp,
  CONCAT('orders/', LPAD(CAST(k AS STRING), 12, '0'), '.csv') AS source_file,
  ts AS load_timestamp
FROM j
"""

HQLA_SQL = """
WITH j0 AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS k, l.l_partkey AS pk, g.*,
         CASE WHEN g.ci = 7 AND l.l_partkey % 7 = 0 THEN 'Malar Run-off' WHEN l.l_orderkey % 113 = 0 THEN NULL
              ELSE CASE l.l_suppkey % g.ns WHEN 0 THEN g.s0 WHEN 1 THEN g.s1 ELSE g.s2 END END AS sub,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS bd, l.l_shipdate AS ts, CAST(CASE WHEN l.l_orderkey % 131 = 0 THEN 0 ELSE l.l_extendedprice END AS DECIMAL(18,2)) AS mv
  FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {geo} g ON s.s_nationkey % 8 = g.ci),
j1 AS (SELECT *, CASE WHEN k % 101 = 0 THEN 'Level 3' WHEN risk = 'high' THEN (CASE WHEN k % 10 < 2 THEN 'Level 1' WHEN k % 10 < 5 THEN 'Level 2A' ELSE 'Level 2B' END)
              ELSE (CASE WHEN k % 10 < 5 THEN 'Level 1' WHEN k % 10 < 8 THEN 'Level 2A' ELSE 'Level 2B' END) END AS lvl FROM j0),
j AS (SELECT *, CAST(ROUND(mv * fx, 2) AS DECIMAL(18,2)) AS mve,
         CAST(CASE WHEN k % 137 = 0 THEN NULL WHEN k % 103 = 0 THEN 1.5 WHEN lvl = 'Level 1' THEN 0 WHEN lvl = 'Level 2A' THEN 0.15 WHEN k % 4 < 2 THEN 0.25 ELSE 0.5 END AS DECIMAL(8,4)) AS hc FROM j1)
SELECT
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 127 = 0 THEN '  ' ELSE CONCAT('HQLA', code3, LPAD(CAST(pk AS STRING), CAST(GREATEST(6, LENGTH(CAST(pk AS STRING))) AS INT), '0')) END AS asset_id,
  CASE WHEN k % 109 = 0 THEN NULL ELSE country END AS country, sub AS subsidiary, CONCAT(CASE WHEN k % 13 = 0 THEN ' ' ELSE '' END, lvl) AS hqla_level,
  CASE lvl WHEN 'Level 1' THEN (CASE pk % 4 WHEN 0 THEN 'Cash' WHEN 1 THEN 'Central Bank Reserves' WHEN 2 THEN 'Government Bonds AAA' ELSE 'Government Bonds AA' END)
           WHEN 'Level 2A' THEN (CASE pk % 3 WHEN 0 THEN 'Corporate Bonds AA-' WHEN 1 THEN 'Covered Bonds AA+' ELSE 'Municipal Bonds AA' END)
           ELSE (CASE pk % 3 WHEN 0 THEN 'Corporate Bonds A+' WHEN 1 THEN 'Equity Securities' ELSE 'RMBS AA' END) END AS asset_type,
  ccy AS currency, CAST(mv AS STRING) AS market_value_local,
  CASE WHEN k % 83 = 0 THEN NULL ELSE CAST(mve AS STRING) END AS market_value_eur,
  CAST(hc AS STRING) AS haircut_rate,
  CAST(CAST(ROUND(CASE WHEN sub = 'Malar Run-off' THEN -mve ELSE mve END * (CAST(1 AS DECIMAL(8,4)) - hc), 2) AS DECIMAL(18,2)) AS STRING) AS eligible_hqla_value_eur,
  CAST(bd + CAST(30 + k % 3621 AS INT) AS STRING) AS maturity_date,
  CASE lvl WHEN 'Level 1' THEN (CASE k % 4 WHEN 0 THEN 'AAA' WHEN 1 THEN 'AA+' WHEN 2 THEN 'AA' ELSE 'AA-' END)
           WHEN 'Level 2A' THEN (CASE k % 3 WHEN 0 THEN 'AA-' WHEN 1 THEN 'A+' ELSE 'A' END)
           ELSE (CASE k % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'A-' ELSE 'BBB+' END) END AS credit_rating,
  CAST(CASE lvl WHEN 'Level 1' THEN 9 + k % 2 WHEN 'Level 2A' THEN 7 + k % 3 ELSE 5 + k % 3 END AS STRING) AS liquidity_score,
  CASE WHEN k % 139 = 0 THEN '?' WHEN k % 20 < 3 THEN (CASE WHEN k % 2 = 0 THEN 'y' ELSE 'Y ' END) ELSE 'N' END AS encumbered_flag,
  CASE WHEN k % 151 = 0 THEN 'U' WHEN lvl = 'Level 1' OR k % 3 = 0 THEN 'Y' ELSE 'n' END AS central_bank_eligible,
  CAST(CAST((10 + (k * 31) % 690) * CAST(0.0001 AS DECIMAL(8,4)) AS DECIMAL(8,4)) AS STRING) AS yield_rate,
  CAST(CAST((10 + k % 991) * CAST(0.01 AS DECIMAL(4,2)) AS DECIMAL(8,2)) AS STRING) AS duration_years,
  CAST(bd - CAST(k % 6 AS INT) AS STRING) AS last_valuation_date,
  CAST(bd AS STRING) AS business_date, CAST(ts AS STRING) AS created_timestamp,
  CONCAT('lineitem/', LPAD(CAST(k AS STRING), 12, '0'), '.csv') AS source_file, ts AS load_timestamp
FROM j
"""

COLLATERAL_SQL = """
WITH j0 AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS k, l.l_partkey AS pk, g.*,
         CASE WHEN g.ci = 7 AND l.l_partkey % 7 = 0 THEN 'Malar Run-off' WHEN l.l_orderkey % 113 = 0 THEN NULL
              ELSE CASE l.l_suppkey % g.ns WHEN 0 THEN g.s0 WHEN 1 THEN g.s1 ELSE g.s2 END END AS sub,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS bd, l.l_shipdate AS ts, CAST(CASE WHEN l.l_orderkey % 131 = 0 THEN 0 ELSE l.l_extendedprice END AS DECIMAL(18,2)) AS gv
  FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {geo} g ON s.s_nationkey % 8 = g.ci),
j AS (SELECT *, CAST(ROUND(gv * fx, 2) AS DECIMAL(18,2)) AS gve,
         CASE WHEN k % 101 = 0 THEN 'E' WHEN k % 10 < 4 THEN 'A' WHEN k % 10 < 7 THEN 'B' WHEN k % 10 < 9 THEN 'C' ELSE 'D' END AS q,
         CAST(CASE WHEN k % 157 = 0 THEN NULL WHEN k % 103 = 0 THEN 12000 ELSE (k * 17) % 6000 END * CAST(0.0001 AS DECIMAL(8,4)) AS DECIMAL(8,4)) AS hc,
         CAST(CASE WHEN k % 137 = 0 THEN NULL WHEN k % 107 = 0 THEN 11000 ELSE 5000 + (k * 13) % 5001 END * CAST(0.0001 AS DECIMAL(8,4)) AS DECIMAL(8,4)) AS ltv FROM j0)
SELECT
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 127 = 0 THEN '  ' ELSE CONCAT('COLL', code3, LPAD(CAST(pk AS STRING), CAST(GREATEST(6, LENGTH(CAST(pk AS STRING))) AS INT), '0')) END AS collateral_id,
  CASE WHEN k % 109 = 0 THEN NULL ELSE country END AS country, sub AS subsidiary,
  CASE pk % 8 WHEN 0 THEN 'Real Estate' WHEN 1 THEN 'Equipment' WHEN 2 THEN 'Inventory' WHEN 3 THEN 'Securities' WHEN 4 THEN 'Cash Deposit'
       WHEN 5 THEN 'Receivables' WHEN 6 THEN 'Vehicles' ELSE 'Intellectual Property' END AS collateral_type,
  ccy AS currency, CAST(gv AS STRING) AS gross_value_local,
  CASE WHEN k % 83 = 0 THEN NULL ELSE CAST(gve AS STRING) END AS gross_value_eur,
  CAST(ltv AS STRING) AS loan_to_value_ratio, CAST(hc AS STRING) AS haircut_percentage,
  CAST(CAST(ROUND(gve * (CAST(1 AS DECIMAL(8,4)) - hc), 2) AS DECIMAL(18,2)) AS STRING) AS net_realizable_value_eur,
  CONCAT('LOAN', CAST(100000 + k AS STRING)) AS associated_loan_id,
  CASE WHEN k % 20 < 16 THEN 'Active' WHEN k % 20 < 19 THEN 'Under Review' ELSE 'Released' END AS collateral_status,
  CAST(bd - CAST(k % 91 AS INT) AS STRING) AS valuation_date,
  CASE WHEN k % 149 = 0 THEN NULL ELSE CAST(bd - CAST(k % 91 AS INT) + CAST(30 + k % 336 AS INT) AS STRING) END AS next_review_date,
  CASE WHEN k % 3 = 0 THEN LOWER(q) ELSE q END AS quality_rating,
  CAST(1 + k % 180 AS STRING) AS liquidation_period_days,
  CASE WHEN k % 139 = 0 THEN 'U' WHEN k % 10 < 7 THEN 'y' ELSE 'N' END AS insurance_status,
  CASE WHEN k % 10 < 7 THEN 'Owned' WHEN k % 10 < 9 THEN 'Leased' ELSE 'Third-party' END AS legal_ownership,
  CASE WHEN k % 151 = 0 THEN 'X' WHEN k % 10 < (CASE risk WHEN 'high' THEN 4 ELSE 1 END) THEN 'Y' ELSE 'N' END AS concentration_risk_flag,
  CAST(bd AS STRING) AS business_date, CAST(ts AS STRING) AS created_timestamp,
  CONCAT('lineitem/', LPAD(CAST(k AS STRING), 12, '0'), '.csv') AS source_file, ts AS load_timestamp
FROM j
"""

RAW_SQL = {"balances": BALANCES_SQL, "hqla": HQLA_SQL, "collateral": COLLATERAL_SQL}


def raw_feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three raw datasets over the whole tables in `folder`."""
    tables = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in SOURCE_TABLES}
    tables["geo"] = spark.sql(GEO_SQL)
    return {
        dataset: spark.sql(sql, **{n: df for n, df in tables.items() if f"{{{n}}}" in sql})
        for dataset, sql in RAW_SQL.items()
    }
