"""The registered queries in DuckDB SQL.

Written apart from the operators: dedup by QUALIFY, shares by window sums, keys by
row_number, conditional sums by FILTER, and the decimal rounding of Spark in exact
integer arithmetic, because DuckDB divides and averages decimals as doubles."""

from ebbtide.plans.registry import FIRST_DELIVERY, LOAD_TIME, QUERIES
from ebbtide.schemas import BRONZE, FACTS, GOLD, LANDING, PRIMARY_KEYS, SILVER
from ebbtide.sources.feed import GEO_SQL, RAW_SQL, SOURCE_TABLES

_STAMP = f"TIMESTAMP '{LOAD_TIME}'"
_GRAIN = "business_date, country, subsidiary"


# ---- exact arithmetic -----------------------------------------------------------------

def _units(expr: str, digits: int) -> str:
    """Decimal expression as a whole number of its last digit."""
    return f"CAST(({expr}) * {10 ** digits} AS HUGEINT)"


def _half_up(a: str, b: str) -> str:
    """a / b to a whole number, halves away from zero; b > 0."""
    return f"(sign({a}) * ((2 * abs({a}) + ({b})) // (2 * ({b}))))"


def _decimal(units: str, digits: int, kind: str) -> str:
    return f"CAST(CAST({units} AS DECIMAL(38,0)) * {'0.' + '0' * (digits - 1) + '1'} AS {kind})"


def _avg(column: str, digits: int, out: int, kind: str) -> str:
    """Average of a decimal: first to four more digits than it has, then to `out`."""
    fine = _half_up(f"{_units(f'sum({column})', digits)} * 10000", f"count({column})")
    return _decimal(_half_up(fine, str(10 ** (digits + 4 - out))), out, kind)


def _avg_int(column: str, kind: str) -> str:
    return _decimal(_half_up(f"CAST(sum({column}) AS HUGEINT) * 100", f"count({column})"), 2, kind)


def _percent(part: str, whole: str) -> str:
    """Share in percent: ten digits, times 100 to six digits, then four."""
    ratio = _half_up(f"{_units(part, 2)} * 10000000000", _units(whole, 2))
    rounded = _decimal(_half_up(_half_up(ratio, "100"), "100"), 4, "DECIMAL(8,4)")
    return f"CASE WHEN {whole} > 0 THEN {rounded} ELSE 0 END"


def _ratio(part: str, whole: str) -> str:
    """Share of two amounts: ten digits, then four."""
    fine = _half_up(f"{_units(part, 2)} * 10000000000", _units(whole, 2))
    rounded = _decimal(_half_up(fine, "1000000"), 4, "DECIMAL(8,4)")
    return f"CASE WHEN {whole} > 0 THEN {rounded} ELSE 0 END"


# Ratio of eligible assets (two digits) to outflow (six digits), in millionths; both change
# sign where the outflow is negative.
_SIGN = "CAST(sign(weighted_outflow_amount) AS HUGEINT)"
_LCR_MILLIONTHS = _half_up(
    f"({_SIGN} * {_units('total_hqla_eligible_eur', 2)} * 10000000000)",
    f"({_SIGN} * {_units('weighted_outflow_amount', 6)})",
)
_LCR = (
    "CASE WHEN weighted_outflow_amount > 0 THEN "
    + _decimal(_half_up(_LCR_MILLIONTHS, "100"), 4, "DECIMAL(10,4)") + " END"
)
_SURPLUS = (
    "CAST(CASE WHEN weighted_outflow_amount > 0 "
    "THEN round(total_hqla_eligible_eur - weighted_outflow_amount, 2) "
    "ELSE total_hqla_eligible_eur END AS DECIMAL(20,2))"
)
_STATUS = (
    "CASE WHEN weighted_outflow_amount = 0 THEN 'No Outflows' "
    f"WHEN {_LCR_MILLIONTHS} >= 1000000 THEN 'Compliant' "
    f"WHEN {_LCR_MILLIONTHS} >= 900000 THEN 'At Risk' ELSE 'Non-Compliant' END"
)


# ---- building blocks, each a common table expression ----------------------------------

CTES: dict[str, str] = {"geo": GEO_SQL}
for _name, _sql in RAW_SQL.items():
    CTES[f"{_name}_raw"] = _sql.format(geo="geo", **{t: t for t in SOURCE_TABLES})


def _bronze(dataset: str) -> str:
    casts = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
                      for f in BRONZE[dataset])
    return f"SELECT {casts} FROM {dataset}_raw"


_KEY = {"balances": "account_id", "hqla": "asset_id", "collateral": "collateral_id"}
_UPPER = {
    "balances": ["stable_funding_flag"],
    "hqla": ["encumbered_flag", "central_bank_eligible"],
    "collateral": ["quality_rating", "insurance_status", "concentration_risk_flag"],
}
_VALID = {
    "balances": "account_id IS NOT NULL AND business_date IS NOT NULL AND balance_eur >= 0",
    "hqla": (
        "asset_id IS NOT NULL AND business_date IS NOT NULL AND market_value_eur >= 0 "
        "AND trim(hqla_level) IN ('Level 1', 'Level 2A', 'Level 2B') "
        "AND haircut_rate BETWEEN 0 AND 1"
    ),
    "collateral": (
        "collateral_id IS NOT NULL AND business_date IS NOT NULL AND gross_value_eur >= 0 "
        "AND upper(trim(quality_rating)) IN ('A', 'B', 'C', 'D') "
        "AND haircut_percentage BETWEEN 0 AND 1 AND loan_to_value_ratio BETWEEN 0 AND 1"
    ),
}


def _with_text(dataset: str, trimmed: bool = True, flags: bool = True, only: str = "") -> str:
    """Column list of bronze with its text columns trimmed and flags in upper case."""
    out = []
    for f in BRONZE[dataset]:
        text = f.dataType.simpleString() == "string" and f.name != "source_file"
        if flags and f.name in _UPPER[dataset]:
            out.append(f"upper(trim({f.name})) AS {f.name}")
        elif (trimmed and text) or f.name == only:
            out.append(f"trim({f.name}) AS {f.name}")
        else:
            out.append(f.name)
    return ", ".join(out)


def _newest(dataset: str) -> str:
    newest = ["load_timestamp", "created_timestamp", "source_file"]
    rest = [n for n in BRONZE[dataset].names
            if n not in newest and n not in (_KEY[dataset], "business_date")]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in newest + rest)
    return (
        f"QUALIFY row_number() OVER (PARTITION BY {_KEY[dataset]}, business_date "
        f"ORDER BY {order}) = 1"
    )


for _name in BRONZE:
    CTES[f"bronze_{_name}"] = _bronze(_name)
for _name in BRONZE:
    CTES[f"clean_{_name}"] = (
        f"SELECT {_with_text(_name)} FROM bronze_{_name} WHERE {_VALID[_name]}"
    )
    CTES[f"silver_{_name}"] = (
        f"SELECT *, {_STAMP} AS silver_load_timestamp FROM clean_{_name} {_newest(_name)}"
    )


def _when(column: str, condition: str, name: str) -> str:
    return f"coalesce(sum({column}) FILTER (WHERE {condition}), 0) AS {name}"


CTES["balance_metrics"] = f"""
SELECT {_GRAIN}, sum(balance_eur) AS total_balance_eur, sum(balance_local) AS total_balance_local,
  count(DISTINCT account_id) AS account_count,
  sum(balance_eur * weighted_outflow_rate) AS weighted_outflow_amount,
  {_when('balance_eur', "stable_funding_flag = 'Y'", 'stable_funding_amount')},
  {_when('balance_eur', "stable_funding_flag = 'N'", 'unstable_funding_amount')}
FROM silver_balances GROUP BY ALL"""
CTES["hqla_metrics"] = f"""
SELECT {_GRAIN}, sum(market_value_eur) AS total_hqla_gross_eur,
  sum(eligible_hqla_value_eur) AS total_hqla_eligible_eur,
  {_when('eligible_hqla_value_eur', "hqla_level = 'Level 1'", 'hqla_level1_eur')},
  {_when('eligible_hqla_value_eur', "hqla_level = 'Level 2A'", 'hqla_level2a_eur')},
  {_when('eligible_hqla_value_eur', "hqla_level = 'Level 2B'", 'hqla_level2b_eur')},
  {_when('eligible_hqla_value_eur', "encumbered_flag = 'N'", 'hqla_unencumbered_eur')}
FROM silver_hqla GROUP BY ALL"""
CTES["collateral_metrics"] = f"""
SELECT {_GRAIN}, sum(gross_value_eur) AS total_collateral_gross_eur,
  sum(net_realizable_value_eur) AS total_collateral_net_eur,
  {_when('net_realizable_value_eur', "quality_rating IN ('A', 'B')", 'high_quality_collateral_eur')}
FROM silver_collateral GROUP BY ALL"""

_METRICS = [
    "total_balance_eur", "total_balance_local", "account_count", "weighted_outflow_amount",
    "stable_funding_amount", "unstable_funding_amount", "total_hqla_gross_eur",
    "total_hqla_eligible_eur", "hqla_level1_eur", "hqla_level2a_eur", "hqla_level2b_eur",
    "hqla_unencumbered_eur", "total_collateral_gross_eur", "total_collateral_net_eur",
    "high_quality_collateral_eur",
]
_OF_BALANCE_AND_HQLA = [m for m in _METRICS if "collateral" not in m]


def _zero_filled(metrics: list[str]) -> str:
    return ", ".join(f"coalesce(max({m}), 0) AS {m}" for m in metrics)


def _together(metrics: list[str], *tables: str) -> str:
    """Metrics of all tables beside each other; NULL places are one group, as for GROUP BY."""
    rows = " UNION ALL BY NAME ".join(f"SELECT * FROM {t}" for t in tables)
    return f"SELECT {_GRAIN}, {_zero_filled(metrics)} FROM ({rows}) GROUP BY ALL"


CTES["two_way_metrics"] = _together(_OF_BALANCE_AND_HQLA, "balance_metrics", "hqla_metrics")
CTES["combined_metrics"] = _together(
    _METRICS, "balance_metrics", "hqla_metrics", "collateral_metrics")


def _from_silver(columns: str) -> str:
    return " UNION ".join(f"SELECT {columns} FROM silver_{d}" for d in BRONZE)


CTES["dim_date"] = f"""
SELECT CAST(strftime(business_date, '%Y%m%d') AS INT) AS date_key, business_date,
  CAST(year(business_date) AS INT) AS year, CAST(quarter(business_date) AS INT) AS quarter,
  CAST(month(business_date) AS INT) AS month, monthname(business_date) AS month_name,
  CAST(day(business_date) AS INT) AS day_of_month,
  CAST(dayofweek(business_date) + 1 AS INT) AS day_of_week, dayname(business_date) AS day_name,
  CAST(weekofyear(business_date) AS INT) AS week_of_year,
  if(dayofweek(business_date) IN (0, 6), 'Y', 'N') AS is_weekend,
  if(business_date = last_day(business_date), 'Y', 'N') AS is_month_end,
  if(business_date = last_day(business_date) AND month(business_date) IN (3, 6, 9, 12), 'Y', 'N')
    AS is_quarter_end,
  if(strftime(business_date, '%m-%d') = '12-31', 'Y', 'N') AS is_year_end,
  CAST(year(business_date) AS INT) AS fiscal_year,
  CAST(quarter(business_date) AS INT) AS fiscal_quarter
FROM ({_from_silver('business_date')})"""
# What the rules know about a country.
CTES["country_rules"] = """
SELECT * FROM (VALUES
 ('Germany', 'DEU', 'Western Europe', 'EUR', 'Y', 'Low'),
 ('France', 'FRA', 'Western Europe', 'EUR', 'Y', 'Low'),
 ('United Kingdom', 'GBR', 'Western Europe', 'GBP', 'N', 'Medium'),
 ('Switzerland', 'CHE', 'Western Europe', 'CHF', 'N', 'Low'),
 ('Italy', 'ITA', 'Southern Europe', 'EUR', 'Y', 'High'),
 ('Spain', 'ESP', 'Southern Europe', 'EUR', 'Y', 'High'),
 ('Poland', 'POL', 'Eastern Europe', 'PLN', 'N', 'Medium'),
 ('Sweden', 'SWE', 'Northern Europe', 'SEK', 'N', 'Low')
) AS r(country, code, region, currency, euro, risk)"""
CTES["dim_country"] = f"""
SELECT CAST(row_number() OVER (ORDER BY s.country NULLS FIRST) AS INT) AS country_key,
  s.country AS country_name, coalesce(r.code, 'UNK') AS country_code,
  coalesce(r.region, 'Other') AS region, coalesce(r.currency, 'EUR') AS currency,
  coalesce(r.euro, 'N') AS is_eurozone, coalesce(r.risk, 'Unknown') AS liquidity_risk_category
FROM ({_from_silver('country')}) s LEFT JOIN country_rules r ON s.country = r.country"""
CTES["dim_subsidiary"] = f"""
SELECT CAST(row_number() OVER (ORDER BY country NULLS FIRST, subsidiary NULLS FIRST) AS INT)
    AS subsidiary_key,
  subsidiary AS subsidiary_name, country,
  CASE WHEN regexp_matches(subsidiary, 'Retail|Consumer') THEN 'Retail Banking'
    WHEN regexp_matches(subsidiary, 'Corporate|SME|Commercial') THEN 'Corporate Banking'
    WHEN regexp_matches(subsidiary, 'Investment|Trading') THEN 'Investment Banking'
    WHEN regexp_matches(subsidiary, 'Asset Management') THEN 'Asset Management'
    WHEN regexp_matches(subsidiary, 'Private Banking|Wealth') THEN 'Private Banking'
    WHEN regexp_matches(subsidiary, 'Holdings') THEN 'Holdings'
    WHEN regexp_matches(subsidiary, 'Digital') THEN 'Digital Banking'
    ELSE 'Other' END AS subsidiary_type
FROM ({_from_silver('country, subsidiary')})"""
_ATTRIBUTES = "account_type, customer_segment, currency, country, subsidiary"
_ACCOUNT_KEY = (
    "CAST(row_number() OVER (ORDER BY account_id NULLS FIRST, effective_date NULLS FIRST) AS INT) "
    "AS account_key"
)
CTES["dim_account"] = f"""
SELECT {_ACCOUNT_KEY}, *, CAST(NULL AS DATE) AS end_date, 'Y' AS is_current
FROM (SELECT account_id, {_ATTRIBUTES}, max(business_date) AS effective_date
      FROM silver_balances GROUP BY ALL)"""
# History from numbered days: a run is where the number over all days and the number
# over days of the same attributes drift apart.
CTES["dim_account_scd2"] = f"""
SELECT {_ACCOUNT_KEY}, account_id, {_ATTRIBUTES}, effective_date,
  CAST(lead(effective_date) OVER w - INTERVAL 1 DAY AS DATE) AS end_date,
  if(lead(effective_date) OVER w IS NULL, 'Y', 'N') AS is_current
FROM (SELECT account_id, {_ATTRIBUTES}, run, min(business_date) AS effective_date
      FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY business_date)
                    - row_number() OVER (PARTITION BY account_id, {_ATTRIBUTES}
                                         ORDER BY business_date) AS run
            FROM silver_balances)
      GROUP BY ALL)
WINDOW w AS (PARTITION BY account_id ORDER BY effective_date)"""

CTES["hqla_aggregated"] = f"""
SELECT {_GRAIN}, hqla_level, asset_type, credit_rating, count(asset_id) AS asset_count,
  sum(market_value_eur) AS total_market_value_eur,
  sum(eligible_hqla_value_eur) AS total_eligible_value_eur,
  {_avg('haircut_rate', 4, 4, 'DECIMAL(8,4)')} AS average_haircut_rate,
  {_avg('yield_rate', 4, 4, 'DECIMAL(8,4)')} AS average_yield_rate,
  {_avg_int('liquidity_score', 'DECIMAL(5,2)')} AS average_liquidity_score,
  {_when('eligible_hqla_value_eur', "encumbered_flag = 'Y'", 'encumbered_value_eur')},
  {_when('eligible_hqla_value_eur', "encumbered_flag = 'N'", 'unencumbered_value_eur')},
  {_when('eligible_hqla_value_eur', "central_bank_eligible = 'Y'",
         'central_bank_eligible_value_eur')}
FROM silver_hqla GROUP BY ALL"""
_IDLE = "business_date - last_transaction_date > 30"
_INACTIVE = (
    f"count(*) FILTER (WHERE {_IDLE}) AS inactive_account_count, "
    + _when("balance_eur", _IDLE, "inactive_balance_eur")
)
CTES["funding_aggregated"] = f"""
SELECT {_GRAIN}, maturity_bucket, customer_segment, account_type,
  count(account_id) AS account_count, sum(balance_eur) AS total_balance_eur,
  {_avg('balance_eur', 2, 2, 'DECIMAL(20,2)')} AS average_balance_eur,
  {_when('balance_eur', "stable_funding_flag = 'Y'", 'stable_funding_balance_eur')},
  {_when('balance_eur', "stable_funding_flag = 'N'", 'unstable_funding_balance_eur')},
  sum(balance_eur * weighted_outflow_rate) AS weighted_outflow_amount,
  {_avg('weighted_outflow_rate', 4, 4, 'DECIMAL(8,4)')} AS average_outflow_rate,
  {_when('balance_eur', "balance_volatility = 'High'", 'high_volatility_balance_eur')},
  {_when('balance_eur', "balance_volatility = 'Medium'", 'medium_volatility_balance_eur')},
  {_when('balance_eur', "balance_volatility = 'Low'", 'low_volatility_balance_eur')},
  {_INACTIVE}
FROM silver_balances GROUP BY ALL"""
_LATE = "next_review_date < business_date"
_OVERDUE = (
    f"count(*) FILTER (WHERE {_LATE}) AS overdue_review_count, "
    + _when("net_realizable_value_eur", _LATE, "overdue_review_value_eur")
)
_NET = "net_realizable_value_eur"
# The scores of the ratings.
_SCORE = "CASE quality_rating WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 WHEN 'D' THEN 1 ELSE 0 END"
_AVG_SCORE = _decimal(
    _half_up(f"CAST(sum({_SCORE}) AS HUGEINT) * 10000", "count(*)"), 4, "DECIMAL(8,4)"
)
CTES["collateral_aggregated"] = f"""
SELECT {_GRAIN}, collateral_type, quality_rating, collateral_status,
  count(collateral_id) AS collateral_count, sum(gross_value_eur) AS total_gross_value_eur,
  sum({_NET}) AS total_net_value_eur,
  {_avg('haircut_percentage', 4, 4, 'DECIMAL(8,4)')} AS average_haircut_percentage,
  {_avg('loan_to_value_ratio', 4, 4, 'DECIMAL(8,4)')} AS average_ltv_ratio,
  {_avg_int('liquidation_period_days', 'DECIMAL(10,2)')} AS average_liquidation_days,
  {_when(_NET, "concentration_risk_flag = 'Y'", 'high_concentration_value_eur')},
  {_when(_NET, "insurance_status = 'Y'", 'insured_value_eur')},
  {_when(_NET, "insurance_status = 'N'", 'uninsured_value_eur')},
  {_when(_NET, "collateral_status = 'Active'", 'active_collateral_value_eur')},
  {_when(_NET, "collateral_status = 'Under Review'", 'under_review_value_eur')},
  {_OVERDUE}, {_AVG_SCORE} AS quality_score
FROM silver_collateral GROUP BY ALL"""

# The same measures per country and month.
for _name in ("hqla", "funding", "collateral"):
    _head, _tail = CTES[f"{_name}_aggregated"].split("count(", 1)
    CTES[f"{_name}_monthly"] = (
        f"SELECT country, CAST(date_trunc('month', business_date) AS DATE) AS month, count({_tail}"
    )


def _with_share(table: str, value: str) -> str:
    whole = f"sum({value}) OVER (PARTITION BY {_GRAIN})"
    return (
        f"SELECT * EXCLUDE (whole), {_percent(value, 'whole')} AS concentration_percentage "
        f"FROM (SELECT *, {whole} AS whole FROM {table} "
        "WHERE country IS NOT NULL AND subsidiary IS NOT NULL)"
    )


CTES["hqla_shares"] = _with_share("hqla_aggregated", "total_eligible_value_eur")
CTES["funding_shares"] = _with_share("funding_aggregated", "total_balance_eur")
CTES["collateral_shares"] = _with_share("collateral_aggregated", "total_net_value_eur")


def _cast_to(fields) -> str:
    return ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields)


def _fact(name: str, source: str, key: str, order: str, extra: str = "", drop=()) -> str:
    """Dimension keys, row number and declared types for aggregated rows."""
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in order.split(","))
    fields = [f for f in GOLD[name] if f.name not in drop]
    return f"""
SELECT {_cast_to(fields)} FROM (
  SELECT m.*, d.date_key, c.country_key, s.subsidiary_key, {_STAMP} AS load_timestamp{extra},
    row_number() OVER (ORDER BY {order}) AS {key}
  FROM {source} m JOIN dim_date d USING (business_date)
  JOIN dim_country c ON m.country = c.country_name
  JOIN dim_subsidiary s ON m.subsidiary = s.subsidiary_name AND m.country = s.country)"""


def _order(*more: str) -> str:
    return ", ".join(["m.business_date", "m.country", "m.subsidiary", *more])


_RATIOS = (
    f", weighted_outflow_amount AS total_cash_outflows_30d, {_LCR} AS liquidity_coverage_ratio, "
    f"{_SURPLUS} AS lcr_surplus_deficit_eur, {_STATUS} AS lcr_status"
)
CTES["fact_intraday_liquidity"] = _fact(
    "fact_intraday_liquidity", "combined_metrics", "liquidity_key", _order(), _RATIOS)
CTES["lcr_two_way"] = _fact(
    "fact_intraday_liquidity", "two_way_metrics", "liquidity_key", _order(), _RATIOS,
    drop=["total_balance_local", "total_hqla_gross_eur", "hqla_unencumbered_eur",
          "weighted_outflow_amount", "total_collateral_gross_eur", "total_collateral_net_eur",
          "high_quality_collateral_eur"])
CTES["fact_hqla_position"] = _fact(
    "fact_hqla_position", "hqla_shares", "hqla_position_key",
    _order("hqla_level", "asset_type", "credit_rating"))
_STABLE = _ratio("stable_funding_balance_eur", "total_balance_eur")
CTES["fact_funding_stability"] = _fact(
    "fact_funding_stability", "funding_shares", "funding_stability_key",
    _order("maturity_bucket", "customer_segment", "account_type"),
    f", {_STABLE} AS stable_funding_ratio")
CTES["fact_collateral_risk"] = _fact(
    "fact_collateral_risk", "collateral_shares", "collateral_risk_key",
    _order("collateral_type", "quality_rating", "collateral_status"))


# ---- the queries ----------------------------------------------------------------------

def _typed(table: str, source: str, columns: str = "*") -> str:
    """Rows of a building block, with the columns of `table` in its declared types."""
    replaced = ", ".join(
        f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in GOLD[table] if f.name in _COLUMNS[source]
    )
    body = f"SELECT * REPLACE ({replaced}) FROM {source}"
    return body if columns == "*" else f"SELECT {columns} FROM ({body})"


_COLUMNS = {
    "balance_metrics": _METRICS[:6],
    "hqla_metrics": _METRICS[6:12],
    "collateral_metrics": _METRICS[12:],
    "combined_metrics": _METRICS,
    "hqla_aggregated": GOLD["fact_hqla_position"].names[7:16],
    "funding_aggregated": GOLD["fact_funding_stability"].names[7:19],
    "collateral_aggregated": [
        *GOLD["fact_collateral_risk"].names[7:20], "quality_score"],
}
for _name in ("hqla", "funding", "collateral"):
    _COLUMNS[f"{_name}_monthly"] = _COLUMNS[f"{_name}_aggregated"]

_Q: dict[str, str] = {}

for _name in BRONZE:
    _Q[f"scan_landing_{_name}"] = f"SELECT {', '.join(LANDING[_name].names)} FROM {_name}_raw"
    _Q[f"bronze_{_name}"] = f"SELECT * FROM bronze_{_name}"
    _Q[f"silver_{_name}"] = f"SELECT {', '.join(SILVER[_name].names)} FROM silver_{_name}"
    _Q[f"dedup_{_name}"] = (
        f"SELECT * FROM (SELECT {_with_text(_name, False, False, _KEY[_name])} "
        f"FROM bronze_{_name}) {_newest(_name)}"
    )
for _name, _query in {"balances": "filter_required_balances", "hqla": "filter_valid_hqla",
                      "collateral": "filter_valid_collateral"}.items():
    _Q[_query] = f"SELECT * FROM bronze_{_name} WHERE {_VALID[_name]}"

_Q["with_source_file"] = (
    "SELECT business_date AS folder_date, business_date, count(*) AS record_count "
    "FROM hqla_raw GROUP BY business_date"
)
_Q["with_load_timestamp"] = (
    f"SELECT {_STAMP} AS loaded_at, count(*) AS record_count FROM balances_raw"
)
_Q["write_landing_csv"] = (
    f"SELECT 'collateral_{LOAD_TIME[:10]}.csv' AS snapshot_file, business_date, "
    "count(*) AS record_count FROM collateral_raw GROUP BY business_date"
)
_Q["write_table"] = _Q["overwrite_days"] = _Q["silver_balances"]
_Q["load_new_files"] = "SELECT * EXCLUDE (source_file, load_timestamp) FROM bronze_balances"
_Q["overwrite_table"] = f"SELECT {_with_text('collateral', True, False)} FROM bronze_collateral"
_Q["describe_table"] = f"""
SELECT column_name AS col_name, CASE column_type WHEN 'VARCHAR' THEN 'string'
  WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS data_type, filled_rows
FROM (DESCRIBE SELECT * FROM bronze_hqla)
JOIN (UNPIVOT (SELECT {', '.join(f'count({n}) AS {n}' for n in BRONZE['hqla'].names)} FROM bronze_hqla)
      ON COLUMNS(*) INTO NAME column_name VALUE filled_rows) USING (column_name)"""
for _name in BRONZE:
    _Q["trim_strings" + ("" if _name == "balances" else f"_{_name}")] = (
        f"SELECT {_with_text(_name, True, False)} FROM bronze_{_name}")
_Q["normalise_flags"] = f"SELECT {_with_text('balances', False)} FROM bronze_balances"
_Q["normalise_flags_hqla"] = f"SELECT {_with_text('hqla', False)} FROM bronze_hqla"
_Q["normalise_flags_collateral"] = (
    f"SELECT {_with_text('collateral', False)} FROM bronze_collateral"
)
_Q["conform_schema"] = "SELECT * FROM bronze_hqla"

_AMOUNT = {"balances": "balance_eur", "hqla": "eligible_hqla_value_eur",
           "collateral": "net_realizable_value_eur"}
_SPAN = (
    "count(*) AS record_count, count(DISTINCT business_date) AS distinct_dates, "
    "min(business_date) AS earliest_date, max(business_date) AS latest_date, "
    "count(DISTINCT country) AS distinct_countries"
)


def _union_all(parts) -> str:
    return " UNION ALL ".join(parts)


_Q["bronze_summary"] = _union_all(
    f"SELECT '{d}' AS table_name, {_SPAN}, "
    f"CAST(sum({a}) AS DECIMAL(28,2)) AS total_balance_eur FROM bronze_{d}"
    for d, a in _AMOUNT.items()
)
_Q["bronze_record_counts"] = _union_all(
    f"SELECT '{d}' AS table_name, count(*) AS records FROM bronze_{d}" for d in BRONZE
)
_Q["silver_vs_bronze_summary"] = _union_all(
    f"SELECT '{d}' AS table_name, '{layer}' AS layer, {_SPAN}, "
    f"count(*) FILTER (WHERE {_KEY[d]} IS NULL) AS null_account_ids FROM {layer}_{d}"
    for layer in ("bronze", "silver") for d in BRONZE
)
_Q["silver_record_counts"] = _union_all(
    f"SELECT '{d}_cleaned' AS table_name, count(*) AS record_count, "
    f"count(DISTINCT business_date) AS distinct_dates FROM silver_{d}" for d in BRONZE
)
_Q["silver_flag_distribution"] = _union_all(
    f"SELECT '{d}_cleaned - {c}' AS validation_check, {c} AS flag_value, "
    f"count(*) AS record_count FROM silver_{d} GROUP BY {c}"
    for d, c in [
        ("balances", "stable_funding_flag"), ("hqla", "hqla_level"), ("hqla", "encumbered_flag"),
        ("hqla", "central_bank_eligible"), ("collateral", "quality_rating"),
        ("collateral", "insurance_status"), ("collateral", "concentration_risk_flag"),
    ]
)

for _name in ("dim_date", "dim_country", "dim_subsidiary", "dim_account", "dim_account_scd2",
              "fact_intraday_liquidity", "fact_hqla_position", "fact_funding_stability",
              "fact_collateral_risk", "lcr_two_way"):
    _Q[_name] = f"SELECT * FROM {_name}"
for _name in FACTS:
    _Q[f"merged_{_name}"] = f"SELECT * FROM {_name}"
for _name, _source in {"hqla_position": "hqla", "funding_stability": "funding", "collateral_risk": "collateral"}.items():
    _Q[f"monthly_{_name}"] = _typed(f"fact_{_name}", f"{_source}_monthly")
_Q["merge_account_history"] = "SELECT * FROM dim_account_scd2"
_Q["surrogate_key_dense"] = """
SELECT CAST(row_number() OVER (ORDER BY country NULLS FIRST, subsidiary NULLS FIRST,
    account_type NULLS FIRST, customer_segment NULLS FIRST) AS INT) AS product_key, *
FROM (SELECT DISTINCT country, subsidiary, account_type, customer_segment FROM silver_balances)"""
_Q["registered_keys"] = f"""
SELECT account_id, country,
  CAST(row_number() OVER (ORDER BY early DESC, account_id, country NULLS FIRST) AS BIGINT) AS account_key
FROM (SELECT account_id, country, max(business_date < DATE '{FIRST_DELIVERY}') AS early FROM silver_balances GROUP BY ALL)"""
_Q["merged_account_counts"] = """
SELECT country, CAST(date_trunc('month', business_date) AS DATE) AS month, count(DISTINCT account_id) AS account_count
FROM silver_balances GROUP BY ALL"""
_Q["date_key"] = """
SELECT business_date, CAST(strftime(business_date, '%Y%m%d') AS INT) AS date_key
FROM (SELECT business_date FROM silver_balances UNION SELECT business_date FROM silver_hqla
      UNION SELECT business_date FROM silver_collateral)"""

_Q["balance_metrics"] = _typed("fact_intraday_liquidity", "balance_metrics")
_Q["hqla_metrics"] = _typed("fact_intraday_liquidity", "hqla_metrics")
_Q["collateral_metrics"] = _typed("fact_intraday_liquidity", "collateral_metrics")
_Q["combined_metrics"] = _typed("fact_intraday_liquidity", "combined_metrics")
_Q["lcr_ratio"] = f"SELECT {_GRAIN}, {_LCR} AS liquidity_coverage_ratio FROM combined_metrics"
_Q["lcr_surplus_deficit"] = (
    f"SELECT {_GRAIN}, {_SURPLUS} AS lcr_surplus_deficit_eur FROM combined_metrics"
)
_Q["lcr_status"] = f"SELECT {_GRAIN}, {_STATUS} AS lcr_status FROM combined_metrics"
_Q["dim_lookup"] = f"""
SELECT {_GRAIN}, date_key, country_key, subsidiary_key FROM combined_metrics m
JOIN dim_date USING (business_date)
JOIN dim_country ON m.country = country_name
JOIN (SELECT subsidiary_key, subsidiary_name AS subsidiary, country FROM dim_subsidiary)
  USING (country, subsidiary)"""
_Q["surrogate_key_fact"] = f"""
SELECT {_GRAIN}, row_number() OVER (ORDER BY business_date NULLS FIRST, country NULLS FIRST,
  subsidiary NULLS FIRST) AS row_key FROM combined_metrics"""
_Q["hqla_aggregated"] = _typed("fact_hqla_position", "hqla_aggregated")
_Q["funding_aggregated"] = _typed("fact_funding_stability", "funding_aggregated")
_Q["collateral_aggregated"] = _typed("fact_collateral_risk", "collateral_aggregated")
_SHARE = "CAST(concentration_percentage AS DECIMAL(8,4)) AS concentration_percentage"
_Q["hqla_concentration"] = (
    f"SELECT {_GRAIN}, hqla_level, asset_type, credit_rating, {_SHARE} FROM hqla_shares")
_Q["funding_concentration"] = (
    f"SELECT {_GRAIN}, maturity_bucket, customer_segment, account_type, {_SHARE} "
    "FROM funding_shares")
_Q["collateral_concentration"] = (
    f"SELECT {_GRAIN}, collateral_type, quality_rating, collateral_status, {_SHARE} "
    "FROM collateral_shares")
_Q["stable_funding_ratio"] = (
    f"SELECT {_GRAIN}, maturity_bucket, customer_segment, account_type, "
    f"CAST({_STABLE} AS DECIMAL(8,4)) AS stable_funding_ratio FROM funding_aggregated")
_Q["inactive_accounts"] = f"""
SELECT {_GRAIN}, CAST(inactive_account_count AS INT) AS inactive_account_count,
  CAST(inactive_balance_eur AS DECIMAL(20,2)) AS inactive_balance_eur
FROM (SELECT {_GRAIN}, {_INACTIVE} FROM silver_balances GROUP BY ALL)"""
_Q["overdue_reviews"] = f"""
SELECT {_GRAIN}, CAST(overdue_review_count AS INT) AS overdue_review_count,
  CAST(overdue_review_value_eur AS DECIMAL(20,2)) AS overdue_review_value_eur
FROM (SELECT {_GRAIN}, {_OVERDUE} FROM silver_collateral GROUP BY ALL)"""
_Q["quality_score"] = (
    f"SELECT {_GRAIN}, {_AVG_SCORE} AS quality_score FROM silver_collateral GROUP BY {_GRAIN}")

_TOTAL = {"fact_intraday_liquidity": "total_hqla_eligible_eur",
          "fact_hqla_position": "total_eligible_value_eur",
          "fact_funding_stability": "total_balance_eur",
          "fact_collateral_risk": "total_net_value_eur"}
_NO_DATE = "CAST(NULL AS DATE)"
_NO_TOTAL = "CAST(NULL AS DECIMAL(28,2)) AS total_value_eur"
_Q["gold_summary"] = _union_all(
    [
        "SELECT 'dim_date' AS table_name, 'dimension' AS table_type, count(*) AS record_count, "
        f"min(business_date) AS min_date, max(business_date) AS max_date, {_NO_TOTAL} FROM dim_date"
    ]
    + [
        f"SELECT '{t}', 'dimension', count(*), {_NO_DATE}, {_NO_DATE}, {_NO_TOTAL} FROM {t}"
        for t in ("dim_country", "dim_subsidiary", "dim_account")
    ]
    + [
        f"SELECT '{t}', 'fact', count(*), min(business_date), max(business_date), "
        f"CAST(sum({v}) AS DECIMAL(28,2)) FROM {t} JOIN dim_date USING (date_key)"
        for t, v in _TOTAL.items()
    ]
)
_Q["gold_summary_short"] = """
SELECT 'dim_date' AS table_name, count(*) AS record_count, min(business_date) AS min_date,
  max(business_date) AS max_date FROM dim_date
UNION ALL
SELECT 'fact_intraday_liquidity', count(*), min(business_date), max(business_date)
FROM fact_intraday_liquidity JOIN dim_date USING (date_key)"""
_PK = {t: GOLD[t].names[0] for t in GOLD}
_Q["pk_violations"] = _union_all(
    f"SELECT '{t}' AS table_name, '{k}' AS key_column, "
    f"count(*) FILTER (WHERE {k} IS NULL) AS null_key_rows, "
    f"count(*) FILTER (WHERE {k} IS NOT NULL AND copies > 1) AS duplicate_key_rows "
    f"FROM (SELECT {k}, count(*) OVER (PARTITION BY {k}) AS copies FROM {t})"
    for t, k in _PK.items()
)
_Q["fk_orphans"] = _union_all(
    f"SELECT '{t}' AS fact_table, '{d}_key' AS key_column, count(*) AS orphan_rows "
    f"FROM {t} f WHERE NOT EXISTS (SELECT 1 FROM dim_{d} x WHERE x.{d}_key = f.{d}_key)"
    for t in _TOTAL for d in ("date", "country", "subsidiary")
)
_Q["haircut_by_level_check"] = """
SELECT trim(hqla_level) AS hqla_level, haircut_rate, count(*) AS record_count,
  if(coalesce(haircut_rate BETWEEN low AND high, false), 'Y', 'N') AS fits_level
FROM bronze_hqla LEFT JOIN (VALUES ('Level 1', 0, 0), ('Level 2A', 0.15, 0.15),
  ('Level 2B', 0.25, 0.50)) AS r(level, low, high) ON trim(hqla_level) = level
GROUP BY ALL"""

_LCR_AVG = _avg("liquidity_coverage_ratio", 4, 8, "DECIMAL(14,8)")
_LCR_AVG_4 = _avg("liquidity_coverage_ratio", 4, 4, "DECIMAL(10,4)")
_BY_COUNTRY = "FROM fact_intraday_liquidity JOIN dim_country USING (country_key)"
_Q["lcr_by_country_status"] = f"""
SELECT country_name, lcr_status, {_LCR_AVG} AS avg_lcr, count(*) AS record_count
{_BY_COUNTRY} GROUP BY country_name, lcr_status"""
_Q["lcr_days_measured"] = f"""
SELECT country_name, lcr_status, {_LCR_AVG_4} AS avg_lcr, count(*) AS days_measured
{_BY_COUNTRY} GROUP BY country_name, lcr_status"""
_Q["lcr_by_risk_category"] = f"""
SELECT country_name, liquidity_risk_category, lcr_status, {_LCR_AVG_4} AS avg_lcr
{_BY_COUNTRY} GROUP BY country_name, liquidity_risk_category, lcr_status"""
_Q["latest_lcr_snapshot"] = f"""
SELECT country_name, liquidity_risk_category, {_LCR_AVG_4} AS avg_lcr,
  CAST(sum(total_hqla_eligible_eur) AS DECIMAL(28,2)) AS total_hqla_eur,
  CAST(sum(total_cash_outflows_30d) AS DECIMAL(28,2)) AS total_outflows_eur,
  max(lcr_status) AS lcr_status
{_BY_COUNTRY} JOIN dim_date USING (date_key)
WHERE business_date = (SELECT max(business_date) FROM dim_date)
GROUP BY country_name, liquidity_risk_category"""
_Q["hqla_composition"] = """
SELECT hqla_level, CAST(sum(total_eligible_value_eur) AS DECIMAL(28,2)) AS total_value_eur,
  CAST(sum(asset_count) AS BIGINT) AS asset_count FROM fact_hqla_position GROUP BY hqla_level"""
_Q["lcr_trend_by_country"] = f"""
SELECT business_date, country_name, {_LCR_AVG_4} AS avg_lcr
{_BY_COUNTRY} JOIN dim_date USING (date_key) GROUP BY business_date, country_name"""
_Q["hqla_vs_outflows_by_country"] = f"""
SELECT country_name, CAST(sum(total_hqla_eligible_eur) AS DECIMAL(28,2)) AS total_hqla_eur,
  CAST(sum(total_cash_outflows_30d) AS DECIMAL(28,2)) AS total_outflows_eur
{_BY_COUNTRY} GROUP BY country_name"""


def _amounts(dataset: str, group: str, more: str = "") -> str:
    amount = _AMOUNT[dataset]
    return (
        f"SELECT trim({group}) AS {group}, count({amount}) AS record_count, "
        f"CAST(sum({amount}) AS DECIMAL(28,2)) AS total_eur, "
        f"{_avg(amount, 2, 2, 'DECIMAL(20,2)')} AS mean_eur{more} "
        f"FROM bronze_{dataset} WHERE {group} IS NOT NULL GROUP BY trim({group})"
    )


_Q["balances_by_country"] = _amounts(
    "balances", "country",
    f", {_avg('weighted_outflow_rate', 4, 2, 'DECIMAL(8,2)')} AS mean_outflow_rate")
_Q["hqla_by_level"] = _amounts("hqla", "hqla_level")
_Q["collateral_by_type"] = _amounts("collateral", "collateral_type")
_Q["volatility_pivot"] = "SELECT trim(country) AS country, " + ", ".join(
    f"count(*) FILTER (WHERE balance_volatility = '{v}') AS \"{v}\""
    for v in ("High", "Low", "Medium")
) + " FROM bronze_balances WHERE country IS NOT NULL GROUP BY trim(country)"

_Q["fx_to_eur"] = """
SELECT source_file, currency, balance_local, CAST(round(balance_local * rate, 2) AS DECIMAL(18,2))
  AS converted_eur
FROM bronze_balances LEFT JOIN (VALUES ('EUR', CAST(1 AS DECIMAL(8,4))), ('GBP', 1.17),
  ('CHF', 1.05), ('PLN', 0.22), ('SEK', 0.095)) AS r(code, rate) ON currency = code"""
_Q["hqla_haircut_rate"] = """
SELECT source_file, hqla_level, CAST(CASE trim(hqla_level) WHEN 'Level 1' THEN 0
  WHEN 'Level 2A' THEN 0.15 ELSE haircut_rate END AS DECIMAL(8,4)) AS level_haircut
FROM bronze_hqla"""
_Q["eligible_hqla_value"] = """
SELECT source_file, market_value_eur, haircut_rate,
  CAST(round(market_value_eur - market_value_eur * haircut_rate, 2) AS DECIMAL(18,2))
    AS eligible_eur
FROM bronze_hqla"""
_Q["quality_adjusted_haircut"] = """
SELECT source_file, quality_rating, haircut_percentage,
  CAST(CASE WHEN upper(trim(quality_rating)) = 'D' AND haircut_percentage > 0.4 THEN 0.6
    WHEN upper(trim(quality_rating)) = 'D' THEN haircut_percentage * 1.5
    WHEN upper(trim(quality_rating)) = 'C' AND haircut_percentage > 0.375 THEN 0.45
    WHEN upper(trim(quality_rating)) = 'C' THEN haircut_percentage * 1.2
    ELSE haircut_percentage END AS DECIMAL(9,5)) AS adjusted_haircut
FROM bronze_collateral"""
_Q["net_realizable_value"] = """
SELECT source_file, gross_value_eur, haircut_percentage,
  CAST(round(gross_value_eur - gross_value_eur * haircut_percentage, 2) AS DECIMAL(18,2)) AS net_eur
FROM bronze_collateral"""
_Q["stable_funding_flag"] = """
SELECT source_file, maturity_bucket,
  if(maturity_bucket IN ('180-day', '1-year', '>1-year'), 'Y', 'N') AS stable_flag
FROM bronze_balances"""
_Q["business_key"] = """
SELECT source_file, country, 'ACC' || upper(left(country, 3))
  || format('{:06d}', TRY_CAST(substr(trim(account_id), 7) AS BIGINT)) AS account_key_text
FROM bronze_balances"""
_Q["next_review_date"] = """
SELECT source_file, valuation_date, liquidation_period_days,
  valuation_date + liquidation_period_days AS review_date FROM bronze_collateral"""
_Q["reporting_calendar"] = """
SELECT CAST(unnest(generate_series(CAST(min(business_date) AS TIMESTAMP),
  CAST(max(business_date) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS business_date
FROM bronze_balances"""


def _counts(layer: str, tables) -> list[str]:
    return [
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, 'completed' AS status, "
        f"count(*) AS record_count FROM {source}" for name, source in tables
    ]


_BRONZE_COUNTS = _counts("bronze", [(f"bronze_{d}", f"bronze_{d}") for d in BRONZE])
_Q["run_layer"] = _union_all(_BRONZE_COUNTS)
_Q["run_all"] = _union_all(
    _BRONZE_COUNTS
    + _counts("silver", [(f"silver_{d}", f"silver_{d}") for d in BRONZE])
    + _counts("gold", [("liquidity_metrics", "combined_metrics"), *[(t, t) for t in GOLD]])
)
_FIRST_KEY = FIRST_DELIVERY.replace("-", "")


def _loaded_keys(fact: str, key: str) -> str:
    early = f"date_key < {_FIRST_KEY}"
    return f"""
SELECT '{fact}' AS table_name, '{key}' AS key_column,
  CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_key_rows,
  CAST(coalesce(sum(n) FILTER (WHERE k IS NOT NULL AND n > 1), 0) AS BIGINT) AS duplicate_key_rows
FROM (SELECT k, count(*) AS n FROM (
  SELECT CASE WHEN {early} OR {key} % 11 <> 0 THEN {key} END AS k FROM {fact}
  UNION ALL SELECT {key} FROM {fact} WHERE {early} AND {key} % 7 = 0) GROUP BY k)"""


_Q["new_load_violations"] = " UNION ALL ".join(_loaded_keys(f, PRIMARY_KEYS[f]) for f in FACTS)
_Q["resume_all"] = (
    f"SELECT * REPLACE (CASE layer WHEN 'gold' THEN status ELSE 'current' END AS status) FROM ({_Q['run_all']})"
)


def _needed(sql: str, found: dict[str, None]) -> dict[str, None]:
    """Names of the building blocks `sql` mentions, innermost first."""
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
    for name in CTES:
        if name in words and name not in found:
            _needed(CTES[name], found)
            found[name] = None
    return found


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in _Q.items():
        blocks = ",\n".join(f"{n} AS ({CTES[n]})" for n in _needed(sql, {}))
        out[name] = f"WITH {blocks}\n{sql}"
    assert out.keys() <= QUERIES.keys()
    return out
