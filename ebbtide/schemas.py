"""Declared schemas of the fourteen tables, with a comment on every column."""

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DAY = T.DateType()
TIME = T.TimestampType()
MONEY = T.DecimalType(18, 2)
TOTAL = T.DecimalType(20, 2)
RATE = T.DecimalType(8, 4)

COMMENTS = {
    "account_id": "Business key of the account",
    "asset_id": "Business key of the liquid asset",
    "collateral_id": "Business key of the pledged item",
    "country": "Country of the booking entity",
    "subsidiary": "Legal entity that books the position",
    "account_type": "Product the account belongs to",
    "currency": "ISO currency of the local amounts",
    "balance_local": "Balance in local currency",
    "balance_eur": "Balance in euro",
    "customer_segment": "Retail, Corporate or Institutional",
    "maturity_bucket": "Residual maturity band",
    "weighted_outflow_rate": "Share of the balance expected to run off in stress",
    "stable_funding_flag": "Y if the balance counts as stable funding",
    "last_transaction_date": "Day of the latest movement",
    "average_balance_30d": "Mean local balance of the last thirty days",
    "balance_volatility": "Low, Medium or High",
    "business_date": "Day the snapshot describes",
    "created_timestamp": "Creation time in the delivering system",
    "source_file": "Landing file the row was read from",
    "load_timestamp": "Time of the load that wrote the row",
    "silver_load_timestamp": "Time the cleaned row was written",
    "hqla_level": "Level 1, Level 2A or Level 2B",
    "asset_type": "Instrument class",
    "market_value_local": "Market value in local currency",
    "market_value_eur": "Market value in euro",
    "haircut_rate": "Share taken off the market value",
    "eligible_hqla_value_eur": "Market value in euro after the haircut",
    "maturity_date": "Day the instrument matures",
    "credit_rating": "External rating",
    "liquidity_score": "Liquidity from 1 (poor) to 10 (best)",
    "encumbered_flag": "Y if pledged elsewhere",
    "central_bank_eligible": "Y if a central bank accepts it",
    "yield_rate": "Current yield",
    "duration_years": "Duration in years",
    "last_valuation_date": "Day of the latest valuation",
    "collateral_type": "Kind of pledged item",
    "gross_value_local": "Value before haircut in local currency",
    "gross_value_eur": "Value before haircut in euro",
    "loan_to_value_ratio": "Loan amount over collateral value",
    "haircut_percentage": "Share taken off the gross value",
    "net_realizable_value_eur": "Value in euro after the haircut",
    "associated_loan_id": "Loan the item secures",
    "collateral_status": "Active, Under Review or Released",
    "valuation_date": "Day of the valuation",
    "next_review_date": "Day the next review is due",
    "quality_rating": "A (best) to D (poorest)",
    "liquidation_period_days": "Days needed to sell",
    "insurance_status": "Y if insured",
    "legal_ownership": "Owned, Leased or Third-party",
    "concentration_risk_flag": "Y if part of a concentrated exposure",
    "date_key": "Date as yyyymmdd number",
    "country_key": "Key of the country row",
    "subsidiary_key": "Key of the subsidiary row",
    "account_key": "Key of the account row",
    "year": "Calendar year",
    "quarter": "Calendar quarter",
    "month": "Month number",
    "month_name": "English month name",
    "day_of_month": "Day within the month",
    "day_of_week": "1 for Sunday to 7 for Saturday",
    "day_name": "English weekday name",
    "week_of_year": "ISO week number",
    "is_weekend": "Y on Saturday and Sunday",
    "is_month_end": "Y on the last day of a month",
    "is_quarter_end": "Y on the last day of a quarter",
    "is_year_end": "Y on the last day of a year",
    "fiscal_year": "Equal to the calendar year",
    "fiscal_quarter": "Equal to the calendar quarter",
    "country_name": "Country as delivered",
    "country_code": "Three-letter ISO code",
    "region": "Part of Europe",
    "is_eurozone": "Y for euro members",
    "liquidity_risk_category": "Low, Medium, High or Unknown",
    "subsidiary_name": "Subsidiary as delivered",
    "subsidiary_type": "Business line derived from the name",
    "effective_date": "Day the row describes or takes effect",
    "end_date": "Last day the row held, NULL while current",
    "is_current": "Y while current",
    "liquidity_key": "Row key",
    "hqla_position_key": "Row key",
    "funding_stability_key": "Row key",
    "collateral_risk_key": "Row key",
    "total_balance_eur": "Sum of balances in euro",
    "total_balance_local": "Sum of balances in local currency",
    "account_count": "Number of accounts",
    "total_hqla_gross_eur": "Liquid assets at market value",
    "total_hqla_eligible_eur": "Liquid assets after haircut",
    "hqla_level1_eur": "Level 1 assets after haircut",
    "hqla_level2a_eur": "Level 2A assets after haircut",
    "hqla_level2b_eur": "Level 2B assets after haircut",
    "hqla_unencumbered_eur": "Unpledged assets after haircut",
    "total_cash_outflows_30d": "Stressed outflow, denominator of the ratio",
    "weighted_outflow_amount": "Balance times outflow rate",
    "stable_funding_amount": "Balances flagged stable",
    "unstable_funding_amount": "Balances flagged not stable",
    "total_collateral_gross_eur": "Collateral before haircut",
    "total_collateral_net_eur": "Collateral after haircut",
    "high_quality_collateral_eur": "Net collateral rated A or B",
    "liquidity_coverage_ratio": "Eligible assets over outflow",
    "lcr_surplus_deficit_eur": "Eligible assets minus outflow",
    "lcr_status": "Compliant, At Risk, Non-Compliant or No Outflows",
    "asset_count": "Number of assets",
    "total_market_value_eur": "Sum of market values",
    "total_eligible_value_eur": "Sum of values after haircut",
    "average_haircut_rate": "Mean haircut",
    "average_yield_rate": "Mean yield",
    "average_liquidity_score": "Mean liquidity score",
    "encumbered_value_eur": "Eligible value of pledged assets",
    "unencumbered_value_eur": "Eligible value of unpledged assets",
    "central_bank_eligible_value_eur": "Eligible value a central bank accepts",
    "concentration_percentage": "Percent of the subsidiary's total that day",
    "average_balance_eur": "Mean balance",
    "stable_funding_balance_eur": "Balances flagged stable",
    "unstable_funding_balance_eur": "Balances flagged not stable",
    "average_outflow_rate": "Mean outflow rate",
    "high_volatility_balance_eur": "Balances of high volatility",
    "medium_volatility_balance_eur": "Balances of medium volatility",
    "low_volatility_balance_eur": "Balances of low volatility",
    "inactive_account_count": "Accounts without movement for over thirty days",
    "inactive_balance_eur": "Balances of those accounts",
    "stable_funding_ratio": "Stable share of the balance",
    "collateral_count": "Number of items",
    "total_gross_value_eur": "Sum before haircut",
    "total_net_value_eur": "Sum after haircut",
    "average_haircut_percentage": "Mean haircut",
    "average_ltv_ratio": "Mean loan-to-value ratio",
    "average_liquidation_days": "Mean days needed to sell",
    "high_concentration_value_eur": "Net value of concentrated exposures",
    "insured_value_eur": "Net value insured",
    "uninsured_value_eur": "Net value not insured",
    "active_collateral_value_eur": "Net value in status Active",
    "under_review_value_eur": "Net value in status Under Review",
    "overdue_review_count": "Items whose review is overdue",
    "overdue_review_value_eur": "Net value of those items",
    "quality_score": "Mean score, A = 4 to D = 1",
}


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(n, t, True, {"comment": COMMENTS[n]}) for n, t in columns.items()]
    )


_LINEAGE = {"source_file": TEXT, "load_timestamp": TIME}

BRONZE = {
    "balances": _table(
        account_id=TEXT, country=TEXT, subsidiary=TEXT, account_type=TEXT, currency=TEXT,
        balance_local=MONEY, balance_eur=MONEY, customer_segment=TEXT, maturity_bucket=TEXT,
        weighted_outflow_rate=RATE, stable_funding_flag=TEXT, last_transaction_date=DAY,
        average_balance_30d=MONEY, balance_volatility=TEXT, business_date=DAY,
        created_timestamp=TIME, **_LINEAGE,
    ),
    "hqla": _table(
        asset_id=TEXT, country=TEXT, subsidiary=TEXT, hqla_level=TEXT, asset_type=TEXT,
        currency=TEXT, market_value_local=MONEY, market_value_eur=MONEY, haircut_rate=RATE,
        eligible_hqla_value_eur=MONEY, maturity_date=DAY, credit_rating=TEXT,
        liquidity_score=INT, encumbered_flag=TEXT, central_bank_eligible=TEXT, yield_rate=RATE,
        duration_years=T.DecimalType(8, 2), last_valuation_date=DAY, business_date=DAY,
        created_timestamp=TIME, **_LINEAGE,
    ),
    "collateral": _table(
        collateral_id=TEXT, country=TEXT, subsidiary=TEXT, collateral_type=TEXT, currency=TEXT,
        gross_value_local=MONEY, gross_value_eur=MONEY, loan_to_value_ratio=RATE,
        haircut_percentage=RATE, net_realizable_value_eur=MONEY, associated_loan_id=TEXT,
        collateral_status=TEXT, valuation_date=DAY, next_review_date=DAY, quality_rating=TEXT,
        liquidation_period_days=INT, insurance_status=TEXT, legal_ownership=TEXT,
        concentration_risk_flag=TEXT, business_date=DAY, created_timestamp=TIME, **_LINEAGE,
    ),
}

SILVER = {
    name: T.StructType(schema.fields + _table(silver_load_timestamp=TIME).fields)
    for name, schema in BRONZE.items()
}

# What the landing files hold: the delivered columns, all as text.
LANDING = {
    name: T.StructType(
        [T.StructField(f.name, TEXT, True, f.metadata) for f in schema if f.name not in _LINEAGE]
    )
    for name, schema in BRONZE.items()
}

_DIM_KEYS = {"date_key": INT, "country_key": INT, "subsidiary_key": INT}

GOLD = {
    "dim_date": _table(
        date_key=INT, business_date=DAY, year=INT, quarter=INT, month=INT, month_name=TEXT,
        day_of_month=INT, day_of_week=INT, day_name=TEXT, week_of_year=INT, is_weekend=TEXT,
        is_month_end=TEXT, is_quarter_end=TEXT, is_year_end=TEXT, fiscal_year=INT,
        fiscal_quarter=INT,
    ),
    "dim_country": _table(
        country_key=INT, country_name=TEXT, country_code=TEXT, region=TEXT, currency=TEXT,
        is_eurozone=TEXT, liquidity_risk_category=TEXT,
    ),
    "dim_subsidiary": _table(
        subsidiary_key=INT, subsidiary_name=TEXT, country=TEXT, subsidiary_type=TEXT
    ),
    "dim_account": _table(
        account_key=INT, account_id=TEXT, account_type=TEXT, customer_segment=TEXT,
        currency=TEXT, country=TEXT, subsidiary=TEXT, effective_date=DAY, end_date=DAY,
        is_current=TEXT,
    ),
    "fact_intraday_liquidity": _table(
        liquidity_key=LONG, **_DIM_KEYS, total_balance_eur=TOTAL, total_balance_local=TOTAL,
        account_count=INT, total_hqla_gross_eur=TOTAL, total_hqla_eligible_eur=TOTAL,
        hqla_level1_eur=TOTAL, hqla_level2a_eur=TOTAL, hqla_level2b_eur=TOTAL,
        hqla_unencumbered_eur=TOTAL, total_cash_outflows_30d=TOTAL,
        weighted_outflow_amount=TOTAL, stable_funding_amount=TOTAL,
        unstable_funding_amount=TOTAL, total_collateral_gross_eur=TOTAL,
        total_collateral_net_eur=TOTAL, high_quality_collateral_eur=TOTAL,
        liquidity_coverage_ratio=T.DecimalType(10, 4), lcr_surplus_deficit_eur=TOTAL,
        lcr_status=TEXT, load_timestamp=TIME,
    ),
    "fact_hqla_position": _table(
        hqla_position_key=LONG, **_DIM_KEYS, hqla_level=TEXT, asset_type=TEXT,
        credit_rating=TEXT, asset_count=INT, total_market_value_eur=TOTAL,
        total_eligible_value_eur=TOTAL, average_haircut_rate=RATE, average_yield_rate=RATE,
        average_liquidity_score=T.DecimalType(5, 2), encumbered_value_eur=TOTAL,
        unencumbered_value_eur=TOTAL, central_bank_eligible_value_eur=TOTAL,
        concentration_percentage=RATE, load_timestamp=TIME,
    ),
    "fact_funding_stability": _table(
        funding_stability_key=LONG, **_DIM_KEYS, maturity_bucket=TEXT, customer_segment=TEXT,
        account_type=TEXT, account_count=INT, total_balance_eur=TOTAL,
        average_balance_eur=TOTAL, stable_funding_balance_eur=TOTAL,
        unstable_funding_balance_eur=TOTAL, weighted_outflow_amount=TOTAL,
        average_outflow_rate=RATE, high_volatility_balance_eur=TOTAL,
        medium_volatility_balance_eur=TOTAL, low_volatility_balance_eur=TOTAL,
        inactive_account_count=INT, inactive_balance_eur=TOTAL, stable_funding_ratio=RATE,
        concentration_percentage=RATE, load_timestamp=TIME,
    ),
    "fact_collateral_risk": _table(
        collateral_risk_key=LONG, **_DIM_KEYS, collateral_type=TEXT, quality_rating=TEXT,
        collateral_status=TEXT, collateral_count=INT, total_gross_value_eur=TOTAL,
        total_net_value_eur=TOTAL, average_haircut_percentage=RATE, average_ltv_ratio=RATE,
        average_liquidation_days=T.DecimalType(10, 2), high_concentration_value_eur=TOTAL,
        insured_value_eur=TOTAL, uninsured_value_eur=TOTAL, active_collateral_value_eur=TOTAL,
        under_review_value_eur=TOTAL, overdue_review_count=INT, overdue_review_value_eur=TOTAL,
        concentration_percentage=RATE, quality_score=RATE, load_timestamp=TIME,
    ),
}

# The liquidity metrics, stored between silver and gold with every digit of the sums.
_SUM = T.DecimalType(28, 2)
METRICS = _table(
    business_date=DAY, country=TEXT, subsidiary=TEXT, total_balance_eur=_SUM,
    total_balance_local=_SUM, weighted_outflow_amount=T.DecimalType(37, 6),
    stable_funding_amount=_SUM, unstable_funding_amount=_SUM, total_hqla_gross_eur=_SUM,
    total_hqla_eligible_eur=_SUM, hqla_level1_eur=_SUM, hqla_level2a_eur=_SUM,
    hqla_level2b_eur=_SUM, hqla_unencumbered_eur=_SUM, total_collateral_gross_eur=_SUM,
    total_collateral_net_eur=_SUM, high_quality_collateral_eur=_SUM, account_count=LONG,
)

# Primary key of each gold table.
PRIMARY_KEYS = {
    "dim_date": "date_key",
    "dim_country": "country_key",
    "dim_subsidiary": "subsidiary_key",
    "dim_account": "account_key",
    "fact_intraday_liquidity": "liquidity_key",
    "fact_hqla_position": "hqla_position_key",
    "fact_funding_stability": "funding_stability_key",
    "fact_collateral_risk": "collateral_risk_key",
}

FACTS = [name for name in GOLD if name.startswith("fact_")]
