from decimal import Decimal as D

from pyspark.sql import functions as F

from ebbtide.functions import ratios, rules
from ebbtide.functions.calendar import reporting_calendar
from ebbtide.operators import facts
from ebbtide.schemas import SILVER

DAY = "2024-01-01"
PLACE = {"business_date": DAY, "country": "Italy", "subsidiary": "S"}


def status(spark, eligible, outflow):
    df = spark.sql(
        f"SELECT CAST({eligible} AS DECIMAL(28,2)) h, CAST({outflow} AS DECIMAL(37,6)) o"
    )
    args = F.col("h"), F.col("o")
    return tuple(df.select(
        ratios.lcr_ratio(*args), ratios.lcr_surplus_deficit(*args), ratios.lcr_status(*args)
    ).first())


def test_ratio_edges(spark):
    assert status(spark, 5, 0) == (None, 5, "No Outflows")
    assert status(spark, 5, -2) == (None, 5, "Non-Compliant")
    assert status(spark, -5, -2) == (None, -5, "Compliant")
    assert status(spark, 0, 4) == (0, -4, "Non-Compliant")
    assert status(spark, "9999996.00", "10000000") == (1, -4, "Compliant")
    assert status(spark, "0.90", 1) == (D("0.9"), D("-0.1"), "At Risk")
    assert status(spark, "0.89", 1)[2] == "Non-Compliant"


def test_flags_outside_the_domain_count_nowhere(rows):
    df = rows(SILVER["balances"], *[
        {**PLACE, "account_id": f, "balance_eur": "10", "stable_funding_flag": f} for f in ("Y", "N", "?")
    ])
    row = facts.balance_metrics(df).first()
    assert (row.total_balance_eur, row.stable_funding_amount, row.unstable_funding_amount) == (30, 10, 10)


def test_accounts_are_counted_once_unless_known_unique(rows):
    one = {**PLACE, "account_id": "A", "balance_eur": "10"}
    df = rows(SILVER["balances"], one, one)
    assert facts.balance_metrics(df).first().account_count == 1
    assert facts.balance_metrics(df, accounts_unique=True).first().account_count == 2


def test_missing_dates_are_neither_inactive_nor_overdue(rows):
    balances = rows(SILVER["balances"], *[
        {**PLACE, "account_id": str(d), "balance_eur": "1", "last_transaction_date": d}
        for d in (None, "2023-12-02", "2023-12-01")
    ])
    assert balances.agg(*facts.inactive_sums()).first()[:] == (1, 1)
    pledged = rows(SILVER["collateral"], *[
        {**PLACE, "collateral_id": str(d), "net_realizable_value_eur": "1", "next_review_date": d}
        for d in (None, DAY, "2023-12-31")
    ])
    assert pledged.agg(*facts.overdue_sums()).first()[:] == (1, 1)


def test_combined_metrics_equal_full_joins(lake):
    silver = lake.silver()
    joined = (
        facts.balance_metrics(silver["balances"])
        .join(facts.hqla_metrics(silver["hqla"]), facts.GRAIN, "full")
        .join(facts.collateral_metrics(silver["collateral"]), facts.GRAIN, "full")
        .na.fill(0)
    )
    metrics = facts.combined_metrics(**silver).select(joined.columns)
    # rows without a place are one group here and drop out of the facts; full joins keep them apart
    values = [F.sum(c).alias(c) for c in joined.columns if c not in (*facts.GRAIN, "account_count")]
    assert metrics.agg(*values).collect() == joined.agg(*values).collect()
    metrics, joined = (df.dropna(subset=facts.GRAIN) for df in (metrics, joined))
    assert metrics.exceptAll(joined).isEmpty() and joined.exceptAll(metrics).isEmpty()


def test_unplaced_rows_drop_out_of_facts(rows, lake):
    italy = lake.dims().subsidiary.filter("country = 'Italy' AND subsidiary_name IS NOT NULL").first().subsidiary_name
    day = str(lake.dims().date.first().business_date)
    base = {"business_date": day, "country": "Italy", "subsidiary": italy, "asset_id": "H",
            "hqla_level": "Level 1", "eligible_hqla_value_eur": "4", "market_value_eur": "4",
            "liquidity_score": "9", "haircut_rate": "0", "yield_rate": "0"}
    df = rows(SILVER["hqla"], base, {**base, "country": None}, {**base, "subsidiary": None},
              {**base, "subsidiary": "unknown"}, {**base, "business_date": "1900-01-01"})
    row, = facts.fact_hqla_position(df, facts.hqla_metrics(df), lake.dims()).collect()
    assert (row.hqla_position_key, row.asset_count, row.concentration_percentage) == (1, 1, 100)


def test_share_of_nothing_is_zero(rows):
    df = rows(SILVER["hqla"], {**PLACE, "asset_id": "H", "eligible_hqla_value_eur": "0"})
    assert facts.hqla_concentration(df, facts.hqla_metrics(df)).first().concentration_percentage == 0


def test_invariants(lake):
    fact = lake.table("fact_intraday_liquidity")
    assert fact.filter(
        "hqla_level1_eur + hqla_level2a_eur + hqla_level2b_eur <> total_hqla_eligible_eur"
        " or stable_funding_amount + unstable_funding_amount > total_balance_eur"
    ).isEmpty()
    # flags outside Y and N count on neither side
    odd = lake.silver()["balances"].filter("stable_funding_flag NOT IN ('Y', 'N')").dropna(subset=facts.GRAIN)
    left = fact.agg(F.sum(F.expr("total_balance_eur - stable_funding_amount - unstable_funding_amount"))).first()[0]
    assert left == odd.agg(F.sum("balance_eur")).first()[0]
    for name in ("fact_hqla_position", "fact_funding_stability", "fact_collateral_risk"):
        shares = lake.table(name).groupBy(*facts.GRAIN_KEYS).agg(
            F.sum("concentration_percentage").alias("s"), F.count("*").alias("n")
        )
        # shares of a total that is not positive are 0
        assert shares.filter("abs(s - 100) > 0.0001 * n AND s <> 0").isEmpty()
        assert not shares.filter("s > 0").isEmpty()


def test_row_rules(spark):
    df = spark.sql("SELECT 'United Kingdom' c, 1234567L n, 12L m, CAST(0.4321 AS DECIMAL(8,4)) h, "
                   "CAST(100.005 AS DECIMAL(18,3)) a")
    row = df.select(
        rules.business_key("ACC", F.col("c"), F.col("n")).alias("long"),
        rules.business_key("LOAN", F.col("c"), F.col("m")).alias("short"),
        rules.quality_adjusted_haircut(F.lit("D"), F.col("h")).alias("d"),
        rules.quality_adjusted_haircut(F.lit("C"), F.col("h") / 2).alias("c"),
        rules.quality_adjusted_haircut(F.lit("A"), F.col("h")).alias("a"),
        rules.fx_to_eur(F.col("a"), F.lit("GBP")).alias("gbp"),
        rules.fx_to_eur(F.col("a"), F.lit("USD")).alias("usd"),
    ).first()
    assert (row.long, row.short) == ("ACCUNI1234567", "LOANUNI000012")
    assert (row.d, row.c, row.a) == (D("0.6"), D("0.25926"), D("0.4321"))
    assert (row.gbp, row.usd) == (D("117.01"), None)


def test_reporting_calendar(spark):
    def days(start, end):
        bounds = spark.sql(f"SELECT DATE '{start}' start_date, DATE '{end}' end_date")
        return [str(r[0]) for r in reporting_calendar(bounds).collect()]

    assert days("2024-01-15", "2024-03-01") == ["2024-01-15", "2024-02-01", "2024-03-01"]
    assert days("2024-01-15", "2024-01-20") == ["2024-01-15"]
    assert days("2024-02-01", "2024-01-01") == []
