"""Reports.  Averages are over the ratios of the subsidiaries, not ratios of sums,
and skip positions without outflow."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.conform import conform
from ebbtide.operators.facts import GRAIN, Dims, combined_metrics, dim_lookup, liquidity_ratios
from ebbtide.operators.keys import surrogate_key_fact
from ebbtide.schemas import GOLD
from ebbtide.sources.landing import with_load_timestamp
from ebbtide.sources.storage import materialise

# The two-table ratio has the liquidity fact's columns that need no collateral.
_TWO_WAY = T.StructType([
    f for f in GOLD["fact_intraday_liquidity"]
    if "collateral" not in f.name
    and f.name not in ("total_balance_local", "total_hqla_gross_eur", "hqla_unencumbered_eur",
                       "weighted_outflow_amount")
])


def _average() -> Column:
    return F.avg("liquidity_coverage_ratio")


def _rounded_average() -> Column:
    return F.round(_average(), 4).cast("decimal(10,4)").alias("avg_lcr")


def _by_country(fact: DataFrame, countries: DataFrame, *groups: str) -> GroupedData:
    named = countries.select("country_key", "country_name", *groups)
    return fact.join(named, "country_key").groupBy("country_name", *groups, "lcr_status")


def lcr_by_country_status(fact: DataFrame, countries: DataFrame) -> DataFrame:
    return (
        _by_country(fact, countries)
        .agg(_average().alias("avg_lcr"), F.count("*").alias("record_count"))
        .orderBy("avg_lcr")
    )


def lcr_days_measured(fact: DataFrame, countries: DataFrame) -> DataFrame:
    return (
        _by_country(fact, countries)
        .agg(_rounded_average(), F.count("*").alias("days_measured"))
        .orderBy("avg_lcr")
    )


def lcr_by_risk_category(fact: DataFrame, countries: DataFrame) -> DataFrame:
    return (
        _by_country(fact, countries, "liquidity_risk_category")
        .agg(_rounded_average())
        .orderBy("avg_lcr")
    )


def latest_lcr_snapshot(fact: DataFrame, countries: DataFrame, dates: DataFrame) -> DataFrame:
    """Position per country on the last day.  The status is the alphabetically last
    one, so `At Risk` shows only where no other status occurs."""
    last_key = dates.agg(F.max_by("date_key", "business_date")).scalar()
    return (
        fact.filter(F.col("date_key") == last_key)
        .join(countries, "country_key")
        .groupBy("country_name", "liquidity_risk_category")
        .agg(
            _rounded_average(),
            F.sum("total_hqla_eligible_eur").cast("decimal(28,2)").alias("total_hqla_eur"),
            F.sum("total_cash_outflows_30d").cast("decimal(28,2)").alias("total_outflows_eur"),
            F.max("lcr_status").alias("lcr_status"),
        )
        .orderBy("avg_lcr")
    )


def hqla_composition(positions: DataFrame) -> DataFrame:
    return (
        positions.groupBy("hqla_level")
        .agg(
            F.sum("total_eligible_value_eur").cast("decimal(28,2)").alias("total_value_eur"),
            F.sum("asset_count").alias("asset_count"),
        )
        .orderBy(F.desc("total_value_eur"))
    )


def lcr_trend_by_country(fact: DataFrame, countries: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        fact.join(dates.select("date_key", "business_date"), "date_key")
        .join(countries, "country_key")
        .groupBy("business_date", "country_name")
        .agg(_rounded_average())
        .orderBy("business_date", "country_name")
    )


def hqla_vs_outflows_by_country(fact: DataFrame, countries: DataFrame) -> DataFrame:
    sums = fact.groupBy("country_key").agg(
        F.sum("total_hqla_eligible_eur").alias("_hqla"),
        F.sum("total_cash_outflows_30d").alias("_outflow"),
    )
    return (
        sums.join(countries, "country_key")
        .groupBy("country_name")
        .agg(
            F.sum("_hqla").cast("decimal(28,2)").alias("total_hqla_eur"),
            F.sum("_outflow").cast("decimal(28,2)").alias("total_outflows_eur"),
        )
        .orderBy("country_name")
    )


def _amount_summary(df: DataFrame, group: str, amount: str, *more: Column) -> DataFrame:
    return (
        df.filter(F.col(group).isNotNull())
        .groupBy(F.trim(group).alias(group))
        .agg(
            F.count(amount).alias("record_count"),
            F.sum(amount).cast("decimal(28,2)").alias("total_eur"),
            F.round(F.avg(amount), 2).cast("decimal(20,2)").alias("mean_eur"),
            *more,
        )
        .orderBy(group)
    )


def balances_by_country(balances: DataFrame) -> DataFrame:
    rate = F.round(F.avg("weighted_outflow_rate"), 2).cast("decimal(8,2)")
    return _amount_summary(balances, "country", "balance_eur", rate.alias("mean_outflow_rate"))


def hqla_by_level(hqla: DataFrame) -> DataFrame:
    return _amount_summary(hqla, "hqla_level", "eligible_hqla_value_eur")


def collateral_by_type(collateral: DataFrame) -> DataFrame:
    return _amount_summary(collateral, "collateral_type", "net_realizable_value_eur")


def volatility_pivot(balances: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """Rows per country, one column per volatility that occurs, or per one of `values`.

    More than `spark.sql.pivotMaxValues` different values fail the query.  Finding the
    values needs a job of its own, so the short counts are stored first and the balances
    are read once."""
    columns = ["country", "balance_volatility"]
    known = balances.dropna(subset=columns).withColumn("country", F.trim("country"))
    counts = known.groupBy(*columns).count()
    if values is None:
        counts = materialise(counts, "volatility")
    wide = counts.groupBy("country").pivot("balance_volatility", values and list(values))
    return wide.sum("count").na.fill(0).orderBy("country")


def lcr_two_way(balances: DataFrame, hqla: DataFrame, dims: Dims,
                load_time: Column | None = None, accounts_unique: bool = False) -> DataFrame:
    """Liquidity ratio from balances and liquid assets alone."""
    metrics = combined_metrics(balances, hqla, None, accounts_unique)
    keyed = surrogate_key_fact(dim_lookup(metrics, dims), "liquidity_key", GRAIN)
    return conform(with_load_timestamp(liquidity_ratios(keyed), load_time), _TWO_WAY)
