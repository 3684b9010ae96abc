"""Gold facts.

Every fact shuffles rows only after they are summed on the map side; dimensions
carry no broadcast hint, so Spark broadcasts them while they are small enough
and joins them by shuffle (splitting hot keys) once they are not."""

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.calendar import date_key
from ebbtide.functions.ratios import (
    lcr_ratio, lcr_status, lcr_surplus_deficit, share, share_percent,
)
from ebbtide.functions.rules import quality_score
from ebbtide.operators.conform import conform
from ebbtide.operators.keys import number_rows, place_rows, surrogate_key_fact
from ebbtide.schemas import GOLD, LONG
from ebbtide.sources.landing import with_load_timestamp

GRAIN = ["business_date", "country", "subsidiary"]
GRAIN_KEYS = ["date_key", "country_key", "subsidiary_key"]


class Dims(NamedTuple):
    date: DataFrame
    country: DataFrame
    subsidiary: DataFrame


def _where(condition: Column, value: Column) -> Column:
    """`value` where the condition holds, else 0."""
    return F.when(condition, value).otherwise(0)


def _is(column: str, value: str) -> Column:
    return F.col(column) == value


# ---- inputs of the sums, per row ------------------------------------------------------

def _balance_values() -> dict[str, Column]:
    eur = F.col("balance_eur")
    return {
        "total_balance_eur": eur,
        "total_balance_local": F.col("balance_local"),
        "weighted_outflow_amount": eur * F.col("weighted_outflow_rate"),
        "stable_funding_amount": _where(_is("stable_funding_flag", "Y"), eur),
        "unstable_funding_amount": _where(_is("stable_funding_flag", "N"), eur),
    }


def _hqla_values() -> dict[str, Column]:
    eligible = F.col("eligible_hqla_value_eur")
    return {
        "total_hqla_gross_eur": F.col("market_value_eur"),
        "total_hqla_eligible_eur": eligible,
        "hqla_level1_eur": _where(_is("hqla_level", "Level 1"), eligible),
        "hqla_level2a_eur": _where(_is("hqla_level", "Level 2A"), eligible),
        "hqla_level2b_eur": _where(_is("hqla_level", "Level 2B"), eligible),
        "hqla_unencumbered_eur": _where(_is("encumbered_flag", "N"), eligible),
    }


def _collateral_values() -> dict[str, Column]:
    net = F.col("net_realizable_value_eur")
    return {
        "total_collateral_gross_eur": F.col("gross_value_eur"),
        "total_collateral_net_eur": net,
        "high_quality_collateral_eur": _where(F.col("quality_rating").isin("A", "B"), net),
    }


def _sums(values: dict[str, Column]) -> list[Column]:
    return [F.sum(value).alias(name) for name, value in values.items()]


def _count_accounts(unique: bool) -> Column:
    count = F.count("account_id") if unique else F.countDistinct("account_id")
    return count.alias("account_count")


# ---- liquidity coverage ---------------------------------------------------------------

def balance_metrics(balances: DataFrame, accounts_unique: bool = False) -> DataFrame:
    """Balances per day, country and subsidiary.

    `accounts_unique` states that no account occurs twice on a day, as in silver;
    accounts are then counted without a shuffle of all rows."""
    return balances.groupBy(*GRAIN).agg(
        *_sums(_balance_values()), _count_accounts(accounts_unique)
    )


def hqla_metrics(hqla: DataFrame) -> DataFrame:
    return hqla.groupBy(*GRAIN).agg(*_sums(_hqla_values()))


def collateral_metrics(collateral: DataFrame) -> DataFrame:
    return collateral.groupBy(*GRAIN).agg(*_sums(_collateral_values()))


def combined_metrics(balances: DataFrame, hqla: DataFrame, collateral: DataFrame | None,
                     accounts_unique: bool = False) -> DataFrame:
    """All metrics per day, country and subsidiary found in any table, 0 where a
    table has nothing.

    Same rows as full outer joins of the three metrics, from one aggregation of
    the united rows: one shuffle of pre-summed rows.  NULL countries or
    subsidiaries form one group here; the dimension lookup drops them."""
    parts = [(balances, ["account_id"], _balance_values()), (hqla, [], _hqla_values())]
    if collateral is not None:
        parts.append((collateral, [], _collateral_values()))
    rows = [
        df.select(*GRAIN, *extra, *[value.alias(name) for name, value in values.items()])
        for df, extra, values in parts
    ]
    names = [name for _, _, values in parts for name in values]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return united.groupBy(*GRAIN).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names],
        _count_accounts(accounts_unique),
    )


def dim_lookup(df: DataFrame, dims: Dims) -> DataFrame:
    """Add the dimension keys; rows without a dimension row, or with a NULL country
    or subsidiary, drop out."""
    countries = dims.country.select("country_key", F.col("country_name").alias("country"))
    subsidiaries = dims.subsidiary.select(
        "subsidiary_key", F.col("subsidiary_name").alias("subsidiary"), "country"
    )
    return (
        df.withColumn("date_key", date_key(F.col("business_date")))
        .join(dims.date.select("date_key"), "date_key")
        .join(countries, "country")
        .join(subsidiaries, ["country", "subsidiary"])
    )


def liquidity_ratios(metrics: DataFrame) -> DataFrame:
    """Outflow, ratio, surplus and status from the unrounded outflow."""
    eligible, outflow = F.col("total_hqla_eligible_eur"), F.col("weighted_outflow_amount")
    return metrics.withColumns({
        "total_cash_outflows_30d": outflow,
        "liquidity_coverage_ratio": lcr_ratio(eligible, outflow),
        "lcr_surplus_deficit_eur": lcr_surplus_deficit(eligible, outflow),
        "lcr_status": lcr_status(eligible, outflow),
    })


def liquidity_fact(metrics: DataFrame, dims: Dims, load_time: Column | None = None) -> DataFrame:
    """Liquidity fact from combined metrics."""
    keyed = surrogate_key_fact(dim_lookup(metrics, dims), "liquidity_key", GRAIN)
    return conform(
        with_load_timestamp(liquidity_ratios(keyed), load_time), GOLD["fact_intraday_liquidity"]
    )


def fact_intraday_liquidity(balances: DataFrame, hqla: DataFrame, collateral: DataFrame,
                            dims: Dims, load_time: Column | None = None,
                            accounts_unique: bool = False) -> DataFrame:
    metrics = combined_metrics(balances, hqla, collateral, accounts_unique)
    return liquidity_fact(metrics, dims, load_time)


# ---- positions ------------------------------------------------------------------------

class Measures(NamedTuple):
    """What a position fact holds per day, country, subsidiary and `by`: the rows with `counted`, sums, and averages
    over the rows that have the value."""

    by: Sequence[str]
    counted: str
    count: str
    sums: dict[str, Column]
    averages: dict[str, Column]


def aggregated(rows: DataFrame, measures: Measures) -> DataFrame:
    return rows.groupBy(*GRAIN, *measures.by).agg(
        F.count(measures.counted).alias(measures.count),
        *_sums(measures.sums),
        *[F.avg(value).alias(name) for name, value in measures.averages.items()],
    )


def hqla_measures() -> Measures:
    eligible = F.col("eligible_hqla_value_eur")
    return Measures(
        ["hqla_level", "asset_type", "credit_rating"], "asset_id", "asset_count",
        {
            "total_market_value_eur": F.col("market_value_eur"),
            "total_eligible_value_eur": eligible,
            "encumbered_value_eur": _where(_is("encumbered_flag", "Y"), eligible),
            "unencumbered_value_eur": _where(_is("encumbered_flag", "N"), eligible),
            "central_bank_eligible_value_eur": _where(_is("central_bank_eligible", "Y"), eligible),
        },
        {
            "average_haircut_rate": F.col("haircut_rate"),
            "average_yield_rate": F.col("yield_rate"),
            "average_liquidity_score": F.col("liquidity_score"),
        },
    )


def hqla_aggregated(hqla: DataFrame) -> DataFrame:
    return aggregated(hqla, hqla_measures())


def is_inactive() -> Column:
    """No movement for more than thirty days; an unknown date does not count."""
    return F.datediff("business_date", "last_transaction_date") > 30


def is_overdue() -> Column:
    return F.col("next_review_date") < F.col("business_date")


def _inactive_values() -> dict[str, Column]:
    return {
        "inactive_account_count": _where(is_inactive(), F.lit(1)),
        "inactive_balance_eur": _where(is_inactive(), F.col("balance_eur")),
    }


def _overdue_values() -> dict[str, Column]:
    return {
        "overdue_review_count": _where(is_overdue(), F.lit(1)),
        "overdue_review_value_eur": _where(is_overdue(), F.col("net_realizable_value_eur")),
    }


def inactive_sums() -> list[Column]:
    return _sums(_inactive_values())


def overdue_sums() -> list[Column]:
    return _sums(_overdue_values())


def funding_measures() -> Measures:
    eur = F.col("balance_eur")
    return Measures(
        ["maturity_bucket", "customer_segment", "account_type"], "account_id", "account_count",
        {
            "total_balance_eur": eur,
            "stable_funding_balance_eur": _where(_is("stable_funding_flag", "Y"), eur),
            "unstable_funding_balance_eur": _where(_is("stable_funding_flag", "N"), eur),
            "weighted_outflow_amount": eur * F.col("weighted_outflow_rate"),
            "high_volatility_balance_eur": _where(_is("balance_volatility", "High"), eur),
            "medium_volatility_balance_eur": _where(_is("balance_volatility", "Medium"), eur),
            "low_volatility_balance_eur": _where(_is("balance_volatility", "Low"), eur),
            **_inactive_values(),
        },
        {"average_balance_eur": eur, "average_outflow_rate": F.col("weighted_outflow_rate")},
    )


def funding_aggregated(balances: DataFrame) -> DataFrame:
    return aggregated(balances, funding_measures())


def collateral_measures() -> Measures:
    net = F.col("net_realizable_value_eur")
    return Measures(
        ["collateral_type", "quality_rating", "collateral_status"], "collateral_id", "collateral_count",
        {
            "total_gross_value_eur": F.col("gross_value_eur"),
            "total_net_value_eur": net,
            "high_concentration_value_eur": _where(_is("concentration_risk_flag", "Y"), net),
            "insured_value_eur": _where(_is("insurance_status", "Y"), net),
            "uninsured_value_eur": _where(_is("insurance_status", "N"), net),
            "active_collateral_value_eur": _where(_is("collateral_status", "Active"), net),
            "under_review_value_eur": _where(_is("collateral_status", "Under Review"), net),
            **_overdue_values(),
        },
        {
            "average_haircut_percentage": F.col("haircut_percentage"),
            "average_ltv_ratio": F.col("loan_to_value_ratio"),
            "average_liquidation_days": F.col("liquidation_period_days"),
            "quality_score": quality_score(F.col("quality_rating")),
        },
    )


def collateral_aggregated(collateral: DataFrame) -> DataFrame:
    return aggregated(collateral, collateral_measures())


def with_concentration(df: DataFrame, value: str, totals: DataFrame, total: str) -> DataFrame:
    """Add each row's percentage of the total of its day, country and subsidiary, which `totals`
    (the liquidity metrics, or one of their parts) holds in column `total`.

    `df` is read once; rows without a total, or with a NULL country or subsidiary, drop out.
    More columns of `totals` come along."""
    return (
        df.join(totals.withColumnRenamed(total, "_total"), GRAIN)
        .withColumn("concentration_percentage", share_percent(F.col(value), F.col("_total")))
        .drop("_total")
    )


def _shares(df: DataFrame, value: str, metrics: DataFrame, total: str) -> DataFrame:
    return with_concentration(df, value, metrics.select(*GRAIN, total), total)


def hqla_concentration(hqla: DataFrame, metrics: DataFrame) -> DataFrame:
    return _shares(hqla_aggregated(hqla), "total_eligible_value_eur", metrics, "total_hqla_eligible_eur")


def funding_concentration(balances: DataFrame, metrics: DataFrame) -> DataFrame:
    return _shares(funding_aggregated(balances), "total_balance_eur", metrics, "total_balance_eur")


def collateral_concentration(collateral: DataFrame, metrics: DataFrame) -> DataFrame:
    return _shares(
        collateral_aggregated(collateral), "total_net_value_eur", metrics, "total_collateral_net_eur"
    )


def with_stable_funding_ratio(funding: DataFrame) -> DataFrame:
    return funding.withColumn(
        "stable_funding_ratio",
        share(F.col("stable_funding_balance_eur"), F.col("total_balance_eur")),
    )


class Position(NamedTuple):
    """A position fact: its key, what it measures, and the value whose share of the total it shows."""

    dataset: str
    key: str
    measures: Callable[[], Measures]
    value: str
    total: str


POSITIONS = {
    "fact_hqla_position": Position(
        "hqla", "hqla_position_key", hqla_measures, "total_eligible_value_eur", "total_hqla_eligible_eur"),
    "fact_funding_stability": Position(
        "balances", "funding_stability_key", funding_measures, "total_balance_eur", "total_balance_eur"),
    "fact_collateral_risk": Position(
        "collateral", "collateral_risk_key", collateral_measures, "total_net_value_eur", "total_collateral_net_eur"),
}


def position_fact(name: str, sums: DataFrame, metrics: DataFrame, dims: Dims,
                  load_time: Column | None = None) -> DataFrame:
    """Position fact `name` from its aggregated rows and the liquidity metrics over the same positions.

    The dimensions are joined to the short metrics; the aggregated rows join keys and totals
    at once, and are then stored in key order and numbered."""
    position = POSITIONS[name]
    places = dim_lookup(metrics.select(*GRAIN, F.col(position.total).alias("_whole")), dims)
    shares = with_concentration(sums, position.value, places, "_whole")
    if name == "fact_funding_stability":
        shares = with_stable_funding_ratio(shares)
    placed = place_rows(shares, [*GRAIN, *position.measures().by], position.key)
    numbered = number_rows(placed, placed, position.key, LONG)
    return conform(with_load_timestamp(numbered, load_time), GOLD[name])


def fact_hqla_position(hqla: DataFrame, metrics: DataFrame, dims: Dims,
                       load_time: Column | None = None) -> DataFrame:
    return position_fact("fact_hqla_position", hqla_aggregated(hqla), metrics, dims, load_time)


def fact_funding_stability(balances: DataFrame, metrics: DataFrame, dims: Dims,
                           load_time: Column | None = None) -> DataFrame:
    return position_fact("fact_funding_stability", funding_aggregated(balances), metrics, dims, load_time)


def fact_collateral_risk(collateral: DataFrame, metrics: DataFrame, dims: Dims,
                         load_time: Column | None = None) -> DataFrame:
    return position_fact("fact_collateral_risk", collateral_aggregated(collateral), metrics, dims, load_time)
