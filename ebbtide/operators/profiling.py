"""Row counts and quality summaries of the layers.

Tables are first counted per date and country (or per combination of flags), which
Spark does on the map side; distinct counts then run on that short list
instead of expanding every row once per distinct count."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.silver import KEYS
from ebbtide.schemas import GOLD

AMOUNTS = {
    "balances": "balance_eur",
    "hqla": "eligible_hqla_value_eur",
    "collateral": "net_realizable_value_eur",
}
FLAG_CHECKS = {
    "balances": ["stable_funding_flag"],
    "hqla": ["hqla_level", "encumbered_flag", "central_bank_eligible"],
    "collateral": ["quality_rating", "insurance_status", "concentration_risk_flag"],
}
FACT_TOTALS = {
    "fact_intraday_liquidity": "total_hqla_eligible_eur",
    "fact_hqla_position": "total_eligible_value_eur",
    "fact_funding_stability": "total_balance_eur",
    "fact_collateral_risk": "total_net_value_eur",
}


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionAll, list(frames))


def _by_day_and_country(df: DataFrame, *extra: Column) -> DataFrame:
    return df.groupBy("business_date", "country").agg(F.count("*").alias("_rows"), *extra)


def _coverage() -> list[Column]:
    return [
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("record_count"),
        F.countDistinct("business_date").alias("distinct_dates"),
        F.min("business_date").alias("earliest_date"),
        F.max("business_date").alias("latest_date"),
        F.countDistinct("country").alias("distinct_countries"),
    ]


def bronze_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per bronze table: rows, dates, countries and total amount."""
    return _union(
        _by_day_and_country(df, F.sum(AMOUNTS[name]).alias("_total"))
        .agg(*_coverage(), F.sum("_total").cast("decimal(28,2)").alias("total_balance_eur"))
        .select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ).orderBy("table_name")


def bronze_record_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return _union(
        df.agg(F.count("*").alias("records")).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    )


def silver_record_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and distinct dates per table."""
    return _union(
        df.groupBy("business_date").agg(F.count("*").alias("_rows"))
        .agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("record_count"),
            F.count("business_date").alias("distinct_dates"),
        )
        .select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    )


def silver_vs_bronze_summary(bronze: Mapping[str, DataFrame],
                             silver: Mapping[str, DataFrame]) -> DataFrame:
    """Per table and layer: coverage and rows without a key, both measured."""
    return _union(
        _by_day_and_country(df, F.count_if(F.col(KEYS[name]).isNull()).alias("_no_key"))
        .agg(
            *_coverage(),
            F.coalesce(F.sum("_no_key"), F.lit(0)).alias("null_account_ids"),
        )
        .select(F.lit(name).alias("table_name"), F.lit(layer).alias("layer"), "*")
        for layer, tables in (("bronze", bronze), ("silver", silver))
        for name, df in tables.items()
    ).orderBy("table_name", "layer")


def silver_flag_distribution(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per value of every flag and category column; each table is scanned once."""
    checks = []
    for name, df in tables.items():
        columns = FLAG_CHECKS[name]
        label = F.concat(F.lit(f"{name}_cleaned - "), F.col("_column"))
        checks.append(
            df.groupBy(*columns).agg(F.count("*").alias("_rows"))
            .unpivot("_rows", columns, "_column", "flag_value")
            .groupBy(label.alias("validation_check"), "flag_value")
            .agg(F.sum("_rows").alias("record_count"))
        )
    return _union(checks).orderBy("validation_check", "flag_value")


def _gold_row(df: DataFrame, name: str, first: Column, last: Column, total: Column,
              rows: Column) -> DataFrame:
    kind = "fact" if name in FACT_TOTALS else "dimension"
    return df.agg(
        F.coalesce(rows, F.lit(0)).alias("record_count"),
        first.alias("min_date"),
        last.alias("max_date"),
        total.cast("decimal(28,2)").alias("total_value_eur"),
    ).select(F.lit(name).alias("table_name"), F.lit(kind).alias("table_type"), "*")


def gold_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per gold table: rows, date range and total.  Facts are summed per date key
    before they meet the date dimension."""
    dates = tables["dim_date"].select("date_key", "business_date")
    no_date, no_total = F.max(F.lit(None).cast("date")), F.max(F.lit(None).cast("decimal(28,2)"))
    span = F.min("business_date"), F.max("business_date")
    rows = []
    for name in GOLD:
        if name not in tables:
            continue
        if name in FACT_TOTALS:
            daily = tables[name].groupBy("date_key").agg(
                F.count("*").alias("_rows"), F.sum(FACT_TOTALS[name]).alias("_total")
            )
            rows.append(
                _gold_row(daily.join(dates, "date_key"), name, *span, F.sum("_total"), F.sum("_rows"))
            )
        elif name == "dim_date":
            rows.append(_gold_row(tables[name], name, *span, no_total, F.count("*")))
        else:
            rows.append(_gold_row(tables[name], name, no_date, no_date, no_total, F.count("*")))
    return _union(rows).orderBy("table_type", "table_name")


def gold_summary_short(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and date range of the liquidity fact and the date dimension."""
    short = {name: tables[name] for name in ("dim_date", "fact_intraday_liquidity")}
    return gold_summary(short).select("table_name", "record_count", "min_date", "max_date")
