"""Silver: validated, trimmed and deduplicated rows.

Rows are filtered before they are deduplicated, so a newer invalid row never
hides an older valid one.  A blank key is not NULL and stays."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.rules import HQLA_LEVELS, QUALITY_RATINGS
from ebbtide.operators.conform import conform
from ebbtide.schemas import SILVER
from ebbtide.sources.landing import with_load_timestamp

FLAGS = {
    "balances": ("stable_funding_flag",),
    "hqla": ("encumbered_flag", "central_bank_eligible"),
    "collateral": ("quality_rating", "insurance_status", "concentration_risk_flag"),
}
KEYS = {"balances": "account_id", "hqla": "asset_id", "collateral": "collateral_id"}
NEWEST_FIRST = ("load_timestamp", "created_timestamp", "source_file")


def filter_required(df: DataFrame, key: str, amount: str, min_inclusive: bool = True) -> DataFrame:
    """Rows with key, date and a non-negative (or positive) amount."""
    enough = F.col(amount) >= 0 if min_inclusive else F.col(amount) > 0
    return df.filter(F.col(key).isNotNull() & F.col("business_date").isNotNull() & enough)


def filter_required_balances(df: DataFrame, min_inclusive: bool = True) -> DataFrame:
    return filter_required(df, "account_id", "balance_eur", min_inclusive)


def filter_valid_hqla(df: DataFrame, min_inclusive: bool = True) -> DataFrame:
    """Required columns, a known level and a haircut within [0, 1]."""
    return filter_required(df, "asset_id", "market_value_eur", min_inclusive).filter(
        F.trim("hqla_level").isin(HQLA_LEVELS) & F.col("haircut_rate").between(0, 1)
    )


def filter_valid_collateral(df: DataFrame, min_inclusive: bool = True) -> DataFrame:
    """Required columns, a known rating, haircut and loan-to-value within [0, 1]."""
    return filter_required(df, "collateral_id", "gross_value_eur", min_inclusive).filter(
        F.upper(F.trim("quality_rating")).isin(QUALITY_RATINGS)
        & F.col("haircut_percentage").between(0, 1)
        & F.col("loan_to_value_ratio").between(0, 1)
    )


def trim_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Strip spaces (not tabs) from text columns, by default all but the lineage."""
    if columns is None:
        columns = [
            f.name for f in df.schema
            if isinstance(f.dataType, T.StringType) and f.name != "source_file"
        ]
    return df.withColumns({c: F.trim(c) for c in columns})


def normalise_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strip spaces and upper-case."""
    return df.withColumns({c: F.upper(F.trim(c)) for c in columns})


def dedup_latest(df: DataFrame, keys: Sequence[str],
                 newest_first: Sequence[str] = NEWEST_FIRST) -> DataFrame:
    """Newest row per key.

    Load times are equal within a load, so the remaining columns break ties and
    the survivor does not depend on partitioning.  Spark keeps one row per key on
    each map task before the shuffle, so many copies of one key do not pile up."""
    rest = [c for c in df.columns if c not in keys and c not in newest_first]
    newest = Window.partitionBy(*keys).orderBy(
        [F.col(c).desc_nulls_last() for c in (*newest_first, *rest)]
    )
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def dedup_balances(df: DataFrame, newest_first: Sequence[str] = NEWEST_FIRST) -> DataFrame:
    return dedup_latest(trim_strings(df, ["account_id"]), ["business_date", "account_id"], newest_first)


def dedup_hqla(df: DataFrame, newest_first: Sequence[str] = NEWEST_FIRST) -> DataFrame:
    return dedup_latest(trim_strings(df, ["asset_id"]), ["business_date", "asset_id"], newest_first)


def dedup_collateral(df: DataFrame, newest_first: Sequence[str] = NEWEST_FIRST) -> DataFrame:
    return dedup_latest(
        trim_strings(df, ["collateral_id"]), ["business_date", "collateral_id"], newest_first
    )


def _clean(valid: DataFrame, dataset: str, load_time: Column | None,
           newest_first: Sequence[str]) -> DataFrame:
    clean = normalise_flags(trim_strings(valid), FLAGS[dataset])
    latest = dedup_latest(clean, ["business_date", KEYS[dataset]], newest_first)
    return conform(
        with_load_timestamp(latest, load_time, "silver_load_timestamp"), SILVER[dataset]
    )


def silver_balances(bronze: DataFrame, load_time: Column | None = None,
                    min_inclusive: bool = True,
                    newest_first: Sequence[str] = NEWEST_FIRST) -> DataFrame:
    valid = filter_required_balances(bronze, min_inclusive)
    return _clean(valid, "balances", load_time, newest_first)


def silver_hqla(bronze: DataFrame, load_time: Column | None = None,
                min_inclusive: bool = True,
                newest_first: Sequence[str] = NEWEST_FIRST) -> DataFrame:
    return _clean(filter_valid_hqla(bronze, min_inclusive), "hqla", load_time, newest_first)


def silver_collateral(bronze: DataFrame, load_time: Column | None = None,
                      min_inclusive: bool = True,
                      newest_first: Sequence[str] = NEWEST_FIRST) -> DataFrame:
    valid = filter_valid_collateral(bronze, min_inclusive)
    return _clean(valid, "collateral", load_time, newest_first)


def silver_of_days(bronze: DataFrame, days: DataFrame, dataset: str, load_time: Column | None = None,
                   **options) -> DataFrame:
    """The silver rows of the days in `days` (column business_date) alone.

    A key is deduplicated within its day, so they are those of a full build.  A bronze table partitioned by day
    is read for these days only."""
    wanted = days.select("business_date").distinct()  # a calendar
    rows = bronze.join(F.broadcast(wanted), "business_date", "left_semi").select(bronze.columns)
    return {"balances": silver_balances, "hqla": silver_hqla, "collateral": silver_collateral}[dataset](rows, load_time, **options)
