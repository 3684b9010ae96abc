"""Bronze: delivered text in its declared types, with lineage."""

from pyspark.sql import Column, DataFrame

from ebbtide.operators.conform import conform
from ebbtide.schemas import BRONZE
from ebbtide.sources.landing import with_load_timestamp


def to_bronze(raw: DataFrame, dataset: str, load_time: Column | None = None,
              permissive: bool = False) -> DataFrame:
    """`raw` holds the delivered columns as text plus `source_file`."""
    return conform(with_load_timestamp(raw, load_time), BRONZE[dataset], permissive)


def bronze_balances(raw: DataFrame, load_time: Column | None = None,
                    permissive: bool = False) -> DataFrame:
    return to_bronze(raw, "balances", load_time, permissive)


def bronze_hqla(raw: DataFrame, load_time: Column | None = None,
                permissive: bool = False) -> DataFrame:
    return to_bronze(raw, "hqla", load_time, permissive)


def bronze_collateral(raw: DataFrame, load_time: Column | None = None,
                      permissive: bool = False) -> DataFrame:
    return to_bronze(raw, "collateral", load_time, permissive)
