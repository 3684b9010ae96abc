"""Key and rule checks as reports; an intact star schema gives only zeros."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.rules import haircut_fits_level, yes_no
from ebbtide.schemas import FACTS, PRIMARY_KEYS

DIMENSION_OF = {
    "date_key": "dim_date", "country_key": "dim_country", "subsidiary_key": "dim_subsidiary",
}


def key_violations(df: DataFrame, table: str, key: str) -> DataFrame:
    """One row: how many rows lack the key and how many share a key with another row."""
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
    rows = F.col("_rows")
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), rows)), F.lit(0)).alias("null_key_rows"),
        F.coalesce(
            F.sum(F.when(F.col("_key").isNotNull() & (rows > 1), rows)), F.lit(0)
        ).alias("duplicate_key_rows"),
    ).select(
        F.lit(table).alias("table_name"), F.lit(key).alias("key_column"),
        "null_key_rows", "duplicate_key_rows",
    )


def pk_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Primary key check of every gold table given."""
    return reduce(
        DataFrame.unionAll,
        [key_violations(tables[t], t, k) for t, k in PRIMARY_KEYS.items() if t in tables],
    )


def fact_orphans(fact: DataFrame, table: str, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of one fact without a row in each dimension.

    The fact is scanned once and counted per key combination before the joins."""
    counts = fact.groupBy(*DIMENSION_OF).agg(F.count("*").alias("_rows"))
    for key, dim in DIMENSION_OF.items():
        known = dims[dim].select(key).distinct().withColumn(f"_has_{key}", F.lit(True))
        counts = counts.join(known, key, "left")
    missing = counts.agg(*[
        F.coalesce(F.sum(F.when(F.col(f"_has_{key}").isNull(), F.col("_rows"))), F.lit(0)).alias(key)
        for key in DIMENSION_OF
    ])
    return missing.unpivot([], list(DIMENSION_OF), "key_column", "orphan_rows").select(
        F.lit(table).alias("fact_table"), "key_column", "orphan_rows"
    )


def fk_orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Foreign key check of every gold fact given."""
    return reduce(
        DataFrame.unionAll, [fact_orphans(tables[t], t, tables) for t in FACTS if t in tables]
    )


def haircut_by_level_check(hqla: DataFrame) -> DataFrame:
    """Rows per level and haircut, and whether the haircut is the level's own."""
    level = F.trim("hqla_level")
    return (
        hqla.groupBy(level.alias("hqla_level"), "haircut_rate")
        .agg(F.count("*").alias("record_count"))
        .withColumn(
            "fits_level", yes_no(haircut_fits_level(F.col("hqla_level"), F.col("haircut_rate")))
        )
    )
