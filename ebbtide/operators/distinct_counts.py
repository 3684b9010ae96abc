"""Exact distinct counts that merge: bitmaps of registered numbers, stored per day and group.

A member's number comes from a `KeyRegistry`, so it is dense and never changes.  A bitmap covers 32,768 numbers in 4 KB;
a group has one for each such bucket that it touches.  Counts over any days or coarser groups unite bitmaps and
never read the rows again.  Spark unites them on the map side, so what crosses the exchange is a bitmap per group,
bucket and task, however many rows there are.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.keys import KeyRegistry


def member_bitmaps(rows: DataFrame, registry: KeyRegistry, by: Sequence[str]) -> DataFrame:
    """(*by, bucket, members): the members of `registry` that stand in each group of `rows`.

    Rows with a NULL in a member column do not count; one that the registry does not know fails the query."""
    held = rows.dropna(subset=registry.columns).select(*by, *registry.columns).distinct()
    keyed = registry.keyed(held)
    number = F.coalesce(F.col(registry.key), F.raise_error(F.lit("a member without a key: extend the registry first")).cast("long"))
    places = keyed.select(*by, number.cast("long").alias("_number"))
    return places.groupBy(*by, F.bitmap_bucket_number("_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("members")
    )


def count_members(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Exact number of different members per group of `by`, any columns that `bitmaps` has or derives from its own."""
    united = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("members").alias("members"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("members")).alias(name))
