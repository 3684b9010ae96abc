"""Dense surrogate keys without a one-task sort."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.sources.storage import is_complete, materialise

# monotonically_increasing_id: partition number above, row number within it below.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def place_rows(df: DataFrame, order_by: Sequence[str], label: str) -> DataFrame:
    """Store `df` in the order of `order_by` (NULL first), which must identify a row,
    with each row's partition and place therein as `_place`.

    Ranges are cut on the whole order, so no single value can load one task."""
    return materialise(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        label,
    )


def number_rows(df: DataFrame, placed: DataFrame, key: str, key_type: T.DataType) -> DataFrame:
    """Turn `_place` into a number from 1 without gaps: the place in the partition plus
    the rows of earlier partitions.  `df` holds the rows of `placed`, perhaps
    with more columns."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(F.shiftright("_place", _ROW_BITS).alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    number = F.col("_offset") + F.col("_place").bitwiseAND(_ROW_MASK) + 1
    return (
        df.withColumn("_part", F.shiftright("_place", _ROW_BITS))
        # one row per partition of the sort: bounded by the session's partition count
        .join(F.broadcast(offsets), "_part")
        .withColumn(key, number.cast(key_type))
        .drop("_part", "_place", "_offset")
    )


def dense_key(df: DataFrame, key: str, order_by: Sequence[str],
              key_type: T.DataType = T.LongType()) -> DataFrame:
    """Add `key`: 1, 2, 3 … in the order of `order_by`, without a one-task sort."""
    placed = place_rows(df, order_by, key)
    return number_rows(placed, placed, key, key_type)


def surrogate_key_dense(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """INT key of a dimension."""
    return dense_key(df, key, order_by, T.IntegerType())


def surrogate_key_fact(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """BIGINT key of a fact."""
    return dense_key(df, key, order_by, T.LongType())


class KeyRegistry:
    """Keys that outlive a rebuild: a member that once got a key keeps it.

    The registry is a folder of generations, each the members that one run added.  Members without a key are found by an
    anti-join and numbered after the largest key, distributed, in the order of their columns.  A generation counts once
    its write has ended, so a run that was cut off is repeated with the same keys.  One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, members: T.StructType, key: str, key_type: T.DataType = T.LongType()):
        self.spark, self.path = spark, path.rstrip("/")
        self.columns, self.key, self.key_type = members.names, key, key_type
        self.schema = T.StructType([*members.fields, T.StructField(key, key_type)])

    def _generation(self, number: int) -> str:
        return f"{self.path}/generation-{number:06d}"

    def _next(self) -> int:
        number = 0
        while is_complete(self.spark, self._generation(number)):
            number += 1
        return number

    def table(self) -> DataFrame:
        """All members with their keys."""
        folders = [self._generation(n) for n in range(self._next())]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def extend(self, rows: DataFrame) -> DataFrame:
        """Give every combination of the members' columns in `rows` a key, old ones their old one, and return the registry.
        NULL is a value like any other, in first place."""
        number, held = self._next(), self.table()
        found = held.select([F.col(c).alias(f"_{c}") for c in self.columns])
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.columns])
        fresh = rows.select([F.col(f.name).cast(f.dataType) for f in self.schema if f.name != self.key]).distinct()
        fresh = fresh.join(found, same, "left_anti")
        largest = held.agg(F.max(self.key)).first()[0] or 0
        numbered = dense_key(fresh, self.key, self.columns, T.LongType())
        added = numbered.select(*self.columns, (F.col(self.key) + largest).cast(self.key_type).alias(self.key))
        added.write.mode("overwrite").parquet(self._generation(number))
        return self.table()

    def keyed(self, rows: DataFrame) -> DataFrame:
        """`rows` with the key of their member; NULL where the registry has none."""
        held = self.table().select([F.col(c).alias(f"_{c}") for c in self.columns] + [F.col(self.key).alias("_key")])
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.columns])
        kept = [c for c in rows.columns if c != self.key]
        return rows.join(held, same, "left").select(*kept, F.col("_key").alias(self.key))
