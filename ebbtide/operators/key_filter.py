"""Key checks of a new load alone, against a stored filter of the keys that are there.

The filter is a Bloom filter in blocks: a key's hash names one block of 32,768 bits, and `BITS` places in it.  Blocks are
bitmaps that Spark builds on the map side and unites, a generation per load.  New keys that the filter does not hold are new
for certain; only the others go to the exact join, and if there are none the stored table is not read at all.

A foreign key check needs no filter: orphans of a load are those of its own rows (`integrity.fact_orphans`)."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.schemas import LONG
from ebbtide.sources.storage import is_complete, materialise

BLOCK_BITS = 32_768  # of Spark's bitmap functions
BITS = 4
BLOCKS = 2_048
BROADCAST_BYTES = 64 << 20


class KeyFilter:
    """The keys of a table's loads, in a folder of its own; one writer at a time.

    `blocks` is fixed for a folder.  2,048 blocks are 8 MB and let about one new key in 25 through at ten million keys; a filter that
    is too full sends more keys to the exact join, which costs time and no result.  It is broadcast up to 64 MB, beyond that joined by size."""

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: T.DataType = LONG, blocks: int = BLOCKS):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.key_type, self.blocks = key, key_type, blocks

    def _block(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast(self.key_type)), F.lit(self.blocks)).cast("int")

    def _place(self, number: int) -> Column:
        hashed = F.xxhash64(F.lit(number), F.col(self.key).cast(self.key_type))
        return F.pmod(hashed, F.lit(BLOCK_BITS)).cast("int")

    def _folders(self) -> list[str]:
        found = []
        while is_complete(self.spark, f"{self.path}/generation-{len(found):06d}"):
            found.append(f"{self.path}/generation-{len(found):06d}")
        return found

    def add(self, rows: DataFrame) -> None:
        """Hold the keys of `rows` too.  A generation counts once its write has ended; keys added twice do no harm."""
        places = rows.where(F.col(self.key).isNotNull()).select(
            self._block().alias("block"), F.explode(F.array(*[self._place(n) for n in range(BITS)])).alias("place")
        )
        bitmaps = places.groupBy("block").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))
        bitmaps.write.mode("overwrite").parquet(f"{self.path}/generation-{len(self._folders()):06d}")

    def table(self) -> DataFrame:
        """(block, bits): at most `blocks` rows of 4 KB."""
        schema, folders = "block int, bits binary", self._folders()
        if not folders:
            return self.spark.createDataFrame([], schema)
        held = self.spark.read.schema(schema).parquet(*folders)
        return held.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))

    def possible(self, rows: DataFrame) -> DataFrame:
        """The rows whose key may be held: all that are, and a few others.  NULL is not held."""
        held = self.table().withColumnsRenamed({"block": "_block", "bits": "_bits"})
        if self.blocks * BLOCK_BITS // 8 <= BROADCAST_BYTES:
            held = F.broadcast(held)  # bounded by the parameter

        def is_set(number: int) -> Column:
            place = self._place(number)
            byte = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
            return (F.call_function("shiftright", byte, place.bitwiseAND(7)).bitwiseAND(1)) == 1

        met = rows.where(F.col(self.key).isNotNull()).join(held, self._block() == F.col("_block"))
        return met.where(reduce(Column.__and__, [is_set(n) for n in range(BITS)])).select(rows.columns)


def added_violations(new: DataFrame, stored: DataFrame, held: KeyFilter, table: str) -> DataFrame:
    """What the rows of `new` add to the key violations of `stored`, whose keys `held` holds: one row as from
    `integrity.key_violations`.  The two reports together are the report of all rows.

    `new` is read once and counted by key; the stored key column is read only if a new key may be there."""
    key = held.key
    counts = materialise(new.groupBy(F.col(key).cast(held.key_type).alias(key)).agg(F.count("*").alias("_new")), "new-keys")
    hits = materialise(held.possible(counts).select(key), "possible-keys")
    found = F.lit(0).cast("long").alias("_old")
    if not hits.isEmpty():
        there = stored.select(F.col(key).cast(held.key_type).alias(key)).join(hits, key, "left_semi")
        counts = counts.join(there.groupBy(key).agg(F.count("*").alias("_held")), key, "left")
        found = F.coalesce("_held", F.lit(0)).alias("_old")
    known = counts.select(key, "_new", found)
    rows, old = F.col("_new") + F.col("_old"), F.col("_old")
    # rows that share a key now, without those that shared one before
    shared = F.when(rows > 1, rows).otherwise(0) - F.when(old > 1, old).otherwise(0)
    return known.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_new"))), F.lit(0)).alias("null_key_rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull(), shared)), F.lit(0)).alias("duplicate_key_rows"),
    ).select(F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "null_key_rows", "duplicate_key_rows")
