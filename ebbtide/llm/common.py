"""Shared by the operators: input tables, stored intermediate results, components of a graph."""

import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def known_to_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.  On a cluster the
    package comes with the job (--py-files) and the added path, if absent, does nothing."""
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    known_to_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by `spark.checkpoint.dir`.  A local session
    without the setting gets a folder of its own; a cluster must have it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: cuts lineage and
    survives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_fields(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in fields)])


def slices(column: pa.Array, rows: int = 256) -> Iterator[list]:
    """The values of an Arrow column as Python objects, a few rows at a time."""
    for k in range(0, len(column), rows):
        yield column.slice(k, rows).to_pylist()


BITMAP_BITS = 24


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Bitmap of 2^BITMAP_BITS bits (2 MB, whatever the input) that holds the 64-bit hashes in `column`.  The tasks' parts
    are united as pieces of 32,768 bits before the driver gets them."""
    place = F.shiftright(column, 20).bitwiseAND((1 << BITMAP_BITS) - 1)
    pieces = (
        hashes.select(F.floor(place / 32768).alias("piece"), (place % 32768).alias("place"))
        .groupBy("piece").agg(F.bitmap_construct_agg("place").alias("bits"))
    )
    whole = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for piece, bits in pieces.collect():
        whole[piece * 4096 : (piece + 1) * 4096] = np.frombuffer(bits, np.uint8)
    return whole


def maybe_in(spark: SparkSession, held: np.ndarray, column: str) -> Column:
    """False only for hashes that are not in the bitmap; some others share a bit."""
    known_to_workers(spark)
    shared = spark.sparkContext.broadcast(held)

    @F.arrow_udf("boolean")
    def test(hashes: pa.Array) -> pa.Array:
        place = (hashes.to_numpy(zero_copy_only=False) >> 20) & ((1 << BITMAP_BITS) - 1)
        return pa.array((shared.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1)

    return test(F.col(column))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (a, b: long): the smallest node that can
    be reached.

    Alternating large-star and small-star rounds: every node's neighbours are relinked to
    its smallest neighbour, first the larger ones, then the smaller ones, until nothing
    changes.  Stars need a logarithmic number of rounds; each is one aggregation and one
    join on the links, and no neighbour list is gathered in a row."""
    ordered = F.col("a") != F.col("b")
    edges = store(
        links.where(ordered)
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    while True:
        # large star: v > u is linked to the smallest of u and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(ordered)
        # small star: u and its smaller neighbours are linked to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = store(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        # done when every larger end has one link and no smaller end is itself linked lower
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty():
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots)
