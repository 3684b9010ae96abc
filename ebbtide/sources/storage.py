"""Stored tables, and the shared folder for intermediate results."""

import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.conform import conform

# The folder of the table that is being built in this thread.
_work: ContextVar[str | None] = ContextVar("work", default=None)

# Small files: delta pages of sorted values, and a codec that finds more than the default one.
_PARQUET = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
_NO_MARKER = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}

# Rows that one write shuffles at once, for each core: what moves lies on the executors' disks until the write ends.
ROWS_A_CORE = 2_000_000
# Input beyond which tables are written one after the other, for each core.
BYTES_A_CORE = 64 << 20

# While tables are written: what a query shuffles goes from the executors' disks with its end, instead of when the driver happens to
# collect its garbage; methods that the JVM would not compile, being too long, are not generated in one piece.
_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
_lock = threading.Lock()
_writes: dict[str, list] = {}  # per application, how many run and the settings before


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """Path for one new result below the shared folder, or below the work folder in use."""
    return f"{_work.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[None]:
    """Intermediate results of this block go into a folder of their own, which goes with its end,
    also after a failure.  What is built in the block must be stored in it."""
    folder = fresh_folder(spark, "work")
    before = _work.set(folder)
    try:
        yield
    finally:
        _work.reset(before)
        files, path = _files(spark, folder)
        files.delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _files(spark, path)
    return files.exists(folder)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to `path` and the write ended."""
    files, marker = _files(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


_MARK = "_FINGERPRINT"  # readers skip names that begin so


def write_mark(spark: SparkSession, path: str, mark: str) -> None:
    """Note beside the rows of the table at `path` what they were made of.  Whatever replaces rows removes the mark first."""
    files, target = _files(spark, f"{path}/{_MARK}")
    stream = files.create(target, True)
    try:
        stream.write(bytearray(mark.encode()))
    finally:
        stream.close()


def read_mark(spark: SparkSession, path: str) -> str | None:
    files, target = _files(spark, f"{path}/{_MARK}")
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


@contextmanager
def write_settings(spark: SparkSession) -> Iterator[None]:
    """`_SETTINGS` for the writes of this block, which may overlap those of other threads."""
    with _lock:
        running = _writes.setdefault(spark.sparkContext.applicationId, [0, {}])
        if not running[0]:
            running[1] = {key: spark.conf.get(key, None) for key in _SETTINGS}
            for key, value in _SETTINGS.items():
                spark.conf.set(key, value)
        running[0] += 1
    try:
        yield
    finally:
        with _lock:
            running[0] -= 1
            for key, value in running[1].items() if not running[0] else ():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored_bytes(spark: SparkSession, path: str) -> int:
    files, folder = _files(spark, path)
    return files.getContentSummary(folder).getLength()


def _plain(uri: str) -> str:
    """The path of an input file as a reader takes it: unescaped, without patterns."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in unquote(uri))


def input_files(df: DataFrame) -> DataFrame | None:
    """The files behind `df` as Spark lists them (path, length, modificationTime); None without any."""
    paths = [_plain(p) for p in df.inputFiles()]
    return df.sparkSession.read.format("binaryFile").load(paths) if paths else None


def input_bytes(df: DataFrame) -> int:
    found = input_files(df)
    return 0 if found is None else found.agg(F.sum("length")).first()[0] or 0


def is_large(spark: SparkSession, size: int) -> bool:
    """Whether tables made of `size` bytes fill the cores one by one; what several shuffle at once would only take disk."""
    return size > BYTES_A_CORE * spark.sparkContext.defaultParallelism


def day_groups(rows: DataFrame, day: str = "business_date", most: int | None = None) -> list[Column]:
    """Conditions that deal all of `rows` out by ranges of days, of about `most` rows each; a day is never split, and no day (NULL)
    comes first.  The days go through the driver: a calendar."""
    spark = rows.sparkSession
    most = most or ROWS_A_CORE * spark.sparkContext.defaultParallelism
    with write_settings(spark):
        counts = rows.groupBy(day).agg(F.count("*").alias("_rows")).orderBy(F.col(day).asc_nulls_first()).collect()
    groups, held = [], 0
    for value, number in counts:
        if not groups or held + number > most:
            groups.append([])
            held = 0
        groups[-1].append(value)
        held += number
    conditions = []
    for days in groups:
        known = [d for d in days if d is not None]
        within = F.col(day).between(known[0], known[-1]) if known else F.lit(False)
        conditions.append(within | F.col(day).isNull() if None in days else within)
    return conditions


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage, and the
    rows survive the loss of executors."""
    return write_table(df, fresh_folder(df.sparkSession, label))


def write_parts(writers: Sequence[DataFrameWriter], path: str, format: str = "parquet") -> None:
    """Replace what lies at `path` by the rows of all `writers`, one write after the other, each of which leaves no shuffled
    rows behind.  The marker of a whole table comes with the last one."""
    for number, writer in enumerate(writers):
        last = number == len(writers) - 1
        writer = writer.options(**({} if last else _NO_MARKER)).mode("append" if number else "overwrite")
        writer.format(format).save(path)


def _writer(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str] = ()) -> DataFrameWriter:
    order = [*partition_by, *[c for c in order_by if c not in partition_by]]
    if partition_by:
        cut = [F.col(c) for c in order]
        df = df.repartitionByRange(*cut) if order_by else df.hint("rebalance", *cut)
    if order_by:
        df = df.sortWithinPartitions(*order)
    return df.write.options(**_PARQUET).partitionBy(*partition_by)


def write_table(df: DataFrame | Sequence[DataFrame], path: str, partition_by: Sequence[str] = (),
                order_by: Sequence[str] = ()) -> DataFrame:
    """Replace the parquet table at `path` with `df` and return it as stored.

    Partitioned tables are rebalanced first: small partitions share a task
    and hot ones are split over several, by ranges of `order_by` if given.  Files are sorted by it, which makes them
    small and lets scans of some values skip pages.  A table too large to shuffle at once comes in several frames,
    of other partitions each."""
    parts = [df] if isinstance(df, DataFrame) else list(df)
    spark, schema = parts[0].sparkSession, parts[0].schema
    with write_settings(spark):
        write_parts([_writer(part, partition_by, order_by) for part in parts], path)
    return read_table(spark, path, schema)


def overwrite_days(df: DataFrame, path: str, days: DataFrame, day: str = "business_date") -> DataFrame:
    """Replace the days in `days` (column `day`) of the table at `path`, which is partitioned by `day`, with the rows of `df`, and
    return the table.

    Files of other days are not touched; rows of `df` on other days fail the write.  A day without rows in `df` is removed.
    The set of days goes through the driver: a calendar, however many rows there are."""
    spark = df.sparkSession
    touched = {row[0] for row in days.select(day).distinct().collect()}
    if not touched:
        return read_table(spark, path, df.schema)
    known = F.coalesce(F.col(day).isin([d for d in touched if d is not None]), F.lit(False))
    known = known | F.col(day).isNull() if None in touched else known
    kept = df.withColumn(day, F.when(known, F.col(day)).otherwise(F.raise_error(F.concat(
        F.lit("a row on a day that is not replaced: "), F.coalesce(F.col(day).cast("string"), F.lit("NULL"))
    )).cast(df.schema[day].dataType)))
    new = materialise(kept, "days")  # read whole before any day is replaced, perhaps from the table itself
    files, mark = _files(spark, f"{path}/{_MARK}")
    files.delete(mark, False)
    filled = {row[0] for row in new.select(day).distinct().collect()}
    with write_settings(spark):
        _writer(new, [day]).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for value in touched - filled:
        files, folder = _files(spark, f"{path}/{day}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
        files.delete(folder, True)
    return read_table(spark, path, df.schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored table in its declared column order (partition columns come last on disk)."""
    return spark.read.schema(schema).parquet(path).select(schema.names)


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create or replace catalog table `name`, at `path` if given; column comments go
    with it."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    """Enter the table stored at `path` in the catalog, with its column comments; nothing is copied."""
    spark.catalog.createTable(name, path, "parquet", schema)


def overwrite_table(df: DataFrame, name: str) -> DataFrame:
    """Replace the rows of the existing catalog table `name`, keeping its definition.

    Columns are matched by name and cast to the table's types; a missing one fails the
    write, others are left out."""
    existing = df.sparkSession.table(name)
    conform(df, existing.schema).write.insertInto(name, overwrite=True)
    return df.sparkSession.table(name)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Columns, types, comments and storage details of catalog table `name`."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
