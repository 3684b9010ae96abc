"""Landing zone: CSV snapshots with a header, one sub-folder per day."""

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.schemas import LANDING, TEXT
from ebbtide.sources.storage import day_groups, write_parts, write_settings

# Text must come back as it went out, blanks at either end included.
_LINE = "_line"
_FORMAT = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_FILES = "{*.csv,*.csv.gz}"


def with_source_file(scan: DataFrame) -> DataFrame:
    """Add the path of the file each row came from.  Needs a frame straight off a reader."""
    return scan.withColumn("source_file", F.col("_metadata.file_path"))


def with_load_timestamp(df: DataFrame, load_time: Column | None = None,
                        name: str = "load_timestamp") -> DataFrame:
    """Add the load time; without one given, the start time of the query."""
    return df.withColumn(name, F.current_timestamp() if load_time is None else load_time)


def _read(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    # Without column pruning every line is parsed whole, also by counts and reads of few columns.
    reader = spark.read.schema(schema).options(**_FORMAT, enforceSchema=False, columnPruning=False, **options)
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", _FILES).csv(path)


def _whole(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """All lines, with the text of those that do not have the declared columns in `_line`."""
    schema = T.StructType([*LANDING[dataset], T.StructField(_LINE, TEXT)])
    return _read(spark, path, schema, mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE)


def _is_bad(dataset: str) -> Column:
    # Spark refuses queries on the line alone, so another column takes part without deciding anything.
    first = F.col(LANDING[dataset].names[0])
    return F.col(_LINE).isNotNull() & (F.length(F.coalesce(first, F.lit(""))) >= 0)


def scan_landing(spark: SparkSession, path: str, dataset: str, permissive: bool = False) -> DataFrame:
    """All rows of every CSV file below `path`, as text, with their source file.

    The columns are declared, so nothing is inferred.  A header that does not match them
    fails the read instead of shifting columns, and so does a line with too few or too many
    fields, unless `permissive`: such lines are then left to `landing_rejects`."""
    if not permissive:
        return with_source_file(_read(spark, path, LANDING[dataset], mode="FAILFAST"))
    rows = with_source_file(_whole(spark, path, dataset))
    return rows.filter(~_is_bad(dataset)).drop(_LINE)


def stream_landing(spark: SparkSession, path: str, dataset: str, files_a_batch: int | None = None) -> DataFrame:
    """The rows of `scan_landing` as a stream over the files that appear below `path`."""
    reader = spark.readStream.schema(LANDING[dataset]).options(**_FORMAT, enforceSchema=False, columnPruning=False, mode="FAILFAST")
    reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", _FILES)
    if files_a_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return with_source_file(reader.csv(path))


def landing_rejects(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """(source_file, line) of the lines that a permissive scan leaves out."""
    rows = with_source_file(_whole(spark, path, dataset))
    return rows.filter(_is_bad(dataset)).select("source_file", F.col(_LINE).alias("line"))


def scan_landing_balances(spark: SparkSession, path: str) -> DataFrame:
    return scan_landing(spark, path, "balances")


def scan_landing_hqla(spark: SparkSession, path: str) -> DataFrame:
    return scan_landing(spark, path, "hqla")


def scan_landing_collateral(spark: SparkSession, path: str) -> DataFrame:
    return scan_landing(spark, path, "collateral")


def write_landing_csv(df: DataFrame, base: str, dataset: str, day: str,
                      single_file: bool = False) -> str:
    """Export one day's snapshot to `base/day/dataset_day.csv`, replacing it.

    One file means one task writes everything, so it is only an option."""
    path = f"{base.rstrip('/')}/{day}/{dataset}_{day}.csv"
    columns = LANDING[dataset].names
    out = df.select(columns).coalesce(1) if single_file else df.select(columns)
    out.write.mode("overwrite").options(**_FORMAT).csv(path)
    return path


def write_landing_history(df: DataFrame, base: str, dataset: str, compression: str | None = "gzip") -> str:
    """Export many days, a folder per business date; text takes a quarter of its size on disk unless `compression` is None.

    The rebalance packs small days together and splits hot ones.  Many rows are written in ranges of days, so what is
    moved at once does not grow with the history; `df` is read once for each and once for its days."""
    path = f"{base.rstrip('/')}/{dataset}"
    options = _FORMAT | ({"compression": compression} if compression else {})

    def writer(rows: DataFrame) -> DataFrameWriter:
        out = rows.select(*LANDING[dataset].names, F.col("business_date").alias("snapshot"))
        return out.hint("rebalance", F.col("snapshot")).write.options(**options).partitionBy("snapshot")

    groups = day_groups(df)
    with write_settings(df.sparkSession):
        write_parts([writer(df.where(days)) for days in groups] if len(groups) > 1 else [writer(df)], path, "csv")
    return path
