"""Landing files as a stream: every file is loaded once, whatever happens between two runs.

The checkpoint of the stream is the ledger of the files.  A run takes the files that the ledger does not have, in batches whose
file lists are written down before they are read, and ends when there are no more.  The table's own log names
the files of every batch that was committed, so a batch that failed half-way leaves no rows behind and is taken again,
with the same files, by the next run."""

from pyspark.sql import Column, DataFrame, SparkSession

from ebbtide.operators.bronze import to_bronze
from ebbtide.schemas import BRONZE
from ebbtide.sources.landing import stream_landing
from ebbtide.sources.storage import read_table


def load_new_files(spark: SparkSession, zone: str, dataset: str, table: str, ledger: str, load_time: Column | None = None,
                   permissive: bool = False, files_a_batch: int | None = None) -> DataFrame:
    """Append the typed rows of the CSV files below `zone` that are not in `ledger` to the bronze table in folder `table`, and
    return the table.

    A line that does not fit the declared columns, or a value that does not fit its type unless `permissive`, fails the run; the
    files of that batch stay unloaded, and earlier batches keep theirs.  The load time is the batch's, unless given.
    `files_a_batch` bounds what is lost and repeated by a failure."""
    raw = stream_landing(spark, zone, dataset, files_a_batch)
    query = (
        to_bronze(raw, dataset, load_time, permissive)
        .writeStream.format("parquet").option("path", table).option("checkpointLocation", ledger)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return read_table(spark, table, BRONZE[dataset])
