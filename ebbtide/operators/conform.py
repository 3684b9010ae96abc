"""Fit a frame to a declared schema."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType, permissive: bool = False) -> DataFrame:
    """Select by name, cast and order the columns of `schema`.

    A value that does not fit its type fails the query under ANSI mode, or
    becomes NULL if `permissive`."""
    return df.select(
        [
            (F.col(f.name).try_cast(f.dataType) if permissive else F.col(f.name).cast(f.dataType))
            .alias(f.name, metadata=f.metadata)
            for f in schema
        ]
    )
