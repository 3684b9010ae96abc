"""Facts from stored partial sums.

Per day, the sums and counts of the facts are stored, and the numerators and row counts of their averages in place of
the averages themselves.  New or replaced days scan silver for those days alone; the facts, and the same
measures over months or any coarser groups, are made from the stored sums.  Every group of a fact lies within
a day and a day is replaced as a whole, so facts need no further aggregation.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.conform import conform
from ebbtide.operators.dimensions import dim_country, dim_date, dim_subsidiary
from ebbtide.operators.facts import (
    GRAIN, POSITIONS, Dims, Measures, combined_metrics, liquidity_fact, position_fact,
)
from ebbtide.schemas import METRICS, SILVER
from ebbtide.sources.storage import exists, overwrite_days, read_table

_COUNT = T.DecimalType(20, 0)


def _numerator(name: str) -> str:
    return f"_sum_{name}"


def _rows(name: str) -> str:
    return f"_rows_{name}"


def partial_sums(rows: DataFrame, measures: Measures) -> DataFrame:
    """One row per day, country, subsidiary and group; averages as numerator and number of rows."""
    return rows.groupBy(*GRAIN, *measures.by).agg(
        F.count(measures.counted).alias(measures.count),
        *[F.sum(value).alias(name) for name, value in measures.sums.items()],
        *[F.sum(value).alias(_numerator(name)) for name, value in measures.averages.items()],
        *[F.count(value).alias(_rows(name)) for name, value in measures.averages.items()],
    )


def _quotient(total: Column, rows: Column, kind: T.DataType) -> Column:
    """What AVG gives for rows with this sum, to the last digit; NULL without rows.

    The type of a plain decimal quotient keeps too few digits for large sums, so whole part and rest are divided apart;
    both have the sign of the sum, so rounding the rest rounds the average."""
    if not isinstance(kind, T.DecimalType):
        return F.when(rows > 0, total / rows)
    average = T.DecimalType(kind.precision - 6, kind.scale + 4)  # a sum has ten digits more than its values, AVG four
    count = rows.cast(_COUNT)
    rest = total % count
    whole = ((total - rest) / count).cast(average)
    return F.when(rows > 0, (whole + (rest / count).cast(average)).cast(average))


def with_averages(partials: DataFrame, measures: Measures) -> DataFrame:
    """Averages in place of their numerators and row counts."""
    return partials.select(
        *[c for c in partials.columns if not c.startswith(("_sum_", "_rows_"))],
        *[
            _quotient(F.col(_numerator(name)), F.col(_rows(name)), partials.schema[_numerator(name)].dataType).alias(name)
            for name in measures.averages
        ],
    )


def merge_partials(partials: DataFrame, measures: Measures, by: Sequence[str]) -> DataFrame:
    """The measures over the groups of `by`, any columns that `partials` has or derives from its own."""
    held = {f.name: f.dataType for f in partials.schema}
    names = [measures.count, *measures.sums]
    names += [of(name) for of in (_numerator, _rows) for name in measures.averages]
    merged = partials.groupBy(*by).agg(*[F.sum(n).cast(held[n]).alias(n) for n in names])
    return with_averages(merged, measures)


class FactPartials:
    """The partial sums below one folder, a table per fact, each partitioned by day.

    `update` writes one table after the other; after a failure it is repeated with the same days, which gives the
    same tables however far the failed one came.  One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.path}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return read_table(self.spark, path, schema)

    def update(self, silver: Mapping[str, DataFrame], days: DataFrame) -> None:
        """Replace the days in `days` (column business_date) by what `silver` (balances, hqla, collateral) holds of them.

        Silver tables stored by day are read for these days only; the days go through the driver as a calendar.  Rows without
        a date are in no fact.  As in silver, no account may occur twice on a day."""
        days = days.where("business_date IS NOT NULL").select("business_date").distinct()
        dates = [row[0] for row in days.collect()]
        rows = {name: df.where(F.col("business_date").isin(dates)) for name, df in silver.items()}
        calendar = self.spark.createDataFrame([(d,) for d in dates], "business_date date")
        metrics = conform(combined_metrics(**rows, accounts_unique=True), METRICS)
        tables = {"liquidity_metrics": metrics}
        for name, position in POSITIONS.items():
            tables[name] = partial_sums(rows[position.dataset], position.measures())
        for name, table in tables.items() if dates else ():
            overwrite_days(table, f"{self.path}/{name}", calendar)

    def metrics(self) -> DataFrame:
        """The liquidity metrics of all stored days."""
        return self._table("liquidity_metrics", METRICS)

    def partials(self, name: str) -> DataFrame:
        """The stored sums of position fact `name`."""
        position = POSITIONS[name]
        none = self.spark.createDataFrame([], SILVER[position.dataset])
        return self._table(name, partial_sums(none, position.measures()).schema)

    def dims(self) -> Dims:
        """The dimensions of the stored days."""
        return Dims(*[build([self.metrics()]) for build in (dim_date, dim_country, dim_subsidiary)])

    def fact(self, name: str, dims: Dims, load_time: Column | None = None) -> DataFrame:
        """Fact `name` over all stored days, equal to a full build from silver."""
        if name not in POSITIONS:
            return liquidity_fact(self.metrics(), dims, load_time)
        sums = with_averages(self.partials(name), POSITIONS[name].measures())
        return position_fact(name, sums, self.metrics(), dims, load_time)
