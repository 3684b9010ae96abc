"""The fourteen tables of a run and the order they are built in."""

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.bronze import to_bronze
from ebbtide.operators.conform import conform
from ebbtide.operators.dimensions import dim_account, dim_country, dim_date, dim_subsidiary
from ebbtide.operators.facts import (
    Dims, combined_metrics, fact_collateral_risk, fact_funding_stability, fact_hqla_position,
    liquidity_fact,
)
from ebbtide.operators.silver import KEYS, silver_balances, silver_collateral, silver_hqla
from ebbtide.schemas import BRONZE, FACTS, GOLD, METRICS, SILVER
from ebbtide.sources.storage import (
    day_groups, input_bytes, is_complete, is_large, read_table, stored_bytes, work_folder, write_table,
)

DATASETS = list(BRONZE)
REJECTS = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("line", T.StringType())])
SCHEMAS = {
    **{f"rejects_{d}": REJECTS for d in DATASETS},
    **{f"bronze_{d}": s for d, s in BRONZE.items()},
    **{f"silver_{d}": s for d, s in SILVER.items()},
    "liquidity_metrics": METRICS, **GOLD,
}
# Silver and the facts are stored by day, so that a date filter reads its days only.
STORED_BY = {**{f"silver_{d}": ["business_date"] for d in DATASETS}, **{f: ["date_key"] for f in FACTS}}
# Days and keys side by side make the large files small, and a scan of some days skips the pages of the others.
STORED_ORDER = {f"{layer}_{d}": ["business_date", KEYS[d]] for layer in ("bronze", "silver") for d in DATASETS}


def at_once(action: Callable, names: list[str]) -> list:
    """Run `action` on tables that do not need each other, at the same time: small
    ones fill the executors the large ones leave idle."""
    with ThreadPoolExecutor(max(len(names), 1)) as pool:
        return list(pool.map(action, names))


class Lake:
    """Tables below one folder, built from the raw feeds on first use and read from
    the folder afterwards, also by a later Lake on the same folder, which then needs no feeds.
    A table whose write did not end counts as missing; only `build` replaces a table.

    `rejects` are the landing lines that permissive scans of the feeds left out; they are stored too.

    Each layer reads the stored layer before it: text is parsed once, and silver's
    filters reach the parquet scan.  A value that does not fit its type fails the run,
    or is NULL if `permissive`."""

    def __init__(self, spark: SparkSession, root: str, feeds: Mapping[str, DataFrame] | None = None,
                 bronze_time: Column | None = None, load_time: Column | None = None,
                 permissive: bool = False, rejects: Mapping[str, DataFrame] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.feeds = feeds or {}
        self.rejects = rejects or {}
        self.bronze_time = bronze_time
        self.load_time = load_time
        self.permissive = permissive
        self._stored = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def build(self, name: str) -> DataFrame:
        """(Re)build and store one table; its intermediate results go when it is written."""
        with work_folder(self.spark):
            write_table(BUILDERS[name](self), self.path(name), STORED_BY.get(name, ()), STORED_ORDER.get(name, ()))
        self._stored.add(name)
        return self.table(name)

    def has(self, name: str) -> bool:
        if name not in self._stored and is_complete(self.spark, self.path(name)):
            self._stored.add(name)
        return name in self._stored

    def table(self, name: str) -> DataFrame:
        if not self.has(name):
            return self.build(name)
        return read_table(self.spark, self.path(name), SCHEMAS[name])

    def tables(self, names: Iterable[str]) -> dict[str, DataFrame]:
        self.each(self.build, [n for n in names if not self.has(n)])
        return {n: self.table(n) for n in names}

    def each(self, action: Callable, names: list[str]) -> list:
        """`action` for tables that do not need each other: at the same time, or one after the other if the rows that they
        move are many, which then do not lie on the disks together."""
        return [action(name) for name in names] if self._are_large(names) else at_once(action, names)

    def _are_large(self, names: Iterable[str]) -> bool:
        size = 0
        for name in names:
            layer, _, dataset = name.partition("_")
            if layer == "bronze" and dataset in self.feeds:
                with suppress(PySparkException):  # a feed that cannot be read is reported by its own build
                    size += input_bytes(self.feeds[dataset])
            elif layer == "silver" and self.has(f"bronze_{dataset}"):
                size += stored_bytes(self.spark, self.path(f"bronze_{dataset}"))
        return is_large(self.spark, size)

    def bronze(self) -> dict[str, DataFrame]:
        return self._layer("bronze")

    def silver(self) -> dict[str, DataFrame]:
        self.bronze()
        return self._layer("silver")

    def _layer(self, layer: str) -> dict[str, DataFrame]:
        return dict(zip(DATASETS, self.tables([f"{layer}_{d}" for d in DATASETS]).values()))

    def dims(self) -> Dims:
        self.table("liquidity_metrics")
        return Dims(*self.tables(["dim_date", "dim_country", "dim_subsidiary"]).values())

    def gold(self) -> dict[str, DataFrame]:
        self.dims()
        return self.tables(GOLD)


def _bronze(dataset: str) -> Callable[[Lake], DataFrame]:
    def build(lake: Lake) -> DataFrame:
        if dataset not in lake.feeds:
            raise ValueError(f"bronze_{dataset} is not stored in {lake.root} and there is no feed for it")
        return to_bronze(lake.feeds[dataset], dataset, lake.bronze_time, lake.permissive)

    return build


def _silver(dataset: str, clean: Callable[..., DataFrame]) -> Callable[[Lake], list[DataFrame]]:
    """Silver in groups of days, each with all rows of its keys: what is shuffled at once does not grow with the table."""
    def build(lake: Lake) -> list[DataFrame]:
        bronze, load_time = lake.table(f"bronze_{dataset}"), lake.load_time
        if load_time is None:  # one for all groups
            load_time = F.lit(lake.spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0])
            load_time = F.timestamp_micros(load_time)
        groups = day_groups(bronze.where("business_date IS NOT NULL"))
        return [clean(bronze.where(days), load_time) for days in groups] if len(groups) > 1 else [clean(bronze, load_time)]

    return build


# The metrics hold every date, country and subsidiary of silver, once each: the
# dimensions read this short table instead of scanning silver three more times.
BUILDERS: dict[str, Callable[[Lake], DataFrame | list[DataFrame]]] = {
    **{f"rejects_{d}": lambda k, d=d: k.rejects[d] for d in DATASETS},
    **{f"bronze_{d}": _bronze(d) for d in DATASETS},
    "silver_balances": _silver("balances", silver_balances),
    "silver_hqla": _silver("hqla", silver_hqla),
    "silver_collateral": _silver("collateral", silver_collateral),
    "liquidity_metrics": lambda k: conform(
        combined_metrics(**k.silver(), accounts_unique=True), METRICS),
    "dim_date": lambda k: dim_date([k.table("liquidity_metrics")]),
    "dim_country": lambda k: dim_country([k.table("liquidity_metrics")]),
    "dim_subsidiary": lambda k: dim_subsidiary([k.table("liquidity_metrics")]),
    "dim_account": lambda k: dim_account(k.table("silver_balances")),
    "fact_intraday_liquidity": lambda k: liquidity_fact(
        k.table("liquidity_metrics"), k.dims(), k.load_time),
    "fact_hqla_position": lambda k: fact_hqla_position(
        k.table("silver_hqla"), k.table("liquidity_metrics"), k.dims(), k.load_time),
    "fact_funding_stability": lambda k: fact_funding_stability(
        k.table("silver_balances"), k.table("liquidity_metrics"), k.dims(), k.load_time),
    "fact_collateral_risk": lambda k: fact_collateral_risk(
        k.table("silver_collateral"), k.table("liquidity_metrics"), k.dims(), k.load_time),
}

# Per layer, groups of tables that can be built at the same time.
LAYERS = {
    "bronze": [[f"bronze_{d}" for d in DATASETS]],
    "silver": [[f"silver_{d}" for d in DATASETS]],
    "gold": [
        ["liquidity_metrics", "dim_account"],
        ["dim_date", "dim_country", "dim_subsidiary"],
        FACTS,
    ],
}
