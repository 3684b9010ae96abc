"""What a stored table was made of, as a short text per table.

The mark of a table is a digest of its name, the package's code, the run's options and the marks of its inputs; the
mark of a feed is a digest of the names, lengths and modification times of its files, so nothing is read but
directories.  A table whose stored mark equals the one computed now would be built again as it is."""

import hashlib
from collections.abc import Iterator
from functools import cache
from importlib.resources import files
from importlib.resources.abc import Traversable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.plans.lake import DATASETS, SCHEMAS, Lake
from ebbtide.sources.storage import input_files, read_mark

_DIMS = ["dim_date", "dim_country", "dim_subsidiary"]
_SILVER = [f"silver_{d}" for d in DATASETS]
# The stored tables that each table is built from; bronze and rejects are built from feeds.
INPUTS = {
    **{f"silver_{d}": [f"bronze_{d}"] for d in DATASETS},
    "liquidity_metrics": _SILVER,
    **{name: ["liquidity_metrics"] for name in _DIMS},
    "dim_account": ["silver_balances"],
    "fact_intraday_liquidity": ["liquidity_metrics", *_DIMS],
    "fact_hqla_position": ["silver_hqla", "liquidity_metrics", *_DIMS],
    "fact_funding_stability": ["silver_balances", "liquidity_metrics", *_DIMS],
    "fact_collateral_risk": ["silver_collateral", "liquidity_metrics", *_DIMS],
}


def _digest(*parts: str) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def _sources(folder: Traversable) -> Iterator[Traversable]:
    for entry in sorted(folder.iterdir(), key=lambda e: e.name):
        if entry.is_dir() and entry.name not in ("llm", "__pycache__"):
            yield from _sources(entry)
        elif entry.name.endswith(".py"):
            yield entry


@cache
def code_version() -> str:
    """Digest of the package's modules, the optional subpackage left out."""
    return _digest(*[hashlib.sha256(entry.read_bytes()).hexdigest() for entry in _sources(files("ebbtide"))])


def feed_mark(feed: DataFrame) -> str:
    """Digest of the files behind `feed` and of its columns.  Spark lists the files; their number and two sums over their hashes,
    which do not depend on the order, come to the driver."""
    columns = feed.schema.simpleString()
    found = input_files(feed)
    if found is None:
        return _digest(columns)
    parts = ("path", "length", "modificationTime")
    sums = [F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")) for seed in (1, 2)]
    return _digest(columns, *map(str, found.agg(F.count("path"), *sums).first()))


def table_marks(lake: Lake, version: str = "") -> dict[str, str]:
    """The mark of every table of a run of `lake` now.  Without a feed, bronze is taken as it is stored."""
    marks = {}
    options = [code_version(), version, str(lake.permissive)]
    for kind, feeds in (("rejects", lake.rejects), ("bronze", lake.feeds)):
        marks |= {f"{kind}_{d}": _digest(f"{kind}_{d}", *options, feed_mark(feed)) for d, feed in feeds.items()}
    for name in SCHEMAS:
        if name in INPUTS:
            marks[name] = _digest(name, *options, *[marks[i] for i in INPUTS[name]])
        elif name.startswith("bronze_") and name not in marks:
            marks[name] = read_mark(lake.spark, lake.path(name)) or _digest(name, "unknown")
    return marks
