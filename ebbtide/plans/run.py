"""Full refresh of the layers, with a status report, and runs that go on where an earlier one ended."""

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ebbtide.plans.fingerprints import table_marks
from ebbtide.plans.lake import LAYERS, Lake
from ebbtide.sources.storage import read_mark, write_mark

STATUS_SCHEMA = "layer string, table_name string, status string, record_count long, message string"


def _attempt(lake: Lake, layer: str, name: str, mark: str | None) -> tuple:
    try:
        if mark is not None and lake.has(name) and read_mark(lake.spark, lake.path(name)) == mark:
            return layer, name, "current", lake.table(name).count(), None
        rows = lake.build(name).count()  # answered from the parquet footers
        if mark is not None:
            write_mark(lake.spark, lake.path(name), mark)
    except Exception as error:  # reported; nothing later is built
        return layer, name, "failed", None, str(error).split("\n", 1)[0]
    return layer, name, "completed", rows, None


def run_layer(lake: Lake, layer: str, marks: Mapping[str, str] | None = None) -> list[tuple]:
    """Build the tables of one layer in dependency order, up to the first failure; with `marks`
    only those that are not stored with their mark."""
    report = []
    rejects = [f"rejects_{d}" for d in lake.rejects] if layer == "bronze" else []
    for names in [rejects, *LAYERS[layer]]:
        report += lake.each(lambda name: _attempt(lake, layer, name, (marks or {}).get(name)), names)
        if _failed(report):
            break
    return report


def _failed(report: list[tuple]) -> bool:
    return any(row[2] == "failed" for row in report)


def run_all(lake: Lake, marks: Mapping[str, str] | None = None) -> DataFrame:
    """Build bronze, silver and gold; one status row per table.  Landing lines that a permissive
    scan left out are stored with bronze and reported with their number.

    After a failure nothing more is built, so gold never rests on stale silver;
    the remaining tables are reported as skipped."""
    report = []
    for layer in LAYERS:
        report += run_layer(lake, layer, marks)
        if _failed(report):
            break
    seen = {row[1] for row in report}
    report += [
        (layer, name, "skipped", None, None)
        for layer, groups in LAYERS.items() for names in groups for name in names
        if name not in seen
    ]
    return lake.spark.createDataFrame(report, STATUS_SCHEMA)


def resume_all(lake: Lake, version: str = "") -> DataFrame:
    """`run_all` that keeps the tables which an earlier resumable run stored from the same input files with the same code;
    they are reported as current.

    After a failed or killed run the first table that was not finished is built, and what rests on it; after new or
    changed landing files what rests on them.  `version` names what the fingerprints cannot see: how feeds are
    derived from their files.  Load times of current tables stay those of their run."""
    return run_all(lake, table_marks(lake, version))
