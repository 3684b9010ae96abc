"""What writes and builds leave on the disks of executors and in the shared folder."""

import os
import threading
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ebbtide.operators.silver import silver_hqla
from ebbtide.plans import lake as lakes
from ebbtide.plans.lake import Lake
from ebbtide.plans.registry import QUERIES, new_lake
from ebbtide.schemas import LANDING
from ebbtide.sources import landing, storage
from conftest import SMALL


def shuffled(spark) -> dict[str, int]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f: os.path.getsize(f) for f in found.split("\n") if "/shuffle_" in f and os.path.exists(f)}


def left_by(spark, action) -> int:
    """Bytes of shuffle files that are still there some time after `action`."""
    before = set(shuffled(spark))
    action()
    for _ in range(100):
        if not (left := sum(size for file, size in shuffled(spark).items() if file not in before)):
            break
        time.sleep(0.05)
    return left


def files_of(path, end: str = ".parquet") -> list[str]:
    path = str(path).removeprefix("file:")
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(end) and f[0] != ".")


def text_rows(spark, dataset: str, days: list):
    """One landing row per day given, with the number of the row as its key."""
    names = LANDING[dataset].names
    records = [[str(i) if n == names[0] else d if n == "business_date" else " x, \"y" if n == "country" else None for n in names]
               for i, d in enumerate(days)]
    return spark.createDataFrame(records, LANDING[dataset])


def test_written_history_is_small_and_leaves_nothing_shuffled(spark, tmp_path):
    days = [f"2024-01-{1 + n % 9:02d}" for n in range(3000)]
    rows = text_rows(spark, "collateral", days).repartition(5)
    plain = landing.write_landing_history(rows, f"{tmp_path}/plain", "collateral", compression=None)
    written = []
    assert left_by(spark, lambda: written.append(landing.write_landing_history(rows, str(tmp_path), "collateral"))) == 0
    sizes = [sum(map(os.path.getsize, files_of(p, end))) for p, end in ((plain, ".csv"), (written[0], ".csv.gz"))]
    assert 0 < 3 * sizes[1] < sizes[0]
    back = landing.scan_landing(spark, written[0], "collateral")
    assert back.drop("source_file").exceptAll(rows).isEmpty() and back.count() == 3000


def test_a_long_history_is_written_in_ranges_of_days(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "ROWS_A_CORE", 3 / spark.sparkContext.defaultParallelism)
    days = [None, "2024-01-01", "2024-01-01", "2024-01-03", "2024-01-02", "2024-01-02", "2024-01-02", "2024-01-02", None]
    rows, parts = text_rows(spark, "balances", days), []
    write_parts = landing.write_parts
    monkeypatch.setattr(landing, "write_parts", lambda writers, *a: (parts.append(len(writers)), write_parts(writers, *a)))
    path = landing.write_landing_history(rows, str(tmp_path), "balances")
    assert parts == [4]  # none and none; the 1st; the 2nd, a day too long; the 3rd
    back = landing.scan_landing(spark, path, "balances")
    assert back.drop("source_file").exceptAll(rows).isEmpty() and back.count() == len(days)
    assert storage.is_complete(spark, path)


def test_groups_of_days_hold_every_row_once(spark):
    rows = spark.createDataFrame([(d,) for d in [None, 5, 1, 1, 9, 9, 9, 2, None, 7]], "day int")
    for most in (1, 2, 3, 100):
        parts = [rows.where(c).count() for c in storage.day_groups(rows, "day", most)]
        assert sum(parts) == 10 and (max(parts) <= max(most, 3)) and (len(parts) == 1) == (most == 100)
    assert storage.day_groups(rows.limit(0), "day") == []


def test_a_table_of_several_writes_is_whole_with_the_last(spark, tmp_path):
    good = spark.range(3).select("id", F.lit(1).alias("day"))
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id"), F.lit(2).alias("day"))
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="broken"):
        storage.write_table([good, bad], path, ["day"])
    assert not storage.is_complete(spark, path)
    again = storage.write_table([good, good.withColumn("day", F.lit(2))], path, ["day"])
    assert storage.is_complete(spark, path) and again.count() == 6


def test_stored_tables_are_sorted_and_well_packed(spark, tmp_path):
    rows = spark.range(20000).select(F.concat(F.lit("key"), F.hash("id")).alias("key"), (F.col("id") % 7).alias("day"))
    assert left_by(spark, lambda: storage.write_table(rows, str(tmp_path), ["day"], ["day", "key"])) == 0
    for file in files_of(tmp_path):
        table = pq.ParquetFile(file)
        assert table.metadata.row_group(0).column(0).compression == "ZSTD"
        keys = table.read().column("key").to_pylist()
        assert keys == sorted(keys)
    assert storage.read_table(spark, str(tmp_path), rows.schema).exceptAll(rows).isEmpty()


def test_settings_of_writes_end_with_the_last_one(spark):
    before = {key: spark.conf.get(key, None) for key in storage._SETTINGS}
    inside, outside = threading.Event(), threading.Event()

    def other():
        with storage.write_settings(spark):
            inside.set()
            outside.wait(20)

    thread = threading.Thread(target=other)
    with storage.write_settings(spark):
        thread.start()
        inside.wait(20)
    held = {key: spark.conf.get(key) for key in storage._SETTINGS}
    outside.set()
    thread.join()
    assert held == storage._SETTINGS
    assert {key: spark.conf.get(key, None) for key in storage._SETTINGS} == before


def test_silver_in_groups_of_days_is_silver(spark, lake, monkeypatch):
    monkeypatch.setattr(storage, "ROWS_A_CORE", 500 / spark.sparkContext.defaultParallelism)
    parts, write = [], lakes.write_table
    monkeypatch.setattr(lakes, "write_table", lambda df, *a: (parts.append(df), write(df, *a))[1])
    own = Lake(spark, storage.fresh_folder(spark, "run"), {"hqla": lake.feeds["hqla"]}, lake.bronze_time)
    stored = own.table("silver_hqla")
    assert len(parts[-1]) > 5
    assert stored.select("silver_load_timestamp").distinct().count() == 1
    whole = silver_hqla(own.table("bronze_hqla")).drop("silver_load_timestamp")
    assert stored.count() == whole.count() and stored.drop("silver_load_timestamp").exceptAll(whole).isEmpty()


def test_large_tables_are_built_one_by_one(spark, lake, monkeypatch):
    running, most = [0], [0]

    def action(name):
        running[0] += 1
        most[0] = max(most[0], running[0])
        time.sleep(0.2)
        running[0] -= 1
        return name

    for size, number in ((0, 1), (1 << 30, 2)):
        monkeypatch.setattr(storage, "BYTES_A_CORE", size)
        most[0] = 0
        for names in (["bronze_hqla", "bronze_collateral"], ["silver_hqla", "silver_collateral"]):
            lake.silver()
            assert lake.each(action, names) == names and most[0] == number


# Queries that build a lake of their own: what they shuffle does not stay, and what they store is packed.
BUILDING = [
    "silver_flag_distribution",
    "run_all",
    "resume_all",
    "funding_concentration",
    "collateral_concentration",
    "fk_orphans",
    "new_load_violations",
    "merged_fact_funding_stability",
    "merged_fact_collateral_risk",
]


@pytest.mark.parametrize("name", BUILDING)
def test_builds_leave_packed_tables_alone(spark, name):
    own = new_lake(spark, SMALL)
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(files_of(folder))
    assert left_by(spark, lambda: QUERIES[name](own)) < 200_000
    stored = [f for f in files_of(folder) if f not in before and "/generation-" not in f]  # bitmaps are no tables
    assert stored and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in stored if pq.ParquetFile(f).metadata.num_rows} == {"ZSTD"}
