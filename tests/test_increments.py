"""Loads of new files, days overwritten one by one, keys that outlive a rebuild."""

import datetime
import os
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import dimensions, distinct_counts, keys, silver
from ebbtide.plans.registry import lake_of
from ebbtide.sources import storage
from ebbtide.streaming.landing_stream import load_new_files
from conftest import SMALL
from test_sources import csv, line


def accounts(df):
    return Counter(r.account_id for r in df.collect())


def test_every_file_is_loaded_once(spark, tmp_path):
    zone, table, ledger = tmp_path / "zone", str(tmp_path / "table"), str(tmp_path / "ledger")
    csv(zone / "2024-01-01" / "x.csv", "part-0.csv", line("A", "1"), line("B", "2"))
    csv(zone / "2024-01-01", "notes.txt", line("X", "3"))
    assert accounts(load_new_files(spark, str(zone), "balances", table, ledger)) == {"A": 1, "B": 1}
    csv(zone / "2024-02-01", "y.csv", line("C", "3"))
    csv(zone / "2024-02-01" / "z.csv", "part-0.csv", line("A", "4"))
    for _ in range(2):
        found = load_new_files(spark, str(zone), "balances", table, ledger, files_a_batch=1)
        assert accounts(found) == {"A": 2, "B": 1, "C": 1}
    assert {r.source_file.rsplit("/", 1)[1] for r in found.collect()} == {"part-0.csv", "y.csv"}


def test_a_failed_run_loses_and_repeats_nothing(spark, tmp_path):
    zone, table, ledger = tmp_path / "zone", str(tmp_path / "table"), str(tmp_path / "ledger")
    load = lambda: load_new_files(spark, str(zone), "balances", table, ledger)
    csv(zone, "a.csv", line("A", "1"))
    load()
    csv(zone, "b.csv", line("B", "2"))
    csv(zone, "c.csv", line("C", "not a number"))
    for _ in range(2):
        with pytest.raises(Exception, match="CAST"):
            load()
        assert accounts(spark.read.parquet(table)) == {"A": 1}
    csv(zone, "c.csv", line("C", "3"))
    csv(zone, "d.csv", line("D", "4"))
    assert accounts(load()) == {"A": 1, "B": 1, "C": 1, "D": 1}
    assert accounts(load()) == {"A": 1, "B": 1, "C": 1, "D": 1}


def stamps(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_only_touched_days_are_written(spark, lake, tmp_path):
    path, bronze = str(tmp_path / "silver"), lake.table("bronze_balances")
    days = [r[0] for r in bronze.where("business_date IS NOT NULL").select("business_date").distinct().orderBy("business_date").collect()]
    late = F.col("business_date").isin(days[3], days[7]) & F.col("account_id").endswith("1")
    storage.write_table(silver.silver_balances(bronze.where(~F.coalesce(late, F.lit(False)))), path, ["business_date"])
    before = stamps(path)
    touched = bronze.where(late).select("business_date")
    found = storage.overwrite_days(silver.silver_of_days(bronze, touched, "balances"), path, touched)
    drop = "silver_load_timestamp"
    assert Counter(map(tuple, found.drop(drop).collect())) == Counter(map(tuple, silver.silver_balances(bronze).drop(drop).collect()))
    after = stamps(path)
    same = {p for p in before if after.get(p) == before[p]}
    assert {p for p in before.keys() | after.keys() if p not in same} == {
        p for p in before.keys() | after.keys() if any(f"business_date={d}" in p for d in (days[3], days[7]))
    }
    plan = silver.silver_of_days(storage.read_table(spark, path, bronze.schema), touched, "balances")
    assert "dynamicpruning" in plan._jdf.queryExecution().toString().lower()


def test_days_without_rows_go_and_other_days_are_refused(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None), (4, "2024-01-03")], "n int, d string")
    rows = rows.select("n", F.col("d").cast("date").alias("business_date"))
    storage.write_table(rows, path, ["business_date"])
    two = rows.where("n IN (1, 3)").select("business_date")
    found = storage.overwrite_days(rows.where("n = 1").withColumn("n", F.lit(9)), path, two)
    assert sorted(r.n for r in found.collect()) == [2, 4, 9]
    with pytest.raises(Exception, match="a row on a day that is not replaced"):
        storage.overwrite_days(rows, path, two)
    # the table itself may be what the new rows are made of
    found = storage.overwrite_days(found.withColumn("n", F.col("n") + 1), path, found)
    assert sorted(r.n for r in found.collect()) == [3, 5, 10]
    assert storage.overwrite_days(rows.limit(0), path, rows.limit(0)).count() == 3


def test_keys_outlive_new_members(spark, tmp_path):
    schema = "country string, subsidiary string"
    rows = spark.createDataFrame([("B", "x"), ("A", "y"), (None, "z"), ("B", "x")], schema)
    registry = keys.KeyRegistry(spark, str(tmp_path / "keys"), rows.schema, "k")
    assert registry.table().isEmpty()
    first = {(r.country, r.subsidiary): r.k for r in registry.extend(rows).collect()}
    assert first == {(None, "z"): 1, ("A", "y"): 2, ("B", "x"): 3}
    more = rows.unionByName(spark.createDataFrame([("A", "a"), (None, None), ("C", "c")], schema)).withColumn("other", F.lit(1))
    second = {(r.country, r.subsidiary): r.k for r in registry.extend(more).collect()}
    assert second == {**first, (None, None): 4, ("A", "a"): 5, ("C", "c"): 6}
    # another run over the same folder, without new members, and one whose write was cut off
    again = keys.KeyRegistry(spark, str(tmp_path / "keys"), rows.schema, "k")
    assert {(r.country, r.subsidiary): r.k for r in again.extend(rows).collect()} == second
    os.remove(tmp_path / "keys" / "generation-000002" / "_SUCCESS")
    assert {(r.country, r.subsidiary): r.k for r in again.extend(more.unionByName(more)).collect()} == second
    keyed = again.keyed(more.unionByName(spark.createDataFrame([("Z", "z", 2)], schema + ", other int")))
    assert keyed.columns == ["country", "subsidiary", "other", "k"]
    assert Counter(r.k for r in keyed.collect()) == {3: 2, 2: 1, 1: 1, 5: 1, 4: 1, 6: 1, None: 1}


def test_registry_plan_has_no_one_task_sort(spark, lake, tmp_path):
    """New members are numbered by ranges; only the range counts meet in one task."""
    rows = lake_of(spark, SMALL).table("silver_balances")
    members = rows.select("account_id", "country").schema
    registry = keys.KeyRegistry(spark, str(tmp_path / "keys"), members, "account_key")
    early = registry.extend(rows.where("business_date < DATE '1998-01-01'"))
    n, total = early.count(), rows.select("account_id", "country").distinct().count()
    whole = registry.extend(rows)
    assert 0 < n < total == whole.count() and whole.agg(F.max("account_key")).first()[0] == total
    assert whole.select("account_key").distinct().count() == total


STATES = "account_id string, " + ", ".join(f"{c} string" for c in dimensions.ACCOUNT_ATTRIBUTES) + ", business_date date"


def observed(spark, seen):
    start = datetime.date(2024, 2, 20)
    rows = [(a, t, None, "EUR", "X", "Y", start + datetime.timedelta(d)) for (a, d), t in seen.items()]
    return spark.createDataFrame(rows, STATES)


def versions(seen):
    """Account, state, first and last day of each version, by a plain loop."""
    found = []
    for (a, d), t in sorted(seen.items()):
        if found and found[-1][0] == a and found[-1][1] == t:
            found[-1][3] = d
        else:
            found.append([a, t, d, d])
    return Counter((a, t, s, e, found[k + 1][2] - 1 if k + 1 < len(found) and found[k + 1][0] == a else None) for k, (a, t, s, e) in enumerate(found))


def told(history):
    day = lambda d: None if d is None else (d - datetime.date(2024, 2, 20)).days
    rows = history.collect()
    assert all((r.is_current == "Y") == (r.end_date is None) for r in rows)
    return Counter((r.account_id, r.account_type, day(r.effective_date), day(r.last_seen), day(r.end_date)) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_history_by_increments_is_the_full_one(spark, seed):
    """Days arrive in any order, and are replaced: rows change their state, appear and go."""
    rng, seen, names = random.Random(seed), {}, [f"a{k}" for k in range(40)]
    stored = dimensions.account_history(observed(spark, seen))
    assert stored.isEmpty()
    for load in range(8):
        days = rng.sample(range(12), rng.randrange(1, 4))
        for d in days:
            for a in names:
                seen.pop((a, d), None)
                if rng.random() < 0.75:
                    seen[a, d] = rng.choice(["u", "u", "v", None])
        rows = observed(spark, seen)
        touched = observed(spark, {("x", d): "" for d in days})
        stored = storage.materialise(dimensions.merge_account_history(stored, rows, touched), "history")
        assert told(stored) == versions(seen), load
    assert told(dimensions.account_history(rows)) == versions(seen)
    assert told(dimensions.merge_account_history(stored, rows, touched.limit(0))) == versions(seen)


def test_a_day_in_order_reads_its_own_rows_only(spark):
    """The rows of earlier days fail the query if they are read."""
    seen = {(f"a{k}", d): "uv"[(k + d) // 5 % 2] for k in range(9) for d in range(6)}
    stored = storage.materialise(dimensions.account_history(observed(spark, seen)), "history")
    seen.update({(f"a{k}", 6): "v" for k in range(7)})
    last = datetime.date(2024, 2, 26)
    rows = storage.materialise(observed(spark, seen), "days").withColumn(
        "currency", F.when(F.col("business_date") == last, F.col("currency")).otherwise(F.raise_error(F.lit("read again")))
    )
    touched = rows.where(F.col("business_date") == last).select("business_date")
    assert told(dimensions.merge_account_history(stored, rows, touched)) == versions(seen)


def test_counts_merge_over_any_days(spark, tmp_path):
    """Numbers beyond one bitmap, NULLs, repeated rows and a day that is replaced; then any range against a plain count."""
    rng = random.Random(3)
    seen = {(d, rng.choice("AB"), rng.randrange(200_000)) for d in range(1, 6) for _ in range(9_000)}
    frame = lambda some: spark.createDataFrame(list(some), "d int, c string, n int").select(
        F.make_date(F.lit(2024), F.lit(1), "d").alias("business_date"), F.col("c").alias("country"),
        F.concat(F.lit("account "), "n").alias("account_id"),
    )
    rows, path, by = frame(seen), str(tmp_path / "bitmaps"), ["business_date", "country"]
    odd = rows.limit(50).unionByName(rows.limit(3).withColumn("account_id", F.lit(None).cast("string")))
    registry = keys.KeyRegistry(spark, str(tmp_path / "keys"), rows.select("account_id").schema, "k")
    with pytest.raises(Exception, match="a member without a key"):
        distinct_counts.member_bitmaps(rows, registry, by).collect()
    registry.extend(rows)
    storage.write_table(distinct_counts.member_bitmaps(rows.unionByName(odd), registry, by), path, ["business_date"])
    seen = {(d, c, n) for d, c, n in seen if d != 4} | {(4, "A", 60_001), (4, "B", 7)}
    day = frame(x for x in seen if x[0] == 4)
    registry.extend(day)
    stored = storage.overwrite_days(distinct_counts.member_bitmaps(day, registry, by), path, day)
    assert stored.agg(F.max("bucket")).first()[0] > 1
    for first, last in ((1, 5), (2, 4), (4, 4)):
        days = stored.where(F.dayofmonth("business_date").between(first, last))
        found = {r.country: r.accounts for r in distinct_counts.count_members(days, ["country"], "accounts").collect()}
        assert found == {c: len({n for d, x, n in seen if x == c and first <= d <= last}) for c in "AB"}
    total = distinct_counts.count_members(stored, [], "accounts").first()[0]
    assert total == len({n for _, _, n in seen})
    assert distinct_counts.count_members(stored.limit(0), ["country"], "accounts").isEmpty()
