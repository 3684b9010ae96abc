import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import SMALL

from ebbtide.operators import facts, integrity, profiling, reports
from ebbtide.plans.lake import LAYERS, Lake
from ebbtide.plans.run import run_all
from ebbtide.schemas import LANDING
from ebbtide.sources import landing, storage


def test_key_violations_are_found(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert integrity.key_violations(df, "t", "k").first()[:] == ("t", "k", 2, 2)


def test_orphans_are_found(spark, lake):
    tables = lake.gold()
    tables["dim_country"] = tables["dim_country"].filter("country_key <> 2")
    found = {
        (r.fact_table, r.key_column): r.orphan_rows for r in integrity.fk_orphans(tables).collect()
    }
    assert len(found) == 12
    for fact in ("fact_intraday_liquidity", "fact_hqla_position"):
        assert found[fact, "country_key"] == tables[fact].filter("country_key = 2").count()
        assert found[fact, "date_key"] == found[fact, "subsidiary_key"] == 0
    assert found["fact_intraday_liquidity", "country_key"] > 0


def test_summaries_of_empty_tables(lake):
    empty = {name: df.limit(0) for name, df in lake.bronze().items()}
    assert [r.record_count for r in profiling.bronze_summary(empty).collect()] == [0, 0, 0]


def test_status_of_a_country_is_the_last_in_the_alphabet(lake):
    fact, dims = lake.table("fact_intraday_liquidity"), lake.dims()
    last = dims.date.orderBy(F.desc("business_date")).first().date_key
    two = fact.filter(F.col("date_key") == last).limit(1)
    mixed = two.withColumn("lcr_status", F.lit("At Risk")).unionAll(
        two.withColumn("lcr_status", F.lit("Compliant")))
    assert reports.latest_lcr_snapshot(mixed, dims.country, dims.date).first().lcr_status == "Compliant"


def test_pivot_has_a_column_for_every_value(spark):
    df = spark.createDataFrame(
        [("A", "High"), ("A", "Odd"), ("A", "Odd"), ("B", "Low"), (None, "Low"), ("B", None)],
        "country string, balance_volatility string")
    out = reports.volatility_pivot(df)
    assert out.columns == ["country", "High", "Low", "Odd"]
    assert [tuple(r) for r in out.collect()] == [("A", 1, 0, 2), ("B", 0, 1, 0)]
    assert reports.volatility_pivot(df, ["Low"]).columns == ["country", "Low"]


def test_reports_take_padded_names_together(spark, lake):
    assert reports.balances_by_country(lake.bronze()["balances"]).count() == 8
    assert reports.volatility_pivot(lake.bronze()["balances"]).count() == 8
    levels = [r.hqla_level for r in reports.hqla_by_level(lake.bronze()["hqla"]).collect()]
    assert levels == ["Level 1", "Level 2A", "Level 2B", "Level 3"]


def feeds_from_csv(spark, lake, base):
    return {
        d: landing.scan_landing(spark, landing.write_landing_history(df, base, d), d)
        for d, df in lake.feeds.items()
    }


def test_run_from_landing_files(spark, lake):
    run = Lake(spark, storage.fresh_folder(spark, "run"),
               feeds_from_csv(spark, lake, storage.fresh_folder(spark, "landing")))
    report = run_all(run).collect()
    assert {r.status for r in report} == {"completed"}
    counts = {r.table_name: r.record_count for r in report}
    assert counts["silver_hqla"] == lake.silver()["hqla"].count()
    placed = run.table("silver_collateral").dropna(subset=facts.GRAIN)
    assert counts["fact_collateral_risk"] == facts.collateral_aggregated(placed).count()


def test_a_stored_lake_is_read_again(spark, lake):
    root = storage.fresh_folder(spark, "run")
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    assert {r.status for r in run_all(Lake(spark, root, lake.feeds)).collect()} == {"completed"}
    # nothing but the tables is left of the run
    assert set(os.listdir(folder)) - before == {os.path.basename(root)}
    assert set(os.listdir(root)) == {n for g in LAYERS.values() for names in g for n in names}

    def times():
        return {p: p.stat().st_mtime_ns for p in Path(root).rglob("*")}

    written, again = times(), Lake(spark, root)
    for name in ("bronze_balances", "silver_hqla", "liquidity_metrics", "dim_account", "fact_collateral_risk"):
        stored = again.table(name)
        assert stored.schema == Lake(spark, root, lake.feeds).table(name).schema
        assert stored.count() == lake.table(name).count()
    reports.balances_by_country(again.bronze()["balances"]).collect()
    assert again.gold().keys() == lake.gold().keys() and times() == written
    # a table whose write did not end is not served
    (Path(root) / "bronze_hqla" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="bronze_hqla is not stored"):
        Lake(spark, root).table("bronze_hqla")


def test_rejected_lines_are_stored_and_counted(spark, lake, tmp_path):
    for dataset, df in lake.feeds.items():
        landing.write_landing_csv(df, str(tmp_path / dataset), dataset, "2024-01-01")
    broken = next((tmp_path / "hqla").rglob("part-*.csv"))
    broken.with_name("part-x.csv").write_text("\n".join([",".join(LANDING["hqla"].names), "too,short", ""]))
    scans = {d: landing.scan_landing(spark, str(tmp_path / d), d, permissive=True) for d in lake.feeds}
    rejects = {d: landing.landing_rejects(spark, str(tmp_path / d), d) for d in lake.feeds}
    run = Lake(spark, storage.fresh_folder(spark, "run"), scans, permissive=True, rejects=rejects)
    report = {r.table_name: r.record_count for r in run_all(run).collect()}
    assert [report[f"rejects_{d}"] for d in scans] == [0, 1, 0]
    assert run.table("rejects_hqla").first().line == "too,short"
    assert report["bronze_hqla"] == lake.bronze()["hqla"].count()


def test_run_stops_at_the_first_failure(spark, lake):
    feeds = dict(lake.feeds)
    feeds["hqla"] = feeds["hqla"].withColumn("haircut_rate", F.lit("a lot"))
    report = run_all(Lake(spark, storage.fresh_folder(spark, "run"), feeds)).collect()
    states = {r.table_name: r.status for r in report}
    assert states["bronze_balances"] == "completed" and states["bronze_hqla"] == "failed"
    assert {states[n] for g in LAYERS["silver"] + LAYERS["gold"] for n in g} == {"skipped"}


def test_permissive_run_drops_the_bad_rows_in_silver(spark, lake):
    bad = F.when(F.col("hqla_level") == "Level 1", "a lot").otherwise(F.col("haircut_rate"))
    feeds = {**lake.feeds, "hqla": lake.feeds["hqla"].withColumn("haircut_rate", bad)}
    run = Lake(spark, storage.fresh_folder(spark, "run"), feeds, permissive=True)
    assert run.table("silver_hqla").filter("hqla_level = 'Level 1'").count() < (
        lake.silver()["hqla"].filter("hqla_level = 'Level 1'").count())


PLANNED = ["silver_hqla", "fact_intraday_liquidity", "fact_funding_stability", "dim_account",
           "dim_account_scd2", "latest_lcr_snapshot", "fk_orphans", "combined_metrics"]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = contract.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, table", [
    ("hqla", "silver_hqla"), ("funding", "silver_balances"), ("collateral", "silver_collateral")])
def test_shares_read_silver_once(spark, lake, name, table):
    plan = executed(contract.queries()[f"{name}_concentration"](spark, SMALL))
    assert plan.count("FileScan") == 2 and plan.count(f"/{table}]") + plan.count(f"/{table},") == 1


def test_days_of_stored_tables_are_pruned(spark, lake):
    day = lake.table("silver_hqla").agg(F.min("business_date")).scalar()
    one = lake.table("silver_hqla").filter(F.col("business_date") == F.lit(day))
    assert "PartitionFilters: [isnotnull(business_date" in executed(one) and not one.isEmpty()
    assert "PartitionFilters: [isnotnull(date_key" in executed(
        lake.table("fact_hqla_position").filter("date_key = 19950101"))


def test_metrics_take_one_shuffle(lake):
    from ebbtide.operators.facts import combined_metrics

    plan = combined_metrics(**lake.silver(), accounts_unique=True)._jdf.queryExecution()
    assert plan.executedPlan().toString().count("Exchange") == 1


def test_filters_reach_the_scan(spark, lake):
    from ebbtide.operators.silver import filter_valid_hqla

    plan = filter_valid_hqla(lake.bronze()["hqla"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(market_value_eur" in plan and "IsNotNull(asset_id)" in plan
