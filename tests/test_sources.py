from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.bronze import bronze_balances
from ebbtide.schemas import BRONZE, GOLD, LANDING
from ebbtide.sources import landing, storage
from ebbtide.sources.feed import RAW_SQL
from conftest import SMALL

HEADER = ",".join(LANDING["balances"].names)


def csv(folder: Path, name: str, *lines: str, header: str = HEADER) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def line(account: str, eur: str) -> str:
    values = {"account_id": account, "balance_eur": eur, "business_date": "2024-01-01"}
    return ",".join(values.get(n, "") for n in LANDING["balances"].names)


def test_scan_finds_nested_csv_files_only(spark, tmp_path):
    csv(tmp_path / "2024-01-01" / "x.csv", "part-0.csv", line(" A", "1"))
    csv(tmp_path / "2024-02-01", "y.csv", line("B ", "2"))
    csv(tmp_path / "2024-02-01", "notes.txt", line("C", "3"))
    out = landing.scan_landing_balances(spark, str(tmp_path))
    found = {(r.account_id, r.country, r.source_file.rsplit("/", 1)[1]) for r in out.collect()}
    assert found == {(" A", None, "part-0.csv"), ("B ", None, "y.csv")}


def test_scan_refuses_other_headers(spark, tmp_path):
    swapped = HEADER.replace("balance_local,balance_eur", "balance_eur,balance_local")
    csv(tmp_path, "a.csv", line("A", "1"), header=swapped)
    with pytest.raises(Exception, match="header"):
        landing.scan_landing_balances(spark, str(tmp_path)).collect()


def test_casts_round_half_up_and_bad_values_fail_unless_permitted(spark, tmp_path):
    csv(tmp_path / "good", "a.csv", line("A", "2.345"), line("B", ""))
    good = bronze_balances(landing.scan_landing_balances(spark, str(tmp_path / "good")))
    assert [r.balance_eur for r in good.orderBy("account_id").collect()] == [Decimal("2.35"), None]
    csv(tmp_path / "bad", "a.csv", line("A", "twelve"))
    bad = landing.scan_landing_balances(spark, str(tmp_path / "bad"))
    with pytest.raises(Exception, match="CAST"):
        bronze_balances(bad).collect()
    assert bronze_balances(bad, permissive=True).first().balance_eur is None


BAD_LINES = {
    "long": line("A", "1") + ",more",
    "short": "A,B",
    "quoted": line('"A,x"', "1") + ",more",
}


@pytest.mark.parametrize("kind", BAD_LINES)
def test_a_line_of_another_length_is_refused_by_every_read(spark, tmp_path, kind):
    csv(tmp_path, "a.csv", line("A", "1"), BAD_LINES[kind])
    scan = landing.scan_landing_balances(spark, str(tmp_path))
    for read in (scan.count, scan.collect, scan.select("account_id").collect):
        with pytest.raises(Exception, match="(?i)malformed"):
            read()


def test_permissive_scans_set_bad_lines_aside(spark, tmp_path):
    csv(tmp_path, "a.csv", line("A", "1"), *BAD_LINES.values(), line('"B,x"', "2"))
    rows = landing.scan_landing(spark, str(tmp_path), "balances", permissive=True)
    assert sorted(r.account_id for r in rows.collect()) == ["A", "B,x"]
    assert rows.count() == 2
    rejects = landing.landing_rejects(spark, str(tmp_path), "balances")
    assert sorted(r.line for r in rejects.collect()) == sorted(BAD_LINES.values())
    assert rejects.count() == 3 and rejects.first().source_file.endswith("/a.csv")


def test_quoted_lines_are_one_row(spark, tmp_path):
    csv(tmp_path, "a.csv", line('"A, B"', "1"))
    assert landing.scan_landing_balances(spark, str(tmp_path)).first().account_id == "A, B"


def test_long_keys_are_not_cut(spark):
    wide = "LPAD(CAST(k AS STRING), CAST(GREATEST(6, LENGTH(CAST(k AS STRING))) AS INT), '0')"
    assert all(wide.replace("k AS", f"{c} AS") in sql for c, sql in
               [("ck", RAW_SQL["balances"]), ("pk", RAW_SQL["hqla"]), ("pk", RAW_SQL["collateral"])])
    keys = spark.createDataFrame([(12,), (1234567,), (1234568,)], "k long").selectExpr(wide).collect()
    assert [r[0] for r in keys] == ["000012", "1234567", "1234568"]


def test_feeds_read_every_line_item(spark, lake):
    items = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert lake.feeds["hqla"].count() == lake.feeds["collateral"].count() == items


DIRTY = {
    "balances": [
        "country IS NULL", "subsidiary IS NULL", "trim(account_id) = ''", "account_id IS NULL", "balance_eur = 0",
        "balance_eur < 0", "weighted_outflow_rate IS NULL", "weighted_outflow_rate < 0",
        "last_transaction_date IS NULL", "upper(trim(stable_funding_flag)) NOT IN ('Y', 'N')",
    ],
    "hqla": [
        "country IS NULL", "subsidiary IS NULL", "trim(asset_id) = ''", "market_value_eur = 0",
        "haircut_rate IS NULL", "haircut_rate > 1", "eligible_hqla_value_eur < 0",
        "upper(trim(encumbered_flag)) NOT IN ('Y', 'N')", "upper(central_bank_eligible) NOT IN ('Y', 'N')",
    ],
    "collateral": [
        "country IS NULL", "subsidiary IS NULL", "trim(collateral_id) = ''", "gross_value_eur = 0",
        "haircut_percentage IS NULL", "loan_to_value_ratio IS NULL", "loan_to_value_ratio > 1",
        "next_review_date IS NULL", "upper(insurance_status) NOT IN ('Y', 'N')",
    ],
}


def test_the_feed_holds_every_kind_of_dirty_row(lake):
    for dataset, cases in DIRTY.items():
        counts = lake.bronze()[dataset].agg(*[F.count_if(F.expr(c)).alias(c) for c in cases]).first().asDict()
        assert all(counts.values()), counts
    fact = lake.table("fact_intraday_liquidity")
    assert not fact.filter("weighted_outflow_amount < 0 AND total_hqla_eligible_eur < 0").isEmpty()


def test_one_day_export_round_trip(spark, tmp_path, lake):
    df = lake.feeds["balances"]
    path = landing.write_landing_csv(df, str(tmp_path), "balances", "2024-01-01", single_file=True)
    assert path.endswith("/2024-01-01/balances_2024-01-01.csv")
    assert len(list(Path(path).glob("part-*.csv"))) == 1
    back = landing.scan_landing_balances(spark, str(tmp_path)).select(LANDING["balances"].names)
    assert back.exceptAll(df.select(back.columns)).isEmpty()
    assert back.count() == df.count()


def test_load_timestamp_defaults_to_now(spark):
    row = landing.with_load_timestamp(spark.range(1)).withColumn("now", F.current_timestamp()).first()
    assert row.load_timestamp == row.now


def test_partitioned_table_round_trip(spark, lake):
    silver = lake.silver()["balances"]
    path = storage.fresh_folder(spark, "t")
    stored = storage.write_table(silver, path, ["business_date"])
    assert stored.schema.names == silver.schema.names
    day = silver.agg(F.min("business_date")).scalar()
    plan = stored.filter(F.col("business_date") == "1995-01-01")._jdf.queryExecution()
    assert "PartitionFilters: [isnotnull(business_date" in plan.executedPlan().toString()
    assert stored.filter(F.col("business_date") == day).count() > 0
    storage.write_table(silver.limit(0), path, ["business_date"])
    assert storage.read_table(spark, path, silver.schema).isEmpty()


def test_catalog_table(spark, lake):
    countries = lake.dims().country
    saved = storage.save_table(countries, "countries")
    assert saved.count() == countries.count()
    again = storage.overwrite_table(countries.filter("country_key = 1"), "countries")
    assert again.count() == 1
    described = {r.col_name: r for r in storage.describe_table(spark, "countries").collect()}
    assert described["country_key"].data_type == "int"
    assert described["country_key"].comment == "Key of the country row"


def test_overwrite_matches_by_name(spark):
    path = storage.fresh_folder(spark, "pairs")
    storage.save_table(spark.createDataFrame([(0, "old")], "a int, b string"), "pairs", path)
    swapped = spark.createDataFrame([("new", 1.5, "2")], "b string, c double, a string")
    assert storage.overwrite_table(swapped, "pairs").collect() == [(2, "new")]
    with pytest.raises(Exception, match="`a`"):
        storage.overwrite_table(swapped.drop("a"), "pairs")
    assert spark.table("pairs").collect() == [(2, "new")]
    spark.sql("DROP TABLE pairs")


def test_a_work_folder_goes_with_its_block(spark):
    with pytest.raises(RuntimeError), storage.work_folder(spark):
        path = storage.fresh_folder(spark, "x")
        storage.write_table(spark.range(3).toDF("a"), path)
        assert storage.is_complete(spark, path)
        raise RuntimeError
    assert not Path(path).parent.exists() and not storage.is_complete(spark, path)


@pytest.mark.parametrize("master", ["yarn", "local[8]"])
def test_a_session_needs_a_shared_folder(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf={}, sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(session)
    session.conf = {"spark.checkpoint.dir": "hdfs://bank/work/"}
    assert storage.shared_folder(session) == "hdfs://bank/work"


def test_declared_schemas():
    assert [len(s) for s in BRONZE.values()] == [18, 22, 23]
    assert [len(s) for s in GOLD.values()] == [16, 7, 4, 10, 24, 18, 22, 23]
    assert all(f.metadata["comment"] for s in [*BRONZE.values(), *GOLD.values()] for f in s)
