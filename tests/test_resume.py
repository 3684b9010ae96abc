"""Runs that go on where an earlier one ended."""

import os
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ebbtide.plans import fingerprints, lake as lakes
from ebbtide.plans.fingerprints import INPUTS, feed_mark, table_marks
from ebbtide.plans.lake import BUILDERS, LAYERS, Lake
from ebbtide.plans.run import resume_all, run_all
from ebbtide.sources import landing, storage

ALL = [name for groups in LAYERS.values() for names in groups for name in names]
BRONZE_SILVER = [n for n in ALL if n.startswith(("bronze_", "silver_"))]


@pytest.fixture(scope="module")
def zone(spark, lake):
    """A few days of every feed as landing files."""
    base = storage.fresh_folder(spark, "landing with blanks")
    for d, feed in lake.feeds.items():
        landing.write_landing_csv(feed.where("year(business_date) = 1995 AND month(business_date) < 3"), f"{base}/{d}", d, "1995-03-01")
    return base


def over(spark, zone, root):
    return Lake(spark, root, {d: landing.scan_landing(spark, f"{zone}/{d}", d) for d in lakes.DATASETS})


def states(report):
    return {r.table_name: r.status for r in report.collect()}


def built(report):
    assert not [r for r in report.collect() if r.status == "failed"]
    found = states(report)
    assert set(found) == set(ALL) and set(found.values()) <= {"completed", "current"}
    return {n for n, s in found.items() if s == "completed"}


def resting_on(*names):
    found = set(names)
    for name in ALL:
        if found & set(INPUTS.get(name, [])):
            found.add(name)
    return found


def test_a_failed_run_goes_on_at_the_first_table_that_is_not_there(spark, zone, monkeypatch):
    root = storage.fresh_folder(spark, "run")
    broken = dict(BUILDERS, dim_country=lambda k: k.table("liquidity_metrics").select(F.raise_error(F.lit("lost")).alias("x")))
    monkeypatch.setattr(lakes, "BUILDERS", broken)
    report = states(resume_all(over(spark, zone, root)))
    assert report["dim_country"] == "failed" and report["fact_hqla_position"] == "skipped"
    monkeypatch.undo()
    finished = {n for n, s in report.items() if s == "completed"}
    assert set(BRONZE_SILVER) < finished
    before = {n: (Path(root) / n / "_SUCCESS").stat().st_mtime_ns for n in finished}
    assert built(resume_all(over(spark, zone, root))) == set(ALL) - finished
    assert before == {n: (Path(root) / n / "_SUCCESS").stat().st_mtime_ns for n in finished}
    assert not built(resume_all(over(spark, zone, root)))
    # killed while it wrote a table, and after the write but before the mark
    os.remove(f"{root}/silver_hqla/_SUCCESS")
    os.remove(f"{root}/dim_account/_FINGERPRINT")
    assert built(resume_all(over(spark, zone, root))) == {"silver_hqla", "dim_account"}
    # the tables are those of a plain run
    plain = over(spark, zone, storage.fresh_folder(spark, "run"))
    run_all(plain)
    for name in ("silver_hqla", "dim_account", "fact_funding_stability"):
        times = [c for c in plain.table(name).columns if c.endswith("load_timestamp")]
        one, other = (k.table(name).drop(*times) for k in (plain, over(spark, zone, root)))
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    # without feeds, bronze is what it is; a plain run leaves no marks
    assert not built(resume_all(Lake(spark, root)))
    assert built(resume_all(Lake(spark, root), "another way to derive feeds")) == set(ALL) - {n for n in ALL if n.startswith("bronze_")}
    assert storage.read_mark(spark, plain.path("dim_date")) is None


def test_new_files_rebuild_what_rests_on_them(spark, lake, zone):
    root, files = storage.fresh_folder(spark, "run"), storage.fresh_folder(spark, "zone")
    landing.write_landing_csv(lake.feeds["hqla"].where("year(business_date) = 1995 AND month(business_date) = 1"), f"{files}/hqla", "hqla", "1995-02-01")

    def current():
        feeds = {d: landing.scan_landing(spark, f"{files if d == 'hqla' else zone}/{d}", d) for d in lakes.DATASETS}
        return Lake(spark, root, feeds)

    assert built(resume_all(current())) == set(ALL)
    rows = current().table("bronze_hqla").count()
    landing.write_landing_csv(lake.feeds["hqla"].where("year(business_date) = 1995 AND month(business_date) = 2"), f"{files}/hqla", "hqla", "1995-03-01")
    expected = resting_on("bronze_hqla")
    assert "dim_account" not in expected and "fact_collateral_risk" in expected
    assert built(resume_all(current())) == expected
    assert current().table("bronze_hqla").count() > rows
    # days that were replaced in place are not what the mark says
    silver = current().table("silver_balances")
    some = silver.select("business_date").limit(1)
    storage.overwrite_days(silver.limit(0), f"{root}/silver_balances", some)
    assert built(resume_all(current())) == {"silver_balances"}


def test_feed_marks_follow_the_files(spark, tmp_path):
    (tmp_path / "a [x] {y} %41 *").mkdir()
    file = tmp_path / "a [x] {y} %41 *" / "ä b.csv"
    file.write_text("n\n1\n")
    read = lambda: spark.read.schema("n int").option("recursiveFileLookup", True).csv(str(tmp_path))
    first = feed_mark(read())
    assert feed_mark(read()) == first
    os.utime(file, ns=(1, 10**18))
    second = feed_mark(read())
    (tmp_path / "c.csv").write_text("n\n2\n")
    third = feed_mark(read())
    assert len({first, second, third, feed_mark(read().selectExpr("n AS m")), feed_mark(spark.range(3))}) == 5


def test_inputs_are_what_the_builders_read(spark, zone):
    """Every table that a builder asks for is an input of its own or of an input, and it asks for each of its inputs."""
    stored = over(spark, zone, storage.fresh_folder(spark, "run"))
    assert "failed" not in states(run_all(stored)).values()

    class Watched(Lake):
        def table(self, name):
            with lock:
                asked.add(name)
            return super().table(name)

    lock, watched = threading.Lock(), Watched(spark, stored.root)
    for name, direct in INPUTS.items():
        above, todo = set(), list(direct)
        while todo:
            n = todo.pop()
            above.add(n)
            todo += INPUTS.get(n, [])
        asked = set()
        BUILDERS[name](watched)
        assert set(direct) <= asked <= above, name


def test_marks_depend_on_code_and_options(spark, zone, monkeypatch):
    feeds = over(spark, zone, "/nowhere")
    marks = table_marks(feeds)
    assert set(marks) == set(ALL) and len(set(marks.values())) == len(ALL)
    feeds.permissive = True
    assert not set(table_marks(feeds).values()) & set(marks.values())
    feeds.permissive = False
    assert table_marks(feeds) == marks
    monkeypatch.setattr(fingerprints, "code_version", lambda: "another")
    assert not set(table_marks(feeds).values()) & set(marks.values())
