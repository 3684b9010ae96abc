"""Facts from stored partial sums against full builds."""

import random
from collections import Counter
from functools import reduce
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import facts
from ebbtide.operators.conform import conform
from ebbtide.operators.partials import FactPartials, merge_partials, partial_sums, with_averages
from ebbtide.schemas import FACTS, METRICS, SILVER


def bag(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


def full(rows, name):
    return facts.aggregated(rows, facts.POSITIONS[name].measures())


@pytest.mark.parametrize("name", list(facts.POSITIONS))
def test_merged_measures_are_those_of_all_rows(lake, name):
    """Types too; the merged groups cross days."""
    rows, measures = lake.table(f"silver_{facts.POSITIONS[name].dataset}"), facts.POSITIONS[name].measures()
    held = partial_sums(rows, measures)
    same = with_averages(held, measures)
    assert dict(same.dtypes) == dict(full(rows, name).dtypes) and bag(same) == bag(full(rows, name))
    merged = merge_partials(held, measures, measures.by)
    expected = rows.groupBy(*measures.by).agg(*[F.avg(v).alias(n) for n, v in measures.averages.items()])
    assert bag(merged.select(expected.columns)) == bag(expected)


def test_averages_round_as_those_of_rows(spark, rows):
    """Halves of the last digit, negative sums, large sums, groups in which no row has the value."""
    rng, records = random.Random(5), []
    for group in range(40):
        for k in range(rng.randrange(1, 9)):
            large = f"{rng.choice('- ')}{rng.randrange(10**15)}.{rng.randrange(100):02d}".strip()
            value = rng.choice([large, "0.01", "-0.01", "0.05", None])
            records.append({"business_date": "2024-01-01", "country": "A", "subsidiary": str(group), "account_id": str(k),
                            "balance_eur": None if group == 7 else value, "weighted_outflow_rate": rng.choice(["0.0001", "0.3333", None])})
    balances = rows(SILVER["balances"], *records)
    measures = facts.funding_measures()
    assert bag(with_averages(partial_sums(balances, measures), measures)) == bag(facts.funding_aggregated(balances))
    none = balances.limit(0)
    assert merge_partials(partial_sums(none, measures), measures, ["country"]).isEmpty()


def test_facts_equal_a_full_build_after_any_updates(spark, lake, tmp_path):
    """Days arrive out of order, without some rows first, and one goes again."""
    held = FactPartials(spark, str(tmp_path / "partials"))
    silver = lake.silver()
    assert held.metrics().isEmpty() and held.partials("fact_hqla_position").isEmpty()
    held.update(silver, silver["hqla"].limit(0).select("business_date"))
    assert held.metrics().isEmpty()
    year = F.year("business_date")
    whole = {d: df.where(year.isin(1995, 1996)) for d, df in silver.items()}
    short = {d: df.where((year == 1996) & (F.month("business_date") != 5)) for d, df in silver.items()}
    days = lambda frames: reduce(lambda a, b: a.union(b), [df.select("business_date") for df in frames.values()])
    held.update({d: df.where("country <> 'Italy'") for d, df in short.items()}, days(short))
    held.update(whole, days(whole))
    gone = whole["balances"].agg(F.max("business_date")).first()[0]
    left = {d: df.where(F.col("business_date") != gone) for d, df in whole.items()}
    held.update(left, spark.createDataFrame([(gone,), (None,)], "business_date date"))
    dims, stamp = held.dims(), F.lit("2024-01-01 00:00:00").cast("timestamp")
    metrics = conform(facts.combined_metrics(**left, accounts_unique=True), METRICS)
    assert bag(held.metrics()) == bag(metrics)
    for name in FACTS:
        if name in facts.POSITIONS:
            position = facts.POSITIONS[name]
            expected = facts.position_fact(name, full(left[position.dataset], name), metrics, dims, stamp)
        else:
            expected = facts.liquidity_fact(metrics, dims, stamp)
        assert bag(held.fact(name, dims, stamp)) == bag(expected), name


def test_touched_days_alone_are_read_and_written(spark, lake, tmp_path):
    """Rows of other days fail the update if they are read."""
    held, silver = FactPartials(spark, str(tmp_path / "partials")), lake.silver()
    some = silver["hqla"].where("year(business_date) = 1995").select("business_date").distinct().orderBy("business_date").limit(3)
    held.update(silver, some)
    before = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet")}
    last = some.agg(F.max("business_date")).first()[0]
    columns = {d: df.columns for d, df in silver.items()}
    guarded = {
        d: df.withColumn("country", F.when(F.col("business_date") == last, F.col("country")).otherwise(F.raise_error(F.lit("read again"))))
        .select(columns[d]) for d, df in silver.items()
    }
    held.update(guarded, some.where(F.col("business_date") == last))
    after = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet")}
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    assert changed and all(f"business_date={last}" in str(p) for p in changed)
    assert held.metrics().select("business_date").distinct().count() == 3
