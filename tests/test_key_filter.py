"""Key checks of a new load against the check of all rows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.integrity import key_violations
from ebbtide.operators.key_filter import KeyFilter, added_violations


def frame(spark, keys):
    return spark.createDataFrame([(k, "x") for k in keys], "k long, other string")


def sums(*reports):
    rows = [r.first() for r in reports]
    return tuple(sum(r[c] for r in rows) for c in ("null_key_rows", "duplicate_key_rows"))


@pytest.mark.parametrize("blocks", [1, 64])
def test_reports_of_loads_add_up_to_the_full_one(spark, tmp_path, blocks):
    """With one block and many keys the filter is nearly full, so most new keys go to the exact join."""
    rng, held = random.Random(blocks), KeyFilter(spark, str(tmp_path / "keys"), "k", blocks=blocks)
    everything, reports = frame(spark, []), []
    for load in range(4):
        # NULLs, keys of this load twice, keys of earlier loads once, twice and thrice
        keys = [rng.choice([None, *range(-20_000, 20_000)]) for _ in range([0, 9_000, 9_000, 40][load])] + [None, 7, 7]
        new = frame(spark, keys)
        reports.append(added_violations(new, everything, held, "t"))
        assert reports[-1].schema == key_violations(new, "t", "k").schema
        everything = everything.unionByName(new)
        assert sums(*reports) == sums(key_violations(everything, "t", "k")), load
        held.add(new)
        if load == 2:
            held.add(new)
    assert added_violations(frame(spark, []), everything, held, "t").first()[2:] == (0, 0)


def test_a_filter_loses_no_key_and_lets_few_others_through(spark, tmp_path):
    held = KeyFilter(spark, str(tmp_path / "keys"), "k", blocks=32)  # 1,048,576 bits
    assert held.possible(frame(spark, [1, None])).isEmpty()
    held.add(spark.range(100_000).selectExpr("id * 3 AS k"))
    held.add(spark.range(10).selectExpr("id - 100 AS k"))
    there = spark.range(100_000).selectExpr("id * 3 AS k", "'y' AS bits", "1 AS block")
    found = held.possible(there)
    assert found.columns == there.columns and found.count() == 100_000
    assert held.possible(spark.range(10).selectExpr("CAST(id - 100 AS INT) AS k")).count() == 10
    assert held.possible(spark.range(100_000).selectExpr("id * 3 + 1 AS k")).count() < 2_500
    plan = held.possible(there)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan
    wide = KeyFilter(spark, str(tmp_path / "keys"), "k", blocks=1 << 20)
    assert "ResolvedHint" not in wide.possible(there)._jdf.queryExecution().analyzed().toString()


def test_text_keys(spark, tmp_path):
    held = KeyFilter(spark, str(tmp_path / "keys"), "k", T.StringType())
    stored = spark.createDataFrame([("a",), ("",), ("é",), (None,)], "k string")
    held.add(stored)
    new = spark.createDataFrame([("é",), ("b",), (None,), ("b",), ("",)], "k string")
    assert added_violations(new, stored, held, "t").first()[2:] == (1, 6)


def test_a_load_of_new_keys_reads_no_stored_row(spark, tmp_path):
    held = KeyFilter(spark, str(tmp_path / "keys"), "k")
    held.add(frame(spark, range(1000)))
    stored = frame(spark, range(1000)).withColumn("k", F.raise_error(F.lit("read")).cast("long"))
    assert added_violations(frame(spark, [2000, 2001, 2001]), stored, held, "t").first()[2:] == (0, 2)
    with pytest.raises(Exception, match="read"):
        added_violations(frame(spark, [5]), stored, held, "t").collect()
