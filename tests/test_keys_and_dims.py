import datetime as dt
import random
from itertools import groupby

from pyspark.sql import Window
from pyspark.sql import functions as F

from ebbtide.functions.calendar import calendar_attributes
from ebbtide.operators import dimensions
from ebbtide.operators.keys import dense_key
from ebbtide.schemas import SILVER


def test_dense_key_equals_global_row_number(spark):
    random.seed(7)
    # a third of the rows share the leading value
    data = {
        (random.choice(["hot", None, "a", "b", "c"]) if n % 3 else "hot", n) for n in range(5000)
    }
    df = spark.createDataFrame(sorted(data, key=str), "a string, b int").repartition(6)
    keyed = dense_key(df, "key", ["a", "b"])
    expected = df.withColumn("key", F.row_number().over(Window.orderBy("a", "b")).cast("long"))
    assert keyed.count() == 5000
    assert keyed.select("a", "b", "key").exceptAll(expected).isEmpty()
    plan = keyed._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "Exchange SinglePartition" in line]
    # one task sees only a row per partition of the sort, once they are counted
    assert len(below) == 1 and "HashAggregate" in below[0] and "count(1)" in below[0]


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.createDataFrame([], "a int"), "key", ["a"]).count() == 0


def test_calendar(spark):
    days = ["2024-06-30", "2024-02-29", "2023-12-31", "2024-05-06"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    out = df.select([c.alias(n) for n, c in calendar_attributes(F.col("d")).items()])
    found = {str(r.business_date): r for r in out.collect()}
    sunday = found["2024-06-30"]
    assert (sunday.date_key, sunday.day_of_week, sunday.day_name) == (20240630, 1, "Sunday")
    assert (sunday.is_weekend, sunday.is_month_end, sunday.is_quarter_end, sunday.is_year_end) == tuple("YYYN")
    assert (found["2024-02-29"].is_month_end, found["2024-02-29"].is_quarter_end) == ("Y", "N")
    assert (found["2023-12-31"].is_year_end, found["2023-12-31"].fiscal_quarter) == ("Y", 4)
    monday = found["2024-05-06"]
    assert (monday.day_of_week, monday.is_weekend, monday.month_name, monday.week_of_year) == (2, "N", "May", 19)


def test_missing_country_comes_first_with_defaults(spark):
    df = spark.createDataFrame([("Italy",), (None,), ("Atlantis",)], "country string")
    out = dimensions.dim_country([df, df]).orderBy("country_key").collect()
    assert [r.country_name for r in out] == [None, "Atlantis", "Italy"]
    assert out[0][2:] == out[1][2:] == ("UNK", "Other", "EUR", "N", "Unknown")
    assert out[2][2:] == ("ITA", "Southern Europe", "EUR", "Y", "High")


def test_subsidiary_rules_in_order(spark):
    names = {
        "Retail Corporate": "Retail Banking", "SME Trading": "Corporate Banking",
        "Trading Holdings": "Investment Banking", "Wealth Digital": "Private Banking",
        "Digital": "Digital Banking", "digital": "Other", "Nordic": "Other",
    }
    df = spark.createDataFrame([("X", n) for n in names], "country string, subsidiary string")
    out = dimensions.dim_subsidiary([df]).collect()
    assert {r.subsidiary_name: r.subsidiary_type for r in out} == names


def test_account_history_against_brute_force(rows):
    random.seed(3)
    records = [
        {"account_id": f"A{a}", "business_date": f"2024-01-{d:02}",
         "country": random.choice([None, "Italy", "Spain"]), "currency": "EUR"}
        for a in range(5) for d in range(1, 29) if random.random() < 0.7
    ]
    expected = set()
    for account, days in groupby(records, key=lambda r: r["account_id"]):
        runs = [
            (country, next(run)["business_date"])
            for country, run in groupby(days, key=lambda r: r["country"])
        ]
        for i, (country, start) in enumerate(runs):
            end = None
            if i + 1 < len(runs):
                end = dt.date.fromisoformat(runs[i + 1][1]) - dt.timedelta(days=1)
            expected.add((account, country, dt.date.fromisoformat(start), end, "N" if end else "Y"))
    out = dimensions.dim_account_scd2(rows(SILVER["balances"], *records)).collect()
    assert len(out) == len(expected)
    assert expected == {
        (r.account_id, r.country, r.effective_date, r.end_date, r.is_current) for r in out
    }
