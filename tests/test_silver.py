from ebbtide.operators import silver
from ebbtide.schemas import BRONZE

DAY = "2024-01-01"


def balance(key="A1", amount=10, load="2024-01-02", **more):
    return {"account_id": key, "business_date": DAY, "balance_eur": str(amount),
            "load_timestamp": load, "source_file": "f", **more}


def kept(df, column="account_id"):
    return sorted(str(r[0]) for r in df.select(column).collect())


def test_required_columns_and_zero_amounts(rows):
    df = rows(
        BRONZE["balances"], balance("zero", 0), balance("negative", -1),
        {**balance("no date"), "business_date": None}, {**balance("x"), "account_id": None},
        {**balance("no amount"), "balance_eur": None},
    )
    assert kept(silver.silver_balances(df)) == ["zero"]
    assert kept(silver.silver_balances(df, min_inclusive=False)) == []


def test_blank_key_and_missing_country_stay(rows):
    df = rows(BRONZE["balances"], balance("  "), balance("A2", country=None))
    out = silver.silver_balances(df)
    assert kept(out) == ["", "A2"]
    assert kept(out, "country") == ["None", "None"]


def test_older_valid_row_beats_newer_invalid_one(rows):
    df = rows(
        BRONZE["balances"], balance(amount=1, load="2024-01-02"),
        balance(amount=-1, load="2024-01-03"), balance(amount=2, load="2024-01-01"),
    )
    assert kept(silver.silver_balances(df), "balance_eur") == ["1.00"]


def test_padded_keys_are_one_key_but_tabs_are_kept(rows):
    df = rows(BRONZE["balances"], balance(" A1"), balance("A1 "), balance("A1\t"))
    assert kept(silver.silver_balances(df)) == ["A1", "A1\t"]


def test_ties_do_not_depend_on_partitioning(rows):
    df = rows(BRONZE["balances"], *[balance(amount=n, country=f"C{n}") for n in range(50)])
    found = {
        tuple(silver.silver_balances(df.repartition(n)).select("balance_eur", "country").first())
        for n in (1, 3, 7, 16)
    }
    assert len(found) == 1


def test_dedup_order_can_be_changed(rows):
    df = rows(
        BRONZE["balances"],
        balance(amount=1, load="2024-01-03", created_timestamp="2024-01-01"),
        balance(amount=2, load="2024-01-02", created_timestamp="2024-01-02"),
    )
    out = silver.silver_balances(df, newest_first=["created_timestamp"])
    assert kept(out, "balance_eur") == ["2.00"]


def test_hot_key_is_cut_before_the_shuffle(spark, rows):
    df = silver.dedup_balances(rows(BRONZE["balances"], balance()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and plan.index("Exchange hashpartitioning") < partial


def asset(key="H1", **more):
    return {"asset_id": key, "business_date": DAY, "market_value_eur": "5", "haircut_rate": "0.15",
            "hqla_level": "Level 2A", "load_timestamp": DAY, **more}


def test_hqla_domains(rows):
    df = rows(
        BRONZE["hqla"], asset("ok", hqla_level=" Level 1 "), asset("level", hqla_level="Level 3"),
        asset("high", haircut_rate="1.1"), asset("low", haircut_rate="-0.1"),
        asset("none", haircut_rate=None), asset("edge", haircut_rate="1"),
    )
    assert kept(silver.silver_hqla(df), "asset_id") == ["edge", "ok"]


def pledge(key="C1", **more):
    return {"collateral_id": key, "business_date": DAY, "gross_value_eur": "5",
            "haircut_percentage": "0.1", "loan_to_value_ratio": "0.5", "quality_rating": "a ",
            "load_timestamp": DAY, **more}


def test_collateral_domains_and_flags(rows):
    df = rows(
        BRONZE["collateral"], pledge("ok", insurance_status=" y"), pledge("rating", quality_rating="E"),
        pledge("ltv", loan_to_value_ratio="1.01"), pledge("no ltv", loan_to_value_ratio=None),
    )
    row, = silver.silver_collateral(df).collect()
    assert (row.collateral_id, row.quality_rating, row.insurance_status) == ("ok", "A", "Y")
