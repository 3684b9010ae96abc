"""Gold dimensions, derived from the three silver tables."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.calendar import calendar_attributes
from ebbtide.functions.rules import country_profile, subsidiary_type
from ebbtide.operators.conform import conform
from ebbtide.operators.keys import surrogate_key_dense
from ebbtide.schemas import GOLD
from ebbtide.sources.storage import materialise

ACCOUNT_ATTRIBUTES = ["account_type", "customer_segment", "currency", "country", "subsidiary"]


def distinct_values(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Distinct combinations over all frames; NULLs are one value."""
    return reduce(DataFrame.unionAll, [f.select(*columns) for f in frames]).distinct()


def dim_date(frames: Sequence[DataFrame]) -> DataFrame:
    days = distinct_values(frames, ["business_date"])
    return conform(
        days.select([c.alias(n) for n, c in calendar_attributes(F.col("business_date")).items()]),
        GOLD["dim_date"],
    )


def dim_country(frames: Sequence[DataFrame]) -> DataFrame:
    keyed = surrogate_key_dense(distinct_values(frames, ["country"]), "country_key", ["country"])
    named = keyed.withColumnRenamed("country", "country_name")
    return conform(
        named.withColumns(country_profile(F.col("country_name"))), GOLD["dim_country"]
    )


def dim_subsidiary(frames: Sequence[DataFrame]) -> DataFrame:
    pairs = distinct_values(frames, ["country", "subsidiary"])
    keyed = surrogate_key_dense(pairs, "subsidiary_key", ["country", "subsidiary"])
    named = keyed.withColumnRenamed("subsidiary", "subsidiary_name")
    return conform(
        named.withColumn("subsidiary_type", subsidiary_type(F.col("subsidiary_name"))),
        GOLD["dim_subsidiary"],
    )


def dim_account(balances: DataFrame) -> DataFrame:
    """One row per combination of attributes an account ever had.  All are
    current, and the effective date is the last day the combination was seen."""
    seen = balances.groupBy("account_id", *ACCOUNT_ATTRIBUTES).agg(
        F.max("business_date").alias("effective_date")
    )
    keyed = surrogate_key_dense(seen, "account_key", ["account_id", "effective_date"])
    return conform(
        keyed.withColumns({"end_date": F.lit(None), "is_current": F.lit("Y")}),
        GOLD["dim_account"],
    )


def dim_account_scd2(balances: DataFrame) -> DataFrame:
    """Type 2 history: a row per run of unchanged attributes, from its first day to
    the day before the next one.  Silver has one row per account and day, so an
    account's group is never larger than the number of days."""
    by_day = Window.partitionBy("account_id").orderBy("business_date")
    state = F.struct(*ACCOUNT_ATTRIBUTES)
    changed = ~state.eqNullSafe(F.lag(state).over(by_day))
    starts = (
        balances.withColumn("_changed", changed).filter("_changed")
        .withColumnRenamed("business_date", "effective_date")
    )
    next_start = F.lead("effective_date").over(
        Window.partitionBy("account_id").orderBy("effective_date")
    )
    history = starts.select(
        "account_id", *ACCOUNT_ATTRIBUTES, "effective_date",
        F.date_sub(next_start, 1).alias("end_date"),
        F.when(next_start.isNull(), "Y").otherwise("N").alias("is_current"),
    )
    keyed = surrogate_key_dense(history, "account_key", ["account_id", "effective_date"])
    return conform(keyed, GOLD["dim_account"])


def account_history(balances: DataFrame) -> DataFrame:
    """The versions of `dim_account_scd2` without keys, with `last_seen`, the last day that shows each: what `merge_account_history`
    carries on."""
    by_day = Window.partitionBy("account_id").orderBy("business_date")
    state = F.struct(*ACCOUNT_ATTRIBUTES)
    changed = balances.withColumn("_changed", (~state.eqNullSafe(F.lag(state).over(by_day))).cast("int"))
    runs = (
        changed.withColumn("_run", F.sum("_changed").over(by_day)).groupBy("account_id", "_run", *ACCOUNT_ATTRIBUTES)
        .agg(F.min("business_date").alias("effective_date"), F.max("business_date").alias("last_seen"))
    )
    next_start = F.lead("effective_date").over(Window.partitionBy("account_id").orderBy("effective_date"))
    return runs.select(
        "account_id", *ACCOUNT_ATTRIBUTES, "effective_date", "last_seen", F.date_sub(next_start, 1).alias("end_date"),
        F.when(next_start.isNull(), "Y").otherwise("N").alias("is_current"),
    )


def merge_account_history(history: DataFrame, balances: DataFrame, days: DataFrame) -> DataFrame:
    """`history` after the days in `days` (column `business_date`) were loaded or replaced in `balances`, in any order of days: what
    `account_history` gives for all of `balances`.

    Versions whose successor starts before the first touched day stay as they are.  An open version is told by its first and last
    day, unless a touched day contradicts it (another state inside it, or no row any more at one of its ends); only then are its
    days read from `balances` again.  The set of days goes through the driver, a calendar; accounts and days are never NULL in silver."""
    touched = sorted(row[0] for row in days.select("business_date").distinct().collect() if row[0] is not None)
    if not touched:
        return history
    is_open = F.coalesce(F.col("end_date") >= F.date_sub(F.lit(touched[0]), 1), F.lit(True))
    columns = ["account_id", *ACCOUNT_ATTRIBUTES, "business_date"]
    fresh = balances.where(F.col("business_date").isin(touched)).select(columns)
    seen = fresh.select(F.col("account_id").alias("_account"), F.struct(*ACCOUNT_ATTRIBUTES).alias("_state"), F.col("business_date").alias("_day"))
    version = ["account_id", *ACCOUNT_ATTRIBUTES, "effective_date", "last_seen"]
    shown = history.where(is_open).select(version).join(
        seen, F.expr("account_id = _account AND _day BETWEEN effective_date AND last_seen"), "left"
    ).groupBy(version).agg(
        F.max(~F.struct(*ACCOUNT_ATTRIBUTES).eqNullSafe(F.col("_state")) & F.col("_day").isNotNull()).alias("_other"),
        *(F.coalesce(F.max(F.col("_day") == F.col(end)), F.lit(False)).alias(f"_{end}") for end in ("effective_date", "last_seen")),
    )
    lost = [F.col(end).isin(touched) & ~F.col(f"_{end}") for end in ("effective_date", "last_seen")]
    judged = materialise(shown.select(*version, (F.col("_other") | lost[0] | lost[1]).alias("_contradicted")), "versions")
    ends = F.explode(F.array_distinct(F.array("effective_date", "last_seen"))).alias("business_date")
    points = judged.where("NOT _contradicted").select("account_id", *ACCOUNT_ATTRIBUTES, ends).unionByName(fresh)
    again = judged.where("_contradicted").select(F.col("account_id").alias("_account"), "effective_date", "last_seen")
    first, last = again.agg(F.min("effective_date"), F.max("last_seen")).first()
    if first is not None:
        within = balances.where(F.col("business_date").between(first, last)).select(columns)
        points = points.unionByName(within.join(
            again, F.expr("account_id = _account AND business_date BETWEEN effective_date AND last_seen"), "left_semi"
        ))
    return history.where(~is_open).unionByName(account_history(points))


def dim_account_of_history(history: DataFrame) -> DataFrame:
    """`dim_account_scd2` of stored versions."""
    keyed = surrogate_key_dense(history.drop("last_seen"), "account_key", ["account_id", "effective_date"])
    return conform(keyed, GOLD["dim_account"])
