"""Every operator as a query over whole tables: `name -> (spark, folder) -> DataFrame`."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import ratios, rules
from ebbtide.functions.calendar import date_key, reporting_calendar
from ebbtide.operators import (
    bronze, dimensions, distinct_counts, facts, integrity, key_filter, keys, partials, profiling, reports, silver,
)
from ebbtide.operators.conform import conform
from ebbtide.operators.dimensions import distinct_values
from ebbtide.plans import run
from ebbtide.plans.fingerprints import table_marks
from ebbtide.plans.lake import DATASETS, Lake
from ebbtide.schemas import BRONZE, FACTS, GOLD, LANDING, PRIMARY_KEYS
from ebbtide.sources import landing, storage
from ebbtide.sources.feed import raw_feeds
from ebbtide.streaming import landing_stream

# One fixed load time, so that results can be compared.
LOAD_TIME = "2025-01-01 00:00:00"
# Where a query takes the rows in two deliveries, the second starts on this day.
FIRST_DELIVERY = "1998-01-01"

_lakes: dict[tuple[str, str], Lake] = {}


def new_lake(spark: SparkSession, folder: str) -> Lake:
    """Empty lake over the tables in `folder`.  The derived rows carry their own load
    time, which decides between versions of a key."""
    return Lake(
        spark, storage.fresh_folder(spark, "lake"), raw_feeds(spark, folder),
        bronze_time=F.col("load_timestamp"), load_time=_load_time(),
    )


def lake_of(spark: SparkSession, folder: str) -> Lake:
    """The application's lake over `folder`: tables are built when first needed."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _lakes:
        _lakes[key] = new_lake(spark, folder)
    return _lakes[key]


def _load_time():
    return F.lit(LOAD_TIME).cast("timestamp")


def _typed(df: DataFrame, table: str) -> DataFrame:
    """Columns that table `table` also has, in the types it declares."""
    declared = {f.name: f.dataType for f in GOLD[table]}
    return df.select([F.col(c).cast(declared[c]) if c in declared else c for c in df.columns])


QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def _add(name: str, function: Callable[[Lake], DataFrame]) -> None:
    QUERIES[name] = function


# ---- landing files and stored tables --------------------------------------------------

def _exported(lake: Lake, dataset: str) -> str:
    base = storage.fresh_folder(lake.spark, "landing")
    return landing.write_landing_history(lake.feeds[dataset], base, dataset)


def _rows_per_folder(scan: DataFrame) -> DataFrame:
    day = F.regexp_extract("source_file", r"/snapshot=(\d{4}-\d{2}-\d{2})/[^/]+\.csv(?:\.gz)?$", 1)
    return scan.groupBy(day.alias("folder_date"), "business_date").agg(
        F.count("*").alias("record_count")
    )


for _dataset in DATASETS:
    _add(
        f"scan_landing_{_dataset}",
        lambda k, d=_dataset: landing.scan_landing(k.spark, _exported(k, d), d)
        .select(LANDING[d].names),
    )


@_query
def with_source_file(k):
    return _rows_per_folder(landing.scan_landing_hqla(k.spark, _exported(k, "hqla")))


@_query
def with_load_timestamp(k):
    stamped = landing.with_load_timestamp(k.feeds["balances"], _load_time(), "loaded_at")
    return stamped.groupBy("loaded_at").agg(F.count("*").alias("record_count"))


@_query
def write_landing_csv(k):
    """One snapshot file folder holding the whole table."""
    base = storage.fresh_folder(k.spark, "landing")
    landing.write_landing_csv(k.feeds["collateral"], base, "collateral", LOAD_TIME[:10])
    scan = landing.scan_landing_collateral(k.spark, base)
    folder = F.regexp_extract("source_file", r"/([^/]+)/(collateral_[^/]+\.csv)/[^/]+$", 2)
    return scan.groupBy(folder.alias("snapshot_file"), "business_date").agg(
        F.count("*").alias("record_count")
    )


@_query
def write_table(k):
    path = storage.fresh_folder(k.spark, "table")
    return storage.write_table(k.table("silver_balances"), path, ["business_date"])


@_query
def overwrite_table(k):
    """Replace the rows of a catalog table from a frame in another order, with a column too many;
    the entry goes again, its files stay."""
    path = storage.fresh_folder(k.spark, "table")
    name = "collateral_" + path.rsplit("-", 1)[1]
    rows = k.table("bronze_collateral")
    storage.save_table(rows, name, path)
    shuffled = silver.trim_strings(rows).select(*reversed(rows.columns), F.lit(1).alias("remark"))
    storage.overwrite_table(shuffled, name)
    k.spark.sql(f"DROP TABLE {name}")
    return storage.read_table(k.spark, path, rows.schema)


@_query
def describe_table(k):
    """Columns of a stored table that is entered in the catalog where it lies, and in how many rows
    each is filled."""
    k.table("bronze_hqla")
    name = "hqla_" + storage.fresh_folder(k.spark, "table").rsplit("-", 1)[1]
    storage.register_table(k.spark, name, k.path("bronze_hqla"), BRONZE["hqla"])
    columns = storage.describe_table(k.spark, name).filter("comment <> ''").select("col_name", "data_type")
    k.spark.sql(f"DROP TABLE {name}")
    names = BRONZE["hqla"].names
    filled = k.table("bronze_hqla").agg(*[F.count(c).alias(c) for c in names]).unpivot(
        [], names, "col_name", "filled_rows"
    )
    return columns.join(filled, "col_name")


@_query
def load_new_files(k):
    """The feed arrives in two deliveries, each loaded by a run of its own; a third run finds nothing new."""
    base, table, ledger = (storage.fresh_folder(k.spark, n) for n in ("landing", "bronze", "ledger"))
    feed = k.feeds["balances"]
    early = F.col("business_date") < FIRST_DELIVERY
    zone = f"{base}/zone"
    for number, part in enumerate((feed.where(early), feed.where(~F.coalesce(early, F.lit(False))))):
        landing.write_landing_history(part, f"{zone}/{number}", "balances")
        landing_stream.load_new_files(k.spark, zone, "balances", table, ledger, _load_time())
    loaded = landing_stream.load_new_files(k.spark, zone, "balances", table, ledger, _load_time())
    return loaded.drop("source_file", "load_timestamp")


@_query
def overwrite_days(k):
    """A late delivery replaces the days that it touches in the stored silver table; the others stay as they are."""
    path = storage.fresh_folder(k.spark, "table")
    bronze_rows = k.table("bronze_balances")
    late = F.coalesce((F.month("business_date") == 3) & (F.substring("source_file", -5, 1) == "7"), F.lit(False))
    storage.write_table(silver.silver_balances(bronze_rows.where(~late), _load_time()), path, ["business_date"])
    days = bronze_rows.where(late).select("business_date")
    return storage.overwrite_days(silver.silver_of_days(bronze_rows, days, "balances", _load_time()), path, days)


@_query
def registered_keys(k):
    """Keys of accounts and their places: those of the first delivery come first, later ones get the numbers after them, and
    a third run changes nothing."""
    columns = ["account_id", "country"]
    rows = k.table("silver_balances")
    members = rows.select(columns).schema
    registry = keys.KeyRegistry(k.spark, storage.fresh_folder(k.spark, "registry"), members, "account_key")
    registry.extend(rows.where(F.col("business_date") < FIRST_DELIVERY))
    registry.extend(rows)
    return registry.extend(rows.where(F.col("business_date") >= FIRST_DELIVERY))


@_query
def merge_account_history(k):
    """The history of accounts by increments: a first delivery without some rows, then the days with those late rows, then the days
    of the second delivery; each load reads the stored versions and its own days."""
    rows = k.table("silver_balances")
    second = F.col("business_date") >= FIRST_DELIVERY
    late = (F.month("business_date") == 3) & F.col("account_id").endswith("7")
    stored = storage.materialise(dimensions.account_history(rows.where(~second & ~late)), "history")
    for there, new in ((rows.where(~second), ~second & late), (rows, second)):
        days = rows.where(new).select("business_date")
        stored = storage.materialise(dimensions.merge_account_history(stored, there, days), "history")
    return dimensions.dim_account_of_history(stored)


@_query
def merged_account_counts(k):
    """Different accounts per country and month, from bitmaps of single days: those of the second delivery are added to the stored
    ones of the first, and no day is read twice."""
    rows = k.table("silver_balances")
    path, by = storage.fresh_folder(k.spark, "bitmaps"), ["business_date", "country"]
    members = rows.select("account_id").schema
    registry = keys.KeyRegistry(k.spark, storage.fresh_folder(k.spark, "registry"), members, "account_number")
    first = F.col("business_date") < FIRST_DELIVERY
    registry.extend(rows.where(first))
    storage.write_table(distinct_counts.member_bitmaps(rows.where(first), registry, by), path, ["business_date"])
    registry.extend(rows.where(~first))
    added = distinct_counts.member_bitmaps(rows.where(~first), registry, by)
    stored = storage.overwrite_days(added, path, rows.where(~first))
    monthly = stored.withColumn("month", F.trunc("business_date", "month"))
    return distinct_counts.count_members(monthly, ["country", "month"], "account_count")


_partials: dict[str, partials.FactPartials] = {}


def _partials_of(k: Lake) -> partials.FactPartials:
    """Partial sums of the lake's silver, in two deliveries: a first without some late rows, then the later days and the days that the
    late rows replace."""
    if k.root not in _partials:
        store = partials.FactPartials(k.spark, storage.fresh_folder(k.spark, "partials"))
        rows, second = k.silver(), F.col("business_date") >= FIRST_DELIVERY
        keys_of = {"balances": "account_id", "hqla": "asset_id", "collateral": "collateral_id"}
        late = {d: (F.month("business_date") == 3) & F.col(key).endswith("7") for d, key in keys_of.items()}
        days = lambda some: distinct_values([df.where(some[d]) for d, df in rows.items()], ["business_date"])
        store.update({d: df.where(~late[d]) for d, df in rows.items()}, days({d: ~second for d in rows}))
        store.update(rows, days({d: second | late[d] for d in rows}))
        _partials[k.root] = store
    return _partials[k.root]


for _fact in FACTS:
    _add(f"merged_{_fact}", lambda k, f=_fact: _partials_of(k).fact(f, _partials_of(k).dims(), _load_time()))


def _monthly(k: Lake, fact: str) -> DataFrame:
    """Measures of a position fact per country and month, averages over the rows of all days."""
    held = _partials_of(k).partials(fact).withColumn("month", F.trunc("business_date", "month"))
    measures = facts.POSITIONS[fact].measures()
    return _typed(partials.merge_partials(held, measures, ["country", "month"]), fact)


_add("monthly_hqla_position", lambda k: _monthly(k, "fact_hqla_position"))
_add("monthly_funding_stability", lambda k: _monthly(k, "fact_funding_stability"))
_add("monthly_collateral_risk", lambda k: _monthly(k, "fact_collateral_risk"))

# ---- bronze ---------------------------------------------------------------------------

_add("bronze_balances", lambda k: bronze.bronze_balances(k.feeds["balances"], k.bronze_time))
_add("bronze_hqla", lambda k: bronze.bronze_hqla(k.feeds["hqla"], k.bronze_time))
_add("bronze_collateral", lambda k: bronze.bronze_collateral(k.feeds["collateral"], k.bronze_time))
_add("bronze_summary", lambda k: profiling.bronze_summary(k.bronze()))
_add("bronze_record_counts", lambda k: profiling.bronze_record_counts(k.bronze()))

# ---- silver ---------------------------------------------------------------------------

_BALANCES, _HQLA, _COLLATERAL = (
    lambda k: k.table("bronze_balances"),
    lambda k: k.table("bronze_hqla"),
    lambda k: k.table("bronze_collateral"),
)
_add("silver_balances", lambda k: silver.silver_balances(_BALANCES(k), _load_time()))
_add("silver_hqla", lambda k: silver.silver_hqla(_HQLA(k), _load_time()))
_add("silver_collateral", lambda k: silver.silver_collateral(_COLLATERAL(k), _load_time()))
_add("filter_required_balances", lambda k: silver.filter_required_balances(_BALANCES(k)))
_add("filter_valid_hqla", lambda k: silver.filter_valid_hqla(_HQLA(k)))
_add("filter_valid_collateral", lambda k: silver.filter_valid_collateral(_COLLATERAL(k)))
_add("trim_strings", lambda k: silver.trim_strings(_BALANCES(k)))
_add("trim_strings_hqla", lambda k: silver.trim_strings(_HQLA(k)))
_add("trim_strings_collateral", lambda k: silver.trim_strings(_COLLATERAL(k)))
_add("normalise_flags", lambda k: silver.normalise_flags(_BALANCES(k), silver.FLAGS["balances"]))
_add("normalise_flags_hqla", lambda k: silver.normalise_flags(_HQLA(k), silver.FLAGS["hqla"]))
_add(
    "normalise_flags_collateral",
    lambda k: silver.normalise_flags(_COLLATERAL(k), silver.FLAGS["collateral"]),
)
_add("dedup_balances", lambda k: silver.dedup_balances(_BALANCES(k)))
_add("dedup_hqla", lambda k: silver.dedup_hqla(_HQLA(k)))
_add("dedup_collateral", lambda k: silver.dedup_collateral(_COLLATERAL(k)))
_add(
    "silver_vs_bronze_summary",
    lambda k: profiling.silver_vs_bronze_summary(k.bronze(), k.silver()),
)
_add("silver_flag_distribution", lambda k: profiling.silver_flag_distribution(k.silver()))
_add(
    "silver_record_counts",
    lambda k: profiling.silver_record_counts(
        {f"{name}_cleaned": df for name, df in k.silver().items()}
    ),
)

# ---- dimensions -----------------------------------------------------------------------

_add("dim_date", lambda k: dimensions.dim_date(list(k.silver().values())))
_add("dim_country", lambda k: dimensions.dim_country(list(k.silver().values())))
_add("dim_subsidiary", lambda k: dimensions.dim_subsidiary(list(k.silver().values())))
_add("dim_account", lambda k: dimensions.dim_account(k.table("silver_balances")))
_add("dim_account_scd2", lambda k: dimensions.dim_account_scd2(k.table("silver_balances")))


@_query
def surrogate_key_dense(k):
    columns = ["country", "subsidiary", "account_type", "customer_segment"]
    products = dimensions.distinct_values([k.table("silver_balances")], columns)
    return keys.surrogate_key_dense(products, "product_key", columns)


def _date_keys(k: Lake) -> DataFrame:
    days = dimensions.distinct_values(list(k.silver().values()), ["business_date"])
    return days.select("business_date", date_key(F.col("business_date")).alias("date_key"))


_add("date_key", _date_keys)

# ---- facts ----------------------------------------------------------------------------

_LIQUIDITY = "fact_intraday_liquidity"


def _metrics(k: Lake) -> DataFrame:
    return k.table("liquidity_metrics")


def _ratio_inputs():
    return F.col("total_hqla_eligible_eur"), F.col("weighted_outflow_amount")


_add("balance_metrics", lambda k: _typed(facts.balance_metrics(k.table("silver_balances")), _LIQUIDITY))
_add("hqla_metrics", lambda k: _typed(facts.hqla_metrics(k.table("silver_hqla")), _LIQUIDITY))
_add(
    "collateral_metrics",
    lambda k: _typed(facts.collateral_metrics(k.table("silver_collateral")), _LIQUIDITY),
)
_add("combined_metrics", lambda k: _typed(facts.combined_metrics(**k.silver()), _LIQUIDITY))
_add("lcr_ratio", lambda k: _typed(_metrics(k).select(
    *facts.GRAIN, ratios.lcr_ratio(*_ratio_inputs()).alias("liquidity_coverage_ratio")
), _LIQUIDITY))
_add("lcr_surplus_deficit", lambda k: _typed(_metrics(k).select(
    *facts.GRAIN, ratios.lcr_surplus_deficit(*_ratio_inputs()).alias("lcr_surplus_deficit_eur")
), _LIQUIDITY))
_add("lcr_status", lambda k: _metrics(k).select(
    *facts.GRAIN, ratios.lcr_status(*_ratio_inputs()).alias("lcr_status")
))
_add(_LIQUIDITY, lambda k: facts.fact_intraday_liquidity(
    **k.silver(), dims=k.dims(), load_time=_load_time(), accounts_unique=True
))
_add("dim_lookup", lambda k: facts.dim_lookup(
    _metrics(k).select(facts.GRAIN), k.dims()
).select(*facts.GRAIN, *facts.GRAIN_KEYS))
_add("surrogate_key_fact", lambda k: keys.surrogate_key_fact(
    _metrics(k).select(facts.GRAIN), "row_key", facts.GRAIN
))

_add("hqla_aggregated", lambda k: _typed(
    facts.hqla_aggregated(k.table("silver_hqla")), "fact_hqla_position"))
_add("hqla_concentration", lambda k: _typed(
    facts.hqla_concentration(k.table("silver_hqla"), _metrics(k)), "fact_hqla_position"
).select(*facts.GRAIN, "hqla_level", "asset_type", "credit_rating", "concentration_percentage"))
_add("fact_hqla_position", lambda k: facts.fact_hqla_position(
    k.table("silver_hqla"), _metrics(k), k.dims(), _load_time()))

_FUNDING = ["maturity_bucket", "customer_segment", "account_type"]
_add("funding_aggregated", lambda k: _typed(
    facts.funding_aggregated(k.table("silver_balances")), "fact_funding_stability"))
_add("inactive_accounts", lambda k: _typed(
    k.table("silver_balances").groupBy(*facts.GRAIN).agg(*facts.inactive_sums()),
    "fact_funding_stability"))
_add("stable_funding_ratio", lambda k: _typed(
    facts.with_stable_funding_ratio(facts.funding_aggregated(k.table("silver_balances")))
    .select(*facts.GRAIN, *_FUNDING, "stable_funding_ratio"),
    "fact_funding_stability"))
_add("funding_concentration", lambda k: _typed(
    facts.funding_concentration(k.table("silver_balances"), _metrics(k)), "fact_funding_stability"
).select(*facts.GRAIN, *_FUNDING, "concentration_percentage"))
_add("fact_funding_stability", lambda k: facts.fact_funding_stability(
    k.table("silver_balances"), _metrics(k), k.dims(), _load_time()))

_PLEDGED = ["collateral_type", "quality_rating", "collateral_status"]
_add("collateral_aggregated", lambda k: _typed(
    facts.collateral_aggregated(k.table("silver_collateral")), "fact_collateral_risk"))
_add("overdue_reviews", lambda k: _typed(
    k.table("silver_collateral").groupBy(*facts.GRAIN).agg(*facts.overdue_sums()),
    "fact_collateral_risk"))
_add("quality_score", lambda k: _typed(
    k.table("silver_collateral").groupBy(*facts.GRAIN)
    .agg(F.avg(rules.quality_score(F.col("quality_rating"))).alias("quality_score")),
    "fact_collateral_risk"))
_add("collateral_concentration", lambda k: _typed(
    facts.collateral_concentration(k.table("silver_collateral"), _metrics(k)), "fact_collateral_risk"
).select(*facts.GRAIN, *_PLEDGED, "concentration_percentage"))
_add("fact_collateral_risk", lambda k: facts.fact_collateral_risk(
    k.table("silver_collateral"), _metrics(k), k.dims(), _load_time()))

# ---- checks ---------------------------------------------------------------------------

_add("gold_summary", lambda k: profiling.gold_summary(k.gold()))
_add("gold_summary_short", lambda k: profiling.gold_summary_short(k.gold()))
_add("pk_violations", lambda k: integrity.pk_violations(k.gold()))
_add("fk_orphans", lambda k: integrity.fk_orphans(k.gold()))
_add("haircut_by_level_check", lambda k: integrity.haircut_by_level_check(_HQLA(k)))


@_query
def new_load_violations(k):
    """Key check of the facts in two loads: the second brings the later days, a seventh of the stored rows again and rows without a
    key.  Only the new rows and their possible hits are looked at; added to the report of the first load, they give that of all rows."""
    reports_ = []
    for name in FACTS:
        key, rows = PRIMARY_KEYS[name], k.table(name)
        early = F.col("date_key") < int(FIRST_DELIVERY.replace("-", ""))
        stored, later = rows.where(early), rows.where(~early)
        lost = later.withColumn(key, F.when(F.col(key) % 11 != 0, F.col(key)))
        new = lost.unionByName(stored.where(F.col(key) % 7 == 0))
        held = key_filter.KeyFilter(k.spark, storage.fresh_folder(k.spark, "keys"), key)
        held.add(stored)
        reports_ += [integrity.key_violations(stored, name, key), key_filter.added_violations(new, stored, held, name)]
    sums = [F.sum(c).alias(c) for c in ("null_key_rows", "duplicate_key_rows")]
    return reduce(DataFrame.unionAll, reports_).groupBy("table_name", "key_column").agg(*sums)


@_query
def conform_schema(k):
    """Feed columns in any order, with one too many."""
    raw = k.feeds["hqla"]
    shuffled = raw.select(*reversed(raw.columns), F.lit("not declared").alias("remark"))
    return conform(shuffled, BRONZE["hqla"])


# ---- reports --------------------------------------------------------------------------

_add("lcr_by_country_status", lambda k: reports.lcr_by_country_status(
    k.table(_LIQUIDITY), k.dims().country))
_add("lcr_days_measured", lambda k: reports.lcr_days_measured(
    k.table(_LIQUIDITY), k.dims().country))
_add("lcr_by_risk_category", lambda k: reports.lcr_by_risk_category(
    k.table(_LIQUIDITY), k.dims().country))
_add("latest_lcr_snapshot", lambda k: reports.latest_lcr_snapshot(
    k.table(_LIQUIDITY), k.dims().country, k.dims().date))
_add("hqla_composition", lambda k: reports.hqla_composition(k.table("fact_hqla_position")))
_add("lcr_trend_by_country", lambda k: reports.lcr_trend_by_country(
    k.table(_LIQUIDITY), k.dims().country, k.dims().date))
_add("hqla_vs_outflows_by_country", lambda k: reports.hqla_vs_outflows_by_country(
    k.table(_LIQUIDITY), k.dims().country))
_add("balances_by_country", lambda k: reports.balances_by_country(_BALANCES(k)))
_add("hqla_by_level", lambda k: reports.hqla_by_level(_HQLA(k)))
_add("collateral_by_type", lambda k: reports.collateral_by_type(_COLLATERAL(k)))
_add("volatility_pivot", lambda k: reports.volatility_pivot(_BALANCES(k)))
_add("lcr_two_way", lambda k: reports.lcr_two_way(
    k.table("silver_balances"), k.table("silver_hqla"), k.dims(), _load_time(), accounts_unique=True))

# ---- row rules ------------------------------------------------------------------------


def _rule(df: DataFrame, *inputs: str, **outputs) -> DataFrame:
    return df.select("source_file", *inputs, *[c.alias(n) for n, c in outputs.items()])


_add("fx_to_eur", lambda k: _rule(
    _BALANCES(k), "currency", "balance_local",
    converted_eur=rules.fx_to_eur(F.col("balance_local"), F.col("currency"))))
_add("hqla_haircut_rate", lambda k: _rule(
    _HQLA(k), "hqla_level",
    level_haircut=rules.hqla_haircut_rate(F.trim("hqla_level"), F.col("haircut_rate"))))
_add("eligible_hqla_value", lambda k: _rule(
    _HQLA(k), "market_value_eur", "haircut_rate",
    eligible_eur=rules.after_haircut(F.col("market_value_eur"), F.col("haircut_rate"))))
_add("quality_adjusted_haircut", lambda k: _rule(
    _COLLATERAL(k), "quality_rating", "haircut_percentage",
    adjusted_haircut=rules.quality_adjusted_haircut(
        F.upper(F.trim("quality_rating")), F.col("haircut_percentage"))))
_add("net_realizable_value", lambda k: _rule(
    _COLLATERAL(k), "gross_value_eur", "haircut_percentage",
    net_eur=rules.after_haircut(F.col("gross_value_eur"), F.col("haircut_percentage"))))
_add("stable_funding_flag", lambda k: _rule(
    _BALANCES(k), "maturity_bucket",
    stable_flag=rules.stable_funding_flag(F.col("maturity_bucket"))))
_add("business_key", lambda k: _rule(
    _BALANCES(k), "country",
    account_key_text=rules.business_key(
        "ACC", F.col("country"), F.substring(F.trim("account_id"), 7, 20).try_cast("bigint"))))
_add("next_review_date", lambda k: _rule(
    _COLLATERAL(k), "valuation_date", "liquidation_period_days",
    review_date=rules.next_review_date(F.col("valuation_date"), F.col("liquidation_period_days"))))


def _reporting_days(k: Lake) -> DataFrame:
    bounds = _BALANCES(k).agg(
        F.min("business_date").alias("start_date"), F.max("business_date").alias("end_date")
    )
    return reporting_calendar(bounds)


_add("reporting_calendar", _reporting_days)

# ---- whole runs -----------------------------------------------------------------------

_STATUS = ["layer", "table_name", "status", "record_count"]


@_query
def run_layer(k):
    """Bronze into a folder of its own."""
    lake = Lake(k.spark, storage.fresh_folder(k.spark, "run"), k.feeds, k.bronze_time, k.load_time)
    report = run.run_layer(lake, "bronze")
    return k.spark.createDataFrame(report, run.STATUS_SCHEMA).select(_STATUS)


@_query
def run_all(k):
    """All layers into a folder of their own."""
    lake = Lake(k.spark, storage.fresh_folder(k.spark, "run"), k.feeds, k.bronze_time, k.load_time)
    return run.run_all(lake).select(_STATUS)


@_query
def resume_all(k):
    """A run that ended after silver, gone on with: bronze and silver are kept, gold is built."""
    lake = Lake(k.spark, storage.fresh_folder(k.spark, "run"), k.feeds, k.bronze_time, k.load_time)
    marks = table_marks(lake)
    for layer in ("bronze", "silver"):
        run.run_layer(lake, layer, marks)
    again = Lake(k.spark, lake.root, k.feeds, k.bronze_time, k.load_time)
    return run.resume_all(again).select(_STATUS)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, folder, build=build: build(lake_of(spark, folder)))
        for name, build in QUERIES.items()
    }
