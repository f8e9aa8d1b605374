"""Every operator as a named query on the given test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.functions.dates import half_open
from marketspark.functions.text import currency, safe_ticker, strip
from marketspark.operators import coverage as cov
from marketspark.operators import landing, quality, weekly
from marketspark.operators.dedupe import SILVER_ORDER, dedupe
from marketspark.operators.quarantine import read_quarantine
from marketspark.operators.returns import LEVEL, daily_levels, log_returns
from marketspark.operators.upsert import upsert
from marketspark.plans import jobs, layers, models
from marketspark.plans.staging import FX_ORDER, stage_equity, stage_fx
from marketspark.schemas import DEFAULT_PAIRS, EVENT_BRONZE, FX_BRONZE, FX_KEY, FX_STAGING, GOLD_INSTRUMENTS, SILVER, SILVER_KEY
from marketspark.session import drop_stored, scratch, stored
from marketspark.sources import bronze, tables, universe
from marketspark.sources import testtables as given
from marketspark.sources.index import indexed_paths, update_index
from marketspark.sources.vendor import wide_to_long
from marketspark.sources.versions import positions, publish_version
from marketspark.streaming.landing import land_new_files, stage_new_files

DIGITS = 9  # computed doubles are compared at nine digits
DOCUMENT_FILES = "*.txt"  # what Spark's text writer calls them
QUARTER = ("1997-01-06", "1997-03-31")
ALL_DAYS = ("1995-01-01", "2001-12-31")
SPINE = ("2024-01-01", "2024-02-04")
RUN_AT = "2024-02-05T00:00:00+00:00"
REVISED_FROM = "1997-01-01"
REVISION = 1.01
KNOWN_FX_UNTIL = "1998-06-30"
FAILED_QUOTE = "CHF"  # pairs quoted in it are reported as not fetched
KNOWN_EVENTS_UNTIL = "2024-01-15"
SQL_SURFACE = (
    "SELECT week_start, base, quote, weekly_return_pct FROM weekly_performance "
    "WHERE base = ? AND weekly_return_pct > ?"
)
SQL_ARGS = ("EUR", 10.0)

Query = Callable[[SparkSession, str], DataFrame]


def _fx(spark: SparkSession, sf: str) -> DataFrame:
    return stage_fx(given.fx_bronze(spark, sf))


def _clean_fx(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rates with normalised codes, as a rate service returns them."""
    return given.fx_bronze(spark, sf).selectExpr(
        "date", f"{currency('base')} as base", f"{currency('quote')} as quote", "rate", "ingestion_id as arrival_no"
    )


def _equity(spark: SparkSession, sf: str) -> DataFrame:
    return stage_equity(given.equity_bronze(spark, sf))


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return layers.silver(_fx(spark, sf), _equity(spark, sf))


def _weekly(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly rows come from FX alone, so the equity scan is left out."""
    rows = dedupe(layers.unify_fx(_fx(spark, sf)), SILVER_KEY, SILVER_ORDER)
    return weekly.weekly_performance(rows)


def _stored_weekly(spark: SparkSession, sf: str) -> DataFrame:
    return stored(_weekly(spark, sf), "weekly")


def _round(df: DataFrame, *names: str) -> DataFrame:
    chosen = set(names)
    return df.selectExpr(*[
        f"round(`{name}`, {DIGITS}) as `{name}`" if name in chosen else f"`{name}`" for name in df.columns
    ])


def _document_store(spark: SparkSession, sf: str) -> str:
    """A folder of one JSON document per file, some of them damaged."""
    root = scratch(spark, "documents")
    bronze.write_document_files(given.rate_documents(spark, sf), root)
    return root


# Silver

def silver_unified(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(spark, sf).drop("return")


def silver_returns(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_silver(spark, sf), "return")


def _deduped(spark: SparkSession, sf: str, keep: str) -> DataFrame:
    rows = layers.unify(_fx(spark, sf), _equity(spark, sf))
    kept = dedupe(rows, SILVER_KEY, SILVER_ORDER, keep)
    return kept.selectExpr(*SILVER_KEY, "ingestion_id", f"{LEVEL} as value")


def dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _deduped(spark, sf, "last")


def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    return _deduped(spark, sf, "first")


def window_half_open(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage_fx(given.fx_bronze(spark, sf), half_open(*QUARTER), end_inclusive=False)
    return rows.select("date", "base", "quote", "rate", "ingestion_id")


# Quality

def _rejects(df: DataFrame, rules) -> DataFrame:
    reasons = "array_join(reject_reasons, ',') as reject_reasons"
    columns = [name for name in df.columns if name != "ingestion_timestamp"]
    return quality.rejected(df, rules).selectExpr(*columns, reasons, "first_reason")


def fx_rejects(spark: SparkSession, sf: str) -> DataFrame:
    records = given.fx_bronze(spark, sf)
    return _rejects(records, quality.fx_rules(records))


def equity_rejects(spark: SparkSession, sf: str) -> DataFrame:
    bars = given.equity_bronze(spark, sf)
    return _rejects(bars, quality.equity_rules(bars))


def rule_attrition(spark: SparkSession, sf: str) -> DataFrame:
    """Both feeds as tables, and rates as documents, where the rules of form find something."""
    records, bars = given.fx_bronze(spark, sf), given.equity_bronze(spark, sf)
    documents = bronze.parse_documents(given.rate_documents(spark, sf), FX_BRONZE)
    return layers.stack(
        quality.attrition(records, quality.fx_rules(records), "FX"),
        quality.attrition(bars, quality.equity_rules(bars), "EQUITY"),
        quality.attrition(documents, quality.fx_rules(documents), "DOCUMENTS"),
    )


def dq_tests(spark: SparkSession, sf: str) -> DataFrame:
    rows = stored(_silver(spark, sf), "silver")
    frames = {
        "staging_fx": _fx(spark, sf), "staging_equity": _equity(spark, sf),
        "silver": rows, "gold_market": layers.gold_market(rows),
    }
    results = [quality.run_tests(df, quality.DECLARED_TESTS[name]) for name, df in frames.items()]
    return layers.stack(*results)


def dq_tests_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """The same kinds of test on raw records, where they do fail."""
    records = quality.TableTests(
        "bronze_fx", ("date", "base", "quote", "rate"),
        accepted=(("base", ("EUR", "GBP", "USD", "AUD")),), unique=(FX_KEY, ("ingestion_id",)),
    )
    bars = quality.TableTests(
        "bronze_equity", ("date", "ticker", "open", "volume"), unique=(("date", "ticker"),)
    )
    return quality.run_tests(given.fx_bronze(spark, sf), records).unionByName(
        quality.run_tests(given.equity_bronze(spark, sf), bars)
    )


# Gold

def _log_returns(spark: SparkSession, sf: str) -> DataFrame:
    return _round(log_returns(daily_levels(_silver(spark, sf))), "log_return", "volatility")


def log_return_series(spark: SparkSession, sf: str) -> DataFrame:
    return _log_returns(spark, sf).drop("volatility")


def squared_returns(spark: SparkSession, sf: str) -> DataFrame:
    return _log_returns(spark, sf).select("date", "asset_type", "instrument", "source", "volatility")


def _rounded_wide(df: DataFrame) -> DataFrame:
    return _round(df, *[name for name in df.columns if name != "date"])


def gold_market_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_wide(layers.gold_market(_silver(spark, sf)))


def gold_market_window(spark: SparkSession, sf: str) -> DataFrame:
    """The window is part of each duplicate's key, so Spark moves its filter down to the scan."""
    return _rounded_wide(layers.gold_market(_silver(spark, sf), QUARTER))


def gold_returns_wide(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_wide(layers.gold_returns(_silver(spark, sf)))


# Weekly

def weekly_performance(spark: SparkSession, sf: str) -> DataFrame:
    return _weekly(spark, sf)


def latest_performance(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.latest_performance(_stored_weekly(spark, sf))


def top_performers(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.top_performers(_stored_weekly(spark, sf))


def worst_performers(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.worst_performers(_stored_weekly(spark, sf))


def pair_history(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.pair_history(_weekly(spark, sf), "EUR", "USD")


def weekly_all(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.newest_first(_weekly(spark, sf))


def weekly_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _round(weekly.weekly_summary(_weekly(spark, sf)), "avg_weekly_return_pct")


def sql_surface(spark: SparkSession, sf: str) -> DataFrame:
    tables.register(_weekly(spark, sf))
    return tables.run_query(spark, SQL_SURFACE, SQL_ARGS)


# Coverage

def coverage_report(spark: SparkSession, sf: str) -> DataFrame:
    return cov.coverage(given.event_records(spark, sf))


def coverage_totals(spark: SparkSession, sf: str) -> DataFrame:
    return cov.coverage_totals(coverage_report(spark, sf))


def coverage_from_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Keys parsed out of object paths; those of ``error`` lack a part and are ignored."""
    name = "if(base = 'error', base, base || '_' || quote)"
    paths = given.event_records(spark, sf).selectExpr(
        f"'bronze/rates/' || replace(date, '-', '/') || '/' || {name} || '.json' as path"
    )
    return cov.coverage(cov.keys_from_paths(paths))


def missing_dates(spark: SparkSession, sf: str) -> DataFrame:
    return cov.missing_dates(given.event_universe(spark, sf), given.event_records(spark, sf), *SPINE)


def missing_report(spark: SparkSession, sf: str) -> DataFrame:
    report = cov.missing_report(given.event_universe(spark, sf), given.event_records(spark, sf), *SPINE)
    return report.withColumn("missing", F.array_join("missing", ","))


# Landing

def ingest_worklist(spark: SparkSession, sf: str) -> DataFrame:
    return landing.work_list(given.event_universe(spark, sf), given.event_records(spark, sf), *SPINE)


def _known_events(spark: SparkSession, sf: str) -> DataFrame:
    return given.event_records(spark, sf).where(f"date <= date '{KNOWN_EVENTS_UNTIL}'")


def keep_first_landing(spark: SparkSession, sf: str) -> DataFrame:
    batch = given.event_records(spark, sf)
    landed = landing.keep_first(batch, _known_events(spark, sf), FX_KEY, ("arrived_at", "arrival_no"))
    return landed.select(*FX_KEY, "rate", "arrival_no")


def landing_summary(spark: SparkSession, sf: str) -> DataFrame:
    batch = given.event_records(spark, sf)
    return landing.landing_summary(batch, _known_events(spark, sf), FX_KEY, ("base", "quote"))


def pair_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    pairs = universe.pair_frame(spark, universe.parse_pairs(DEFAULT_PAIRS + ",E1R/USD"))
    batch = _clean_fx(spark, sf)
    known = batch.where(f"date <= date '{KNOWN_FX_UNTIL}'")
    return landing.pair_outcomes(pairs, batch, known, *ALL_DAYS)


def outcome_totals(spark: SparkSession, sf: str) -> DataFrame:
    return landing.outcome_totals(pair_outcomes(spark, sf))


def _bars(spark: SparkSession, sf: str) -> DataFrame:
    return given.equity_bronze(spark, sf).selectExpr("date", f"{strip('ticker')} as ticker")


def ticker_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Configured tickers: those with bars, one without, one that the caller reports as not fetched."""
    tickers = [(t.strip(),) for t in given.TICKERS] + [("^NONE",)]
    configured = spark.createDataFrame(tickers, "ticker string")
    failed = configured.where(f"ticker = '{given.TICKERS[0]}'")
    bars = _bars(spark, sf)
    known = bars.where(f"date <= date '{KNOWN_FX_UNTIL}'")
    return landing.ticker_outcomes(configured, bars, known, *ALL_DAYS, failed)


def ticker_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return cov.ticker_coverage(_bars(spark, sf))


def bronze_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """The id is random, so its length and its distinctness are shown instead."""
    records = given.event_records(spark, sf).select("date", "base", "quote", "rate", "arrival_no")
    enriched = landing.enrich(records, "fx", RUN_AT)
    return enriched.withColumn("ingestion_id", F.length("ingestion_id")).withColumnRenamed(
        "ingestion_id", "id_length"
    )


def vendor_wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    tickers = [t.strip() for t in given.TICKERS] + ["^NONE"]
    return wide_to_long(given.vendor_wide(spark, sf), tickers)


def ticker_key(spark: SparkSession, sf: str) -> DataFrame:
    tickers = given.equity_bronze(spark, sf).groupBy("ticker").agg(F.expr("count(*) as records"))
    return tickers.selectExpr(
        f"{strip('ticker')} as ticker", f"{safe_ticker('ticker')} as safe_ticker", "records"
    )


# State

def upsert_delete_insert(spark: SparkSession, sf: str) -> DataFrame:
    """All staged rates, then a second batch that revises the pairs quoted in USD."""
    path = scratch(spark, "staging")
    batch = _fx(spark, sf)
    upsert(batch, path, FX_KEY, FX_ORDER)
    revised = batch.where(f"quote = 'USD' and date >= date '{REVISED_FROM}'").withColumn(
        "rate", F.col("rate") * REVISION
    )
    upsert(revised, path, FX_KEY, FX_ORDER)
    return tables.read_by_date(spark, path, batch.schema).select(*FX_KEY, "rate", "ingestion_id")


def bronze_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "bronze")
    bronze.append_documents(given.fx_bronze(spark, sf), path, "month")
    rows = stage_fx(bronze.read_documents(spark, path, FX_BRONZE, multi_line=False))
    return rows.select(*FX_KEY, "rate", "ingestion_id")


def silver_partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "silver")
    writers = spark.sparkContext.defaultParallelism
    tables.write_by_date(_silver(spark, sf), path, "day", jobs.SILVER_SORT, writers)
    return _round(tables.read_by_date(spark, path, SILVER), "return")


def published_gold(spark: SparkSession, sf: str) -> DataFrame:
    paths = jobs.Paths(scratch(spark, "market"))
    tables.write_table(layers.gold_market(_silver(spark, sf)), paths.of("models", "market_data"))
    jobs.publish(spark, paths, "gold", "market_data", tests="gold_market")
    return _rounded_wide(tables.read_table(spark, paths.of("gold", "market_data")))


def published_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A reader that opened the table before the next publishing, and one after it."""
    root = scratch(spark, "versions")
    rows = stored(_silver(spark, sf), "silver")
    publish_version(layers.gold_market(rows, (ALL_DAYS[0], KNOWN_FX_UNTIL)), root)
    opened = tables.read_table(spark, root)
    publish_version(layers.gold_market(rows), root)
    drop_stored(rows)
    summary = "'{}' as reader", "count(*) as days", "min(date) as first_day", "max(date) as last_day", "count(eur_usd) as levels"
    return opened.selectExpr(summary[0].format("before"), *summary[1:]).unionByName(
        tables.read_table(spark, root).selectExpr(summary[0].format("after"), *summary[1:]))


def _windows_out_of_order(spark: SparkSession, sf: str) -> list[tuple[tuple[str, str], DataFrame, DataFrame]]:
    """Window, fetched rates and failed pairs: later days of the euro pairs, then the earlier ones, then one quarter of the other pairs."""
    rates, euro = _clean_fx(spark, sf), F.col("base") == "EUR"
    windows = (
        ((_next_day(KNOWN_FX_UNTIL), ALL_DAYS[1]), euro), ((ALL_DAYS[0], KNOWN_FX_UNTIL), euro), (QUARTER, ~euro))
    failed = F.col("quote") == FAILED_QUOTE
    return [(window, rates.where(some), rates.where(some & failed).select("base", "quote")) for window, some in windows]


def maintained_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Daily returns and weeks after windows out of order; each run rewrote only what it changed."""
    paths = jobs.Paths(scratch(spark, "maintained"))
    for window, rates, _ in _windows_out_of_order(spark, sf):
        jobs.run(spark, paths, window, rates=rates, run_at=RUN_AT, grain="month", rates_arrival=["arrival_no"])
    names = list(GOLD_INSTRUMENTS.values())
    returns = jobs.read_returns(spark, paths).unpivot("date", names, "name", "value").where("value is not null")
    weeks = jobs.read_weekly(spark, paths).selectExpr(
        "'weekly' as table_name", "week_start as date", "base || '/' || quote as name", "weekly_return_pct as value")
    return _round(returns.selectExpr("'returns' as table_name", "date", "name", "value").unionByName(weeks), "value")


def run_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every configured pair in the landing of those windows; the caller reported one as failed."""
    paths = jobs.Paths(scratch(spark, "outcomes"))
    pairs = universe.pair_frame(spark, universe.parse_pairs(DEFAULT_PAIRS))
    for window, rates, failures in _windows_out_of_order(spark, sf):
        jobs.record_outcomes(spark, paths, window[0], pairs, rates, window, failures)
        jobs.land(rates, paths.of("bronze", "rates"), FX_BRONZE, FX_KEY, "fx", window, ["arrival_no"], RUN_AT, "month")
    return jobs.read_outcomes(spark, paths)


def medallion_run(spark: SparkSession, sf: str) -> DataFrame:
    """Landing to publishing, over all days; the published market table."""
    paths = jobs.Paths(scratch(spark, "medallion"))
    rates = _clean_fx(spark, sf)
    jobs.run(
        spark, paths, ALL_DAYS, rates=rates, bars=given.vendor_wide(spark, sf),
        tickers=[t.strip() for t in given.TICKERS], run_at=RUN_AT, grain="month", rates_arrival=["arrival_no"],
    )
    return _rounded_wide(tables.read_table(spark, paths.of("gold", "market_data")))


def _overlapping_windows(spark: SparkSession, sf: str) -> jobs.Paths:
    """Uncleaned rates, landed and staged in two windows that share two years."""
    paths = jobs.Paths(scratch(spark, "dirty"))
    rates = given.fx_bronze(spark, sf).selectExpr("date", "base", "quote", "rate", "ingestion_id as arrival_no")
    for window in ((ALL_DAYS[0], KNOWN_FX_UNTIL), (REVISED_FROM, ALL_DAYS[1])):
        jobs.land(rates, paths.of("bronze", "rates"), FX_BRONZE, FX_KEY, "fx", window, ["arrival_no"], RUN_AT, "month")
        jobs.stage(spark, paths, window)
    return paths


def medallion_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What runs over uncleaned rates keep apart, each record once, with its first failing rule."""
    return jobs.rejects(spark, _overlapping_windows(spark, sf), "rates").select("date", "base", "quote", "rate", "first_reason")


def medallion_attrition(spark: SparkSession, sf: str) -> DataFrame:
    """Rows before and after each rule, added up over the days; shared days count once."""
    return jobs.attrition(spark, _overlapping_windows(spark, sf), "rates").where("rule not in ('readable', 'rate_type')").drop("step")


def _documents_to_silver(spark: SparkSession, sf: str) -> tuple[str, str]:
    root, target, dead = _document_store(spark, sf), scratch(spark, "silver"), scratch(spark, "quarantine")
    for _ in range(2):  # again: nothing is added
        jobs.bronze_to_silver(spark, root, f"{root}-none", target, grain="month", dead=dead, pattern=DOCUMENT_FILES)
    return target, dead


def bronze_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters of a folder of one document per file, read twice."""
    _, dead = _documents_to_silver(spark, sf)
    number = r"""cast(regexp_extract(document, '"ingestion_id": ?"(\\d+)"', 1) as bigint) as ingestion_id"""
    return read_quarantine(spark, dead).selectExpr(
        "feed", number, "array_join(reject_reasons, ',') as reject_reasons", "first_reason", "copies")


def documents_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver from the readable documents of the same folder."""
    target, _ = _documents_to_silver(spark, sf)
    return tables.read_by_date(spark, target, SILVER).select("date", "base", "quote", "rate", "source")


def bronze_to_silver_job(spark: SparkSession, sf: str) -> DataFrame:
    """JSON documents of both feeds to a Silver table by month, with no staging between."""
    rates, bars, target = (scratch(spark, name) for name in ("rates", "bars", "silver"))
    for records, path in ((given.fx_bronze(spark, sf), rates), (given.equity_bronze(spark, sf), bars)):
        # Documents hold ids as text; at one width they sort as the numbers do.
        padded = F.lpad(F.col("ingestion_id").cast("string"), 12, "0")
        bronze.append_documents(records.withColumn("ingestion_id", padded), path, "month", packed=True)
    jobs.bronze_to_silver(spark, rates, bars, target, multi_line=False, grain="month", pattern=bronze.PACKED)
    return tables.read_by_date(spark, target, SILVER).select(*FX_KEY, "asset_type", "instrument", "rate", "adj_close", "source")


def _analysed(spark: SparkSession, sf: str) -> jobs.Paths:
    """Silver published, the weekly job and the analytics job run on it."""
    paths = jobs.Paths(scratch(spark, "analysed"))
    rows = dedupe(layers.unify_fx(_fx(spark, sf)), SILVER_KEY, SILVER_ORDER)
    tables.write_by_date(rows.select(*SILVER.fieldNames()), paths.of("silver", "silver"), "month")
    jobs.build_weekly(spark, paths)
    jobs.run_analytics(spark, paths)
    return paths


def weekly_job(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.read_weekly(spark, _analysed(spark, sf))


def analytics_latest(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_table(spark, _analysed(spark, sf).of("analytics", "latest_performance"))


def analytics_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = tables.read_table(spark, _analysed(spark, sf).of("analytics", "weekly_summary"))
    return _round(summary, "avg_weekly_return_pct")


def object_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Months that hold documents, by their paths alone."""
    root = scratch(spark, "listing")
    bronze.append_documents(given.fx_bronze(spark, sf), root, "month")
    month = "regexp_extract(path, r'year=(\\d+)/month=(\\d+)/', {})"
    return bronze.object_paths(spark, root).selectExpr(
        f"cast({month.format(1)} as int) as year", f"cast({month.format(2)} as int) as month").distinct()


def silver_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Two windows, the later one first: Silver is refreshed from the first changed day, as a rebuild would have it."""
    paths = jobs.Paths(scratch(spark, "refresh"))
    rates = _clean_fx(spark, sf)
    for window in ((_next_day(KNOWN_FX_UNTIL), ALL_DAYS[1]), (ALL_DAYS[0], KNOWN_FX_UNTIL)):
        jobs.run(spark, paths, window, rates=rates, run_at=RUN_AT, grain="month", rates_arrival=["arrival_no"])
    return _round(tables.read_by_date(spark, paths.of("silver", "silver"), SILVER), "return").select(
        "date", "instrument", "rate", "return", "source")


def _next_day(day: str) -> str:
    return (date.fromisoformat(day) + timedelta(days=1)).isoformat()


def stream_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops of files, a stream run after each; the second reads new files only.

    They share keys, and for a part of them the later row comes in the first drop.
    """
    root, target, checkpoint = (scratch(spark, name) for name in ("drops", "staging", "offsets"))
    records = given.fx_bronze(spark, sf)
    for part in ("ingestion_id % 2 = 1", "ingestion_id % 2 = 0"):
        bronze.append_documents(records.where(part), root, "month")
        stage_new_files(
            spark, root, FX_BRONZE, stage_fx, target, FX_KEY, FX_ORDER, checkpoint, multi_line=False,
            files_per_batch=40,
        ).awaitTermination()
    return tables.read_by_date(spark, target, FX_STAGING).select(*FX_KEY, "rate", "ingestion_id")


def stream_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops with common keys, landed after each: what came first stays, whenever it was recorded."""
    root, target, checkpoint = (scratch(spark, name) for name in ("drops", "bronze", "offsets"))
    records = given.event_records(spark, sf).withColumn("date", F.col("date").cast("string")).withColumn(
        "arrived_at", F.date_format("arrived_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    for part in ("arrival_no % 2 = 1", "arrival_no % 2 = 0"):
        bronze.append_documents(records.where(part), root, "month")
        land_new_files(
            spark, root, EVENT_BRONZE, FX_KEY, ("arrived_at", "arrival_no"), target, checkpoint, "events", RUN_AT,
            multi_line=False, grain="month").awaitTermination()
    landed = bronze.read_landed(spark, target, EVENT_BRONZE)
    return landed.selectExpr("cast(date as date) as date", "base", "quote", "rate", "arrival_no")


def declared_models(spark: SparkSession, sf: str) -> DataFrame:
    """The wide market table and all it is made of, built through the catalog, twice: the second time staging is merged."""
    root = scratch(spark, "models")
    database = f"market_{root[-32:]}"
    spark.sql(f"create database `{database}` location '{root}/{database}'")
    sources = {"bronze_fx": given.fx_bronze(spark, sf), "bronze_equity": given.equity_bronze(spark, sf)}
    for _ in range(2):
        models.build(spark, models.MODELS, "+gold_market_data", sources, database, root)
    return _rounded_wide(spark.table(f"`{database}`.gold_market_data"))


def coverage_from_index(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage by the paths of a store that fills in two steps; each step's listing reaches new objects only."""
    root, index = scratch(spark, "store"), scratch(spark, "index")
    documents = given.rate_documents(spark, sf)
    for part in ("s_suppkey % 2 = 1", "s_suppkey % 2 = 0"):
        bronze.write_document_files(documents.where(part), root)
        update_index(spark, root, index, suffix=".txt")
    return cov.coverage(cov.keys_from_folders(indexed_paths(spark, index)))


def ordered_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Place of every row in the files of a published table that is sorted over all files."""
    root, order = scratch(spark, "ordered"), layers.ORDERS["silver"]
    publish_version(_silver(spark, sf), root, order=order)
    return positions(spark, tables.current(spark, root)).select("position", *order)


def strict_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Rates as text, every value of which can be read; one that cannot would fail the query."""
    texts = given.fx_bronze(spark, sf).withColumns({"date": F.expr("cast(date as string)"), "rate": F.expr("cast(rate as string)")})
    return stage_fx(texts, strict=True).select(*FX_KEY, "rate", "ingestion_id")


QUERIES: dict[str, Query] = {
    "silver_unified": silver_unified,
    "silver_returns": silver_returns,
    "dedupe_latest": dedupe_latest,
    "dedupe_first": dedupe_first,
    "window_half_open": window_half_open,
    "fx_rejects": fx_rejects,
    "equity_rejects": equity_rejects,
    "rule_attrition": rule_attrition,
    "dq_tests": dq_tests,
    "dq_tests_bronze": dq_tests_bronze,
    "log_returns": log_return_series,
    "squared_returns": squared_returns,
    "gold_market_wide": gold_market_wide,
    "gold_market_window": gold_market_window,
    "gold_returns_wide": gold_returns_wide,
    "weekly_performance": weekly_performance,
    "latest_performance": latest_performance,
    "top_performers": top_performers,
    "worst_performers": worst_performers,
    "pair_history": pair_history,
    "weekly_all": weekly_all,
    "weekly_summary": weekly_summary,
    "sql_surface": sql_surface,
    "coverage_report": coverage_report,
    "coverage_totals": coverage_totals,
    "coverage_from_paths": coverage_from_paths,
    "missing_dates": missing_dates,
    "missing_report": missing_report,
    "ingest_worklist": ingest_worklist,
    "keep_first_landing": keep_first_landing,
    "landing_summary": landing_summary,
    "pair_outcomes": pair_outcomes,
    "outcome_totals": outcome_totals,
    "ticker_outcomes": ticker_outcomes,
    "ticker_coverage": ticker_coverage,
    "bronze_enriched": bronze_enriched,
    "vendor_wide_to_long": vendor_wide_to_long,
    "ticker_key": ticker_key,
    "upsert_delete_insert": upsert_delete_insert,
    "bronze_json_roundtrip": bronze_json_roundtrip,
    "silver_partitioned_roundtrip": silver_partitioned_roundtrip,
    "published_gold": published_gold,
    "medallion_run": medallion_run,
    "medallion_rejects": medallion_rejects,
    "medallion_attrition": medallion_attrition,
    "bronze_documents": bronze_documents,
    "documents_silver": documents_silver,
    "bronze_to_silver_job": bronze_to_silver_job,
    "weekly_job": weekly_job,
    "analytics_latest": analytics_latest,
    "analytics_summary": analytics_summary,
    "object_listing": object_listing,
    "silver_refresh": silver_refresh,
    "stream_incremental": stream_incremental,
    "stream_keep_first": stream_keep_first,
    "published_versions": published_versions,
    "maintained_gold": maintained_gold,
    "run_outcomes": run_outcomes,
    "declared_models": declared_models,
    "coverage_from_index": coverage_from_index,
    "ordered_silver": ordered_silver,
    "strict_staging": strict_staging,
}
