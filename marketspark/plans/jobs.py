"""Jobs: land, stage, build, publish, analyse.

Paths are folders every executor can reach. Each job may be run again for the
same window: landing skips known keys, staging replaces keys, and the other
tables are rebuilt.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.functions.dates import check_window, in_window, week_start
from marketspark.functions.text import currency
from marketspark.operators.delta import changed_days
from marketspark.operators.landing import enrich, keep_first, pair_outcomes
from marketspark.operators.quality import (
    DECLARED_TESTS, Rule, TableTests, check_publishable, check_tests, equity_rules, fx_rules, require_columns,
    run_tests, with_reasons,
)
from marketspark.operators.quarantine import (
    attrition_totals, daily_attrition, letters, quarantine, read_quarantine, records,
)
from marketspark.operators.upsert import upsert
from marketspark.operators.weekly import latest_performance, weekly_performance, weekly_summary
from marketspark.plans.layers import gold_market, gold_returns, silver, silver_since
from marketspark.plans.staging import EQUITY_ORDER, FX_ORDER, stage_equity, stage_fx
from marketspark.schemas import (
    ATTRITION, EQUITY_BRONZE, EQUITY_KEY, EQUITY_STAGING, FX_BRONZE, FX_KEY, FX_STAGING, GOLD_RETURNS, SILVER, WEEKLY,
)
from marketspark.session import drop_stored, exists, stored
from marketspark.sources.bronze import append_documents, documents_if_any, read_landed
from marketspark.sources.tables import (
    among_values, check_grain, first_of, months_after, period, period_value, read_by_date, read_table, register,
    write_by_date, write_table,
)
from marketspark.sources.vendor import wide_to_long
from marketspark.sources.versions import publish_version
from marketspark.streaming.landing import stage_new_files


SILVER_SORT = ("asset_type", "instrument")
LINEAGE = ("source", "ingestion_timestamp", "ingestion_id")


@dataclass(frozen=True)
class Paths:
    """Folders of the layers below one root."""

    root: str

    def of(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


def land(
    records: DataFrame, root: str, schema: T.StructType, keys: Sequence[str], source: str,
    window: tuple[str, str], arrival: Sequence[str] = (), run_at: str | None = None,
    grain: str = "day",
) -> None:
    """Append the records of the window whose key Bronze lacks, the first of each key.

    ``arrival`` names the columns that tell which came first; without them it is the
    order of the rows in ``records``. Records without a full key land once per content,
    and staging rejects them.
    """
    require_columns(records, keys, "records to land")
    spark = records.sparkSession
    check_grain(spark, root, schema, grain, "json")
    fields = [name for name in schema.fieldNames() if name in records.columns]
    content = [name for name in fields if name not in LINEAGE]
    records = records.withColumn("_row", F.monotonically_increasing_id())
    order = [*arrival, "_row"]
    day = "try_cast(date as date)"
    # A record whose date cannot be read lands as well; staging rejects it with the reason.
    dated = records.where(f"{day} is null or ({in_window(day, *window)})")
    # Keys are compared as they are stored: the day as ISO text.
    dated = dated.withColumn("date", F.expr(f"coalesce(cast({day} as string), cast(date as string))"))
    landed = read_landed(spark, root, schema, window)
    full = " and ".join(f"`{key}` is not null" for key in keys)
    fresh = keep_first(dated.where(full), landed, keys, order)
    as_text = lambda df: df.selectExpr("*", *[f"cast(`{name}` as string) as `_text_{name}`" for name in content])
    partial = keep_first(
        as_text(dated.where(f"not ({full})")), as_text(landed.where(f"not ({full})")), [f"_text_{name}" for name in content], order)
    append_documents(enrich(fresh.select(*fields).unionByName(partial.select(*fields)), source, run_at), root, grain)


# Per feed: its name, its layout as landed, its rules, its staging, its key and the order of rivals.
FEEDS = (
    ("rates", FX_BRONZE, fx_rules, stage_fx, FX_KEY, FX_ORDER),
    ("market", EQUITY_BRONZE, equity_rules, stage_equity, EQUITY_KEY, EQUITY_ORDER),
)
_STAGING_TESTS = {"rates": "staging_fx", "market": "staging_equity"}


def screened(documents: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, dict[str, int]]:
    """The documents with the reasons against them, stored, and how many were read and rejected.

    The counts are observed while the rows are written, so the JSON is parsed once; all
    that follows reads the stored columns. Drop the copy when nothing reads it any more.
    """
    seen = Observation(f"screened-{uuid.uuid4().hex}")
    rows = stored(with_reasons(documents, rules).observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col("first_reason").isNotNull()).alias("rejected")), "screened")
    return rows, {"read": 0, "rejected": 0} | {name: n for name, n in seen.get.items() if n is not None}


def stage(
    spark: SparkSession, paths: Paths, window: tuple[str, str], undated_since: date | None = None, strict: bool = False,
) -> dict[str, dict[str, int]]:
    """Upsert the window's valid Bronze records into both staging tables; records read and rejected per feed.

    With ``strict`` a value that cannot be read fails the run, once its letters are kept. What the rules reject goes to one quarantine table, once per version of its file, and
    the rows before and after each rule are kept per day. Windows may overlap.
    """
    counts = {}
    for name, schema, rules_of, staged_rows, keys, order in FEEDS:
        landed = read_landed(spark, paths.of("bronze", name), schema, window, undated_since)
        rules = rules_of(landed)
        rows, counts[name] = screened(landed, rules)
        if counts[name]["read"]:
            quarantine(letters(rows, name), paths.of("quarantine", "documents"))
            upsert(daily_attrition(rows, rules, name), paths.of("attrition", name), ("date", "dated", "step"), ("rule",))
            valid = staged_rows(rows if strict else rows.where("first_reason is null"), window, strict=strict, screened=not strict)
            check_tests(run_tests(valid, DECLARED_TESTS[_STAGING_TESTS[name]]))
            upsert(valid, paths.of("staging", name), keys, order)
        drop_stored(rows)
    return counts


def rejects(spark: SparkSession, paths: Paths, feed: str) -> DataFrame:
    """Rejected records of ``rates`` or ``market``, with all reasons and the first one."""
    schema = next(layout for name, layout, *_ in FEEDS if name == feed)
    return records(read_quarantine(spark, paths.of("quarantine", "documents")).where(F.col("feed") == feed), schema)


def attrition(spark: SparkSession, paths: Paths, feed: str) -> DataFrame:
    """Rows before and after each rule, over all days staged so far."""
    daily = read_by_date(spark, paths.of("attrition", feed), ATTRITION)
    return attrition_totals(spark.createDataFrame([], ATTRITION) if daily is None else daily)


def bronze_to_silver(
    spark: SparkSession, rates_root: str, bars_root: str, target: str, multi_line: bool = True,
    grain: str = "day", dead: str | None = None, pattern: str = "*.json",
) -> bool:
    """All Bronze documents to a date-partitioned Silver table, with no staging between.

    False, with nothing written, where no document exists; an error where none is valid.
    Rejected documents go to the quarantine table at ``dead``, once per version of their
    file, before the valid ones are written. Without ``dead`` only the valid ones are read
    on, so they go to Silver in the pass that parses them, with no copy between.
    """
    rows, copies = {}, []
    for (name, schema, rules_of, *_), root in zip(FEEDS, (rates_root, bars_root), strict=True):
        documents = documents_if_any(spark, root, schema, multi_line, pattern)
        if dead:
            rows[name], counts = screened(documents, rules_of(documents))
            copies.append(rows[name])
            if counts["rejected"]:
                quarantine(letters(rows[name], name), dead)
        else:
            rows[name] = with_reasons(documents, rules_of(documents))
    valid = [df.where("first_reason is null") for df in rows.values()]
    built = stored(silver(stage_fx(valid[0], screened=True), stage_equity(valid[1], screened=True)), "silver")
    # Only where no row is valid are the documents looked at again: are there any?
    read = not (built.isEmpty() and all(df.isEmpty() for df in rows.values()))
    if read:
        write_by_date(gate(built, "silver"), target, grain, SILVER_SORT)
    for df in (built, *copies):
        drop_stored(df)
    return read


def staged(spark: SparkSession, paths: Paths, since: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Staged rows, all or from a day on; a feed that never landed is an empty frame."""
    tables = []
    for name, schema in (("rates", FX_STAGING), ("market", EQUITY_STAGING)):
        bounds = _from(since, "month") if since else None
        table = read_by_date(spark, paths.of("staging", name), schema, bounds)
        if table is None:
            table = spark.createDataFrame([], schema)
        tables.append(table.where(f"date >= date '{since}'") if since else table)
    return tables[0], tables[1]


def _from(day: str, grain: str) -> tuple[int, int]:
    """Partition numbers from a day on."""
    return period_value(date.fromisoformat(day), grain), period_value(date.max, grain)


def build_silver(spark: SparkSession, paths: Paths, grain: str = "day") -> None:
    """Rebuild Silver from all staging, so returns look back past any window; nothing older stays."""
    rows = silver(*staged(spark, paths))
    write_by_date(rows, paths.of("models", "silver"), grain, SILVER_SORT, replace=True)


def refresh_silver(spark: SparkSession, paths: Paths, start: str, grain: str = "day") -> None:
    """Rebuild Silver from the start of a changed window on; older partitions stay.

    The result equals a full rebuild: a return depends on the previous observation
    only, and the last one before ``start`` comes from the table as it stands.
    """
    start = first_of(start, grain)
    path = paths.of("models", "silver")
    earlier = period_value(date.min, grain), period_value(date.fromisoformat(start), grain)
    built = read_by_date(spark, path, SILVER, earlier)
    if built is None:
        build_silver(spark, paths, grain)
        return
    rows = silver_since(*staged(spark, paths, start), built, start)
    write_by_date(rows, path, grain, SILVER_SORT)


def publish(spark: SparkSession, paths: Paths, layer: str, table: str, tests: str | TableTests | None = None) -> None:
    """Publish a built table as a new version, once it passes the gate."""
    publish_version(gate(read_table(spark, paths.of("models", table)), table, tests), paths.of(layer, table))


def publish_table(spark: SparkSession, name: str, path: str, tests: str | TableTests | None = None) -> None:
    """Publish a catalog table as a new version below a folder, once it passes the gate."""
    publish_version(gate(spark.table(name), name, tests), path)


def publish_silver(
    spark: SparkSession, paths: Paths, grain: str = "day", months: Sequence[int] | None = None
) -> None:
    """Copy the built Silver table, or its partitions of some months, through the gate."""
    built = read_by_date(spark, paths.of("models", "silver"), SILVER, months=months)
    if built is None:
        raise ValueError("silver is not built")
    write_by_date(gate(built, "silver", "silver"), paths.of("silver", "silver"), grain, SILVER_SORT, replace=months is None)


def changed_months(spark: SparkSession, paths: Paths, since: str, grain: str = "day") -> list[int] | None:
    """Months (YYYYMM00) in which built and published Silver differ from a day on; None where nothing is published.

    The calendar bounds their number.
    """
    bounds = _from(first_of(since, grain), grain)
    published = read_by_date(spark, paths.of("silver", "silver"), SILVER, bounds)
    built = read_by_date(spark, paths.of("models", "silver"), SILVER, bounds)
    if published is None or built is None:
        return None
    found = changed_days(published, built).selectExpr(f"{period('month')} as month").distinct().collect()
    return sorted(row.month for row in found)


def gate(built: DataFrame, table: str, tests: str | TableTests | None = None) -> DataFrame:
    """Refuse an empty or malformed table, and one that fails its declared tests."""
    check_publishable(built, table)
    if tests:
        check_tests(run_tests(built, tests if isinstance(tests, TableTests) else DECLARED_TESTS[tests]))
    return built


def build_gold(spark: SparkSession, paths: Paths, window: tuple[str, str], grain: str = "day") -> None:
    """Build the wide market table of the window."""
    path = paths.of("models", "silver")
    bounds = tuple(period_value(date.fromisoformat(day), grain) for day in window)
    write_table(gold_market(read_by_date(spark, path, SILVER, bounds), window), paths.of("models", "market_data"))


_RETURNS_TESTS = TableTests("daily_returns", ("date",), unique=(("date",),))


def build_returns(spark: SparkSession, paths: Paths, months: Sequence[int] | None = None) -> None:
    """Published Silver to the wide table of daily returns, all of it or only some months.

    A day's row needs that day's Silver rows alone, which already hold their returns.
    """
    rows = gold_returns(_published(spark, paths, months))
    write_by_date(rows, paths.of("models", "daily_returns"), "month", replace=months is None)
    built = read_by_date(spark, paths.of("models", "daily_returns"), GOLD_RETURNS, months=months)
    write_by_date(gate(built, "daily_returns", _RETURNS_TESTS), paths.of("gold", "daily_returns"), "month", replace=months is None)


def build_weekly(spark: SparkSession, paths: Paths, months: Sequence[int] | None = None) -> None:
    """Published Silver to the weekly table, all of it or only the weeks that touch some months.

    The table is partitioned by the month of the week's Monday, and a partition is rewritten
    whole: its weeks reach at most six days into the next month, and a day may belong
    to a week of the month before.
    """
    target = paths.of("gold", "weekly_performance")
    if months is None:
        write_by_date(weekly_performance(_published(spark, paths)), target, "month", replace=True, by="week_start")
        return
    days = _published(spark, paths, months).where(among_values(period("month"), months))
    mondays = sorted(row[0] for row in days.selectExpr(period("month", week_start("date"))).distinct().collect())
    rows = _published(spark, paths, sorted({*mondays, *months_after(mondays)}))
    inside = rows.where(among_values(period("month", week_start("date")), mondays))
    write_by_date(weekly_performance(inside), target, "month", by="week_start")


def _published(spark: SparkSession, paths: Paths, months: Sequence[int] | None = None) -> DataFrame:
    rows = read_by_date(spark, paths.of("silver", "silver"), SILVER, months=months)
    if rows is None:
        raise ValueError("no Silver table is published")
    return rows


def read_weekly(spark: SparkSession, paths: Paths) -> DataFrame:
    return read_by_date(spark, paths.of("gold", "weekly_performance"), WEEKLY)


def read_returns(spark: SparkSession, paths: Paths) -> DataFrame:
    return read_by_date(spark, paths.of("gold", "daily_returns"), GOLD_RETURNS)


def analytics_session(spark: SparkSession, paths: Paths) -> DataFrame:
    """Register the weekly table as ``weekly_performance`` for SQL and return it."""
    return register(read_weekly(spark, paths))


def run_analytics(spark: SparkSession, paths: Paths) -> None:
    """Publish the latest week's performance and the summary per week."""
    weekly = analytics_session(spark, paths)
    publish_version(latest_performance(weekly), paths.of("analytics", "latest_performance"))
    publish_version(weekly_summary(weekly), paths.of("analytics", "weekly_summary"))


def _note(spark: SparkSession, paths: Paths, run_id: str, start: str) -> None:
    """Note that a run is about to change rows from ``start`` on."""
    note = f"select '{run_id}' as run, '{start}' as start, false as done, current_timestamp() as noted"
    spark.sql(note).coalesce(1).write.mode("append").parquet(paths.of("state", "runs"))


def _runs(spark: SparkSession, paths: Paths) -> DataFrame:
    """Per run its first changed day, when it began, when it was last heard of, and whether it ended."""
    path, layout = paths.of("state", "runs"), "run string, start string, done boolean, noted timestamp"
    notes = spark.read.schema(layout).parquet(path) if exists(spark, path) else spark.createDataFrame([], layout)
    return notes.groupBy("run").agg(
        F.min("start").alias("start"), F.min("noted").alias("began"), F.max("noted").alias("noted"), F.max("done").alias("done"))


def _end(spark: SparkSession, paths: Paths) -> None:
    """Note the end of a run, and of earlier ones that did not end: it has made up for them. Runs do not overlap."""
    ended = _runs(spark, paths).where("not done").selectExpr("run", "start", "true as done", "current_timestamp() as noted")
    ended.coalesce(1).write.mode("append").parquet(paths.of("state", "runs"))


def changed_from(spark: SparkSession, paths: Paths) -> str | None:
    """First day of all windows whose run has begun and not ended: Silver may lack them."""
    return _runs(spark, paths).where("not done").agg(F.min("start")).first()[0]


def seen_since(spark: SparkSession, paths: Paths, run_id: str) -> date | None:
    """Day from which files may be unseen: the eve of the first run that did not end, else of the last that did; None without."""
    began = "min(if(done, null, began))"
    row = _runs(spark, paths).where(F.col("run") != run_id).agg(
        F.expr(f"date_sub(cast(coalesce({began}, max(noted)) as date), 1) as since")).first()
    return row["since"]


def _touch(spark: SparkSession, paths: Paths, run_id: str, months: Sequence[int] | None) -> None:
    """Write down what a run is about to publish; null stands for all months."""
    rows = ", ".join(str(m) for m in months) if months is not None else "null"
    if rows:
        spark.sql(f"select '{run_id}' as run, explode(array({rows})) as month").selectExpr("run", "cast(month as int) as month").coalesce(
            1).write.mode("append").parquet(paths.of("state", "touched"))


def touched_months(spark: SparkSession, paths: Paths) -> list[int] | None:
    """Months whose Gold may lag behind Silver: those of all runs that have not ended. None: all."""
    path = paths.of("state", "touched")
    if not exists(spark, path):
        return []
    open_runs = _runs(spark, paths).where("not done").select("run")
    months = [row.month for row in spark.read.schema("run string, month int").parquet(path).join(open_runs, "run").select("month").distinct().collect()]
    return None if None in months else sorted(months)


def publish_all(
    spark: SparkSession, paths: Paths, run_id: str, window: tuple[str, str], start: str | None, grain: str = "day",
) -> None:
    """From staging to all published tables, where rows from ``start`` on may have changed; None: rebuild all.

    Only the months in which Silver did change are published again, and only the partitions of
    daily returns and weeks that depend on them are rewritten. They are written down
    first, so a run that fails half way leaves them to the next one.
    """
    if start:
        refresh_silver(spark, paths, start, grain)
    else:
        build_silver(spark, paths, grain)
    changed = changed_months(spark, paths, start, grain) if start else None
    _touch(spark, paths, run_id, changed)
    if changed is None or changed:
        publish_silver(spark, paths, grain, changed)
    months = touched_months(spark, paths)
    if months is None or months:
        build_returns(spark, paths, months)
        build_weekly(spark, paths, months)
        run_analytics(spark, paths)
    build_gold(spark, paths, window, grain)
    publish(spark, paths, "gold", "market_data", tests="gold_market")


def record_outcomes(
    spark: SparkSession, paths: Paths, run_key: str, universe: DataFrame, rates: DataFrame, window: tuple[str, str],
    failures: DataFrame | None = None,
) -> None:
    """Write what becomes of every configured pair in a run: uploaded, skipped, or failed to be fetched.

    A run that is repeated replaces its rows. Call it before the records land.
    """
    landed = read_landed(spark, paths.of("bronze", "rates"), FX_BRONZE, window)
    key = ["try_cast(date as date) as date", f"{currency('base')} as base", f"{currency('quote')} as quote"]
    outcomes = pair_outcomes(universe, rates.selectExpr(*key), landed.selectExpr(*key), *window, failures)
    outcomes.withColumn("run", F.lit(run_key)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run").parquet(paths.of("state", "outcomes"))


def read_outcomes(spark: SparkSession, paths: Paths) -> DataFrame:
    layout = "base string, quote string, status string, uploaded bigint, skipped bigint, run string"
    return spark.read.schema(layout).parquet(paths.of("state", "outcomes"))


def run(
    spark: SparkSession, paths: Paths, window: tuple[str, str],
    rates: DataFrame | None = None, rates_source: str = "fx",
    bars: DataFrame | None = None, bars_source: str = "equity", tickers: Sequence[str] = (),
    run_at: str | None = None, grain: str = "day", since: str | None = None,
    rates_arrival: Sequence[str] = (), rebuild: bool = False,
    pairs: DataFrame | None = None, failures: DataFrame | None = None, run_key: str | None = None, strict: bool = False,
) -> None:
    """One window from fetched records to published tables.

    ``rates`` are records (date, base, quote, rate), in order of arrival or with
    ``rates_arrival`` columns; ``bars`` is the vendor's wide frame. Staging accumulates
    over runs, Silver covers all of it, and the market table holds the window only.
    Silver is rebuilt from the first changed day on: the start of this window, or of an
    earlier one whose run did not end, or ``since`` if that is earlier still. ``rebuild``
    rebuilds it whole. ``grain`` sets the directories of Bronze and Silver; months suit
    long histories of few instruments. A table of another grain is refused.

    With the configured ``pairs`` (base, quote) the outcome of each is kept under
    ``run_key`` (the window, if not given); ``failures`` are those whose fetch failed.
    ``strict`` fails the run on a value that cannot be read, instead of its record.
    """
    first, _ = check_window(*window)
    if since and date.fromisoformat(since) > first:
        raise ValueError(f"since ({since}) is later than the start of the window ({window[0]})")
    for layer in ("models", "silver"):
        check_grain(spark, paths.of(layer, "silver"), SILVER, grain)
    run_id = uuid.uuid4().hex
    _note(spark, paths, run_id, min(since or window[0], window[0]))
    if rates is not None:
        if pairs is not None:
            record_outcomes(spark, paths, run_key or "_".join(window), pairs, rates, window, failures)
        land(rates, paths.of("bronze", "rates"), FX_BRONZE, FX_KEY, rates_source, window, rates_arrival,
             run_at=run_at, grain=grain)
    if bars is not None:
        long = wide_to_long(bars, tickers)
        land(long, paths.of("bronze", "market"), EQUITY_BRONZE, ("date", "ticker"), bars_source,
             window, run_at=run_at, grain=grain)
    stage(spark, paths, window, seen_since(spark, paths, run_id), strict)
    publish_all(spark, paths, run_id, window, None if rebuild else changed_from(spark, paths), grain)
    _end(spark, paths)


def run_store(
    spark: SparkSession, paths: Paths, rates_root: str, bars_root: str, window: tuple[str, str],
    multi_line: bool = True, grain: str = "day", pattern: str = "*.json",
) -> bool:
    """From stores of documents that others fill to published tables: documents that came since the last run.

    False, with nothing published, where no valid one came. The market table holds the window.
    """
    check_window(*window)
    for layer in ("models", "silver"):
        check_grain(spark, paths.of(layer, "silver"), SILVER, grain)
    run_id = uuid.uuid4().hex
    for (name, schema, rules, staged_rows, keys, order), root in zip(FEEDS, (rates_root, bars_root), strict=True):
        if exists(spark, root):
            stage_new_files(
                spark, root, schema, staged_rows, paths.of("staging", name), keys, order, paths.of("state", f"offsets-{name}"),
                multi_line, pattern=pattern, rules=rules, feed=name, dead=paths.of("quarantine", "documents"),
                changed=lambda day: _note(spark, paths, run_id, day),
            ).awaitTermination()
    start = changed_from(spark, paths)
    if start is None:
        return False
    publish_all(spark, paths, run_id, window, start, grain)
    _end(spark, paths)
    return True
