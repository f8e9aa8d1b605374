"""Dead letters, maintained Gold, versions, streams that keep the first, outcomes, models, index, order, strict casts."""

import datetime as dt
import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketspark.operators.delta import changed_days
from marketspark.operators.quarantine import read_quarantine
from marketspark.plans import jobs, layers, models
from marketspark.plans.staging import FX_ORDER, stage_equity, stage_fx
from marketspark.operators.quality import fx_rules
from marketspark.schemas import EQUITY_BRONZE, FX_BRONZE, FX_KEY, FX_STAGING, GOLD_RETURNS, SILVER, WEEKLY
from marketspark.sources import tables
from marketspark.sources.bronze import append_documents, parse_documents, read_documents, read_landed
from marketspark.sources.index import indexed_paths, new_objects, read_index, update_index
from marketspark.sources.universe import pair_frame
from marketspark.sources.versions import positions, publish_version, versions
from marketspark.streaming.landing import land_new_files, stage_new_files

LINEAGE = {"source": "fx", "ingestion_timestamp": "2026-09-01T00:00:00Z", "ingestion_id": "a"}
RATE = {"date": "2026-08-24", "base": "EUR", "quote": "USD", "rate": 1.0, **LINEAGE}
DAMAGED = ("{broken", {**RATE, "rate": "1.5"}, {**RATE, "rate": True}, {**RATE, "date": "24.08.2026"}, {**RATE, "base": None}, {**RATE, "rate": -1})
REASONS = sorted(["readable", "rate_type", "rate_type", "date_format", "required", "positive_rate"])


def rates(spark, *rows):
    return spark.createDataFrame(
        [(dt.date(2026, m, d), b, "USD", r) for m, d, b, r in rows], "date date, base string, quote string, rate double")


def shared(spark):
    return Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))


# Dead letters

def test_every_damage_is_a_letter_once(spark, documents, tmp_path):
    good = documents(RATE, *DAMAGED)
    target, dead = str(tmp_path / "silver"), str(tmp_path / "dead")
    before = {p.name for p in shared(spark).iterdir()} if shared(spark).exists() else set()
    for _ in range(2):
        assert jobs.bronze_to_silver(spark, good, str(tmp_path / "none"), target, dead=dead)
    letters = read_quarantine(spark, dead).collect()
    assert sorted(r.first_reason for r in letters) == REASONS
    assert {r.feed for r in letters} == {"rates"} and all(r.copies == 1 and r.source_file.endswith(".json") for r in letters)
    assert "{broken" in {r.document for r in letters}
    assert tables.read_by_date(spark, target, SILVER).count() == 1
    assert {p.name for p in shared(spark).iterdir()} == before  # no copy stays
    # a new version of a file adds its own letter, and the old one stays
    broken = Path(good) / "2026/08/24/r001.json"
    time.sleep(1.1)
    broken.write_text("{broken again")
    jobs.bronze_to_silver(spark, good, str(tmp_path / "none"), target, dead=dead)
    unreadable = [r.document for r in read_quarantine(spark, dead).collect() if r.first_reason == "readable"]
    assert sorted(unreadable) == ["{broken", "{broken again"]


def test_letters_are_kept_where_nothing_is_valid(spark, documents, tmp_path):
    bad, dead = documents(*DAMAGED, root="bad"), str(tmp_path / "dead")
    with pytest.raises(ValueError, match="silver is empty"):
        jobs.bronze_to_silver(spark, bad, str(tmp_path / "none"), str(tmp_path / "silver"), dead=dead)
    assert read_quarantine(spark, dead).count() == len(DAMAGED)


def test_texts_are_read_like_files(spark, documents):
    folder = documents(RATE, *DAMAGED)
    texts = spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v, indent=2),) for v in (RATE, *DAMAGED)], "value string")
    fields = [*FX_BRONZE.fieldNames(), "_corrupt_record"]
    read = lambda df: sorted(map(repr, df.select(*fields).collect()))
    assert read(parse_documents(texts, FX_BRONZE)) == read(read_documents(spark, folder, FX_BRONZE))


def test_stream_puts_letters_aside(spark, documents, tmp_path):
    root, target, dead = documents(RATE, *DAMAGED), str(tmp_path / "staging"), str(tmp_path / "dead")
    seen = []
    for _ in range(2):
        stage_new_files(
            spark, root, FX_BRONZE, stage_fx, target, FX_KEY, FX_ORDER, str(tmp_path / "offsets"), rules=fx_rules, feed="rates",
            dead=dead, changed=seen.append).awaitTermination()
    assert sorted(r.first_reason for r in read_quarantine(spark, dead).collect()) == REASONS
    assert tables.read_by_date(spark, target, FX_STAGING).count() == 1 and seen == ["2026-08-24"]


def test_overlapping_windows_count_a_record_once(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    fetched = spark.createDataFrame(
        [("2026-08-05", "EUR", "USD", -1.0), ("2026-08-06", "EUR", "USD", 1.0), ("no day", "EUR", "USD", 1.0)],
        "date string, base string, quote string, rate double")
    for window in (("2026-08-05", "2026-08-05"), ("2026-08-01", "2026-08-31"), ("2026-08-05", "2026-08-06")):
        jobs.land(fetched, paths.of("bronze", "rates"), FX_BRONZE, FX_KEY, "fx", window)
        jobs.stage(spark, paths, window)
    assert sorted((r.date, r.first_reason) for r in jobs.rejects(spark, paths, "rates").collect()) == [
        ("2026-08-05", "positive_rate"), ("no day", "date_format")]
    steps = {r.rule: (r.rows_before, r.rows_removed, r.rows_after) for r in jobs.attrition(spark, paths, "rates").collect()}
    assert steps["readable"] == (3, 0, 3) and steps["date_format"] == (3, 1, 2) and steps["positive_rate"] == (2, 1, 1)


def test_stage_parses_each_feed_once(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    window = ("2026-08-05", "2026-08-06")
    jobs.land(rates(spark, (8, 5, "EUR", 1.0), (8, 6, "EUR", -1.0)), paths.of("bronze", "rates"), FX_BRONZE, FX_KEY, "fx", window)
    ran, original = [], jobs.stored
    jobs.stored = lambda df, name: (ran.append(df._jdf.queryExecution().optimizedPlan().toString().count("json")), original(df, name))[1]
    try:
        assert jobs.stage(spark, paths, window)["rates"] == {"read": 2, "rejected": 1}
    finally:
        jobs.stored = original
    assert ran[0] > 0  # the documents are read where the copy is written, and all that follows reads the copy


def test_undated_records_of_earlier_runs_are_not_read_again(spark, tmp_path):
    root = str(tmp_path / "bronze")
    fetched = spark.createDataFrame([("no day", "EUR", "USD", 1.0, "fx", "", "1")], FX_BRONZE)
    append_documents(fetched, root)
    window = ("2026-08-05", "2026-08-06")
    assert read_landed(spark, root, FX_BRONZE, window, dt.date.today() - dt.timedelta(days=1)).count() == 1
    assert read_landed(spark, root, FX_BRONZE, window, dt.date.today() + dt.timedelta(days=2)).count() == 0


def test_a_store_is_run_by_what_is_new(spark, documents, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    root = documents(RATE, {**RATE, "date": "2026-08-25", "rate": 2.0}, "{broken", root="store")
    window = ("2026-08-01", "2026-08-31")
    assert jobs.run_store(spark, paths, root, str(tmp_path / "none"), window)
    assert not jobs.run_store(spark, paths, root, str(tmp_path / "none"), window)
    documents(RATE, RATE, RATE, {**RATE, "date": "2026-08-26", "rate": 4.0}, root="store")  # rewrites some files as well
    assert jobs.run_store(spark, paths, root, str(tmp_path / "none"), window)
    rows = tables.read_by_date(spark, paths.of("silver", "silver"), SILVER).collect()
    assert sorted((r.date.day, r.rate, r["return"]) for r in rows) == [(24, 1.0, None), (25, 2.0, 1.0), (26, 4.0, 1.0)]
    assert [r.document for r in read_quarantine(spark, paths.of("quarantine", "documents")).collect()] == ["{broken"]


# Maintained Gold

def test_changed_days(spark):
    row = "date date, name string, value double"
    make = lambda *rows: spark.createDataFrame([(dt.date(2026, 1, d), n, v) for d, n, v in rows], row)
    before = make((1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.0), (3, "a", None), (4, "a", 1.0), (6, "a", 1.0), (6, "a", 1.0))
    after = make((1, "b", 2.0), (1, "a", 1.0), (2, "a", 1.5), (3, "a", None), (5, "a", 1.0), (6, "a", 1.0))
    assert sorted(r.date.day for r in changed_days(before, after).collect()) == [2, 4, 5, 6]
    assert changed_days(before, before).count() == 0


def gold(spark, paths):
    returns = sorted(tuple(map(repr, r)) for r in jobs.read_returns(spark, paths).collect())
    return returns, sorted(tuple(map(repr, r)) for r in jobs.read_weekly(spark, paths).collect())


def parts(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


@pytest.mark.parametrize("grain", ["day", "month"])
def test_maintained_gold_equals_a_rebuild_and_leaves_other_partitions_alone(spark, tmp_path, grain):
    paths, full = jobs.Paths(str(tmp_path / "lake")), jobs.Paths(str(tmp_path / "full"))
    steps = [
        (("2026-08-28", "2026-08-28"), ((8, 28, "EUR", 2.0),)),
        (("2026-06-01", "2026-07-31"), ((6, 1, "EUR", 1.0), (7, 30, "EUR", 4.0), (7, 31, "GBP", 3.0))),
        (("2026-10-30", "2026-11-02"), ((10, 30, "EUR", 3.0), (11, 1, "EUR", 6.0), (11, 2, "GBP", 9.0))),  # a week of two months
        (("2026-07-31", "2026-08-02"), ((8, 1, "EUR", 8.0),)),
    ]
    for window, rows in steps:
        before = parts(paths.of("gold", "daily_returns")) if Path(paths.of("gold", "daily_returns")).exists() else {}
        jobs.run(spark, paths, window, rates(spark, *rows), grain=grain)
    after = parts(paths.of("gold", "daily_returns"))
    # the last window changed August alone: its own day, and the return of the 28th; June and October stay as they were
    kept = {name for name in before if name in after and before[name] == after[name]}
    assert {name.split("/")[1] for name in kept} == {"month=06", "month=07", "month=10", "month=11"}
    jobs.run(spark, full, ("2026-06-01", "2026-11-30"), rates(spark, *[r for _, rows in steps for r in rows]), grain=grain, rebuild=True)
    assert gold(spark, paths) == gold(spark, full) and len(gold(spark, full)[0]) == 8


def test_a_run_that_changes_nothing_rewrites_no_gold(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    for _ in range(2):
        jobs.run(spark, paths, ("2026-08-03", "2026-08-04"), rates(spark, (8, 3, "EUR", 1.0), (8, 4, "EUR", 2.0)))
        before = parts(paths.of("gold", "weekly_performance"))
    assert parts(paths.of("gold", "weekly_performance")) == before
    assert len(versions(spark, paths.of("analytics", "weekly_summary"))) == 1


def test_months_of_a_run_that_failed_half_way_are_made_up_for(spark, tmp_path, monkeypatch):
    paths = jobs.Paths(str(tmp_path / "lake"))
    jobs.run(spark, paths, ("2026-08-03", "2026-08-03"), rates(spark, (8, 3, "EUR", 1.0)))
    def stop(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "build_returns", stop)  # Silver is published by then, Gold is not
        with pytest.raises(RuntimeError, match="lost"):
            jobs.run(spark, paths, ("2026-07-01", "2026-07-01"), rates(spark, (7, 1, "EUR", 4.0)))
    jobs.run(spark, paths, ("2026-09-01", "2026-09-01"), rates(spark, (9, 1, "EUR", 2.0)))
    assert sorted((r.date.month, r.eur_usd) for r in jobs.read_returns(spark, paths).collect()) == [(7, None), (8, -0.75), (9, 1.0)]
    assert sorted(r.week_start.month for r in jobs.read_weekly(spark, paths).collect()) == [6, 8, 8]


def test_gold_reads_the_months_it_rewrites(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    jobs.run(spark, paths, ("2026-06-01", "2026-08-31"), rates(spark, (6, 1, "EUR", 1.0), (7, 1, "EUR", 2.0), (8, 3, "EUR", 4.0)))
    rows = jobs._published(spark, paths, [20260700])
    assert len(rows.inputFiles()) > 0 and rows.count() == 1
    scan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
    assert tables.months_after([20261200, 20260100]) == [20270100, 20260200]


# Versions

def test_a_reader_sees_one_version(spark, tmp_path):
    root = str(tmp_path / "table")
    publish_version(spark.range(3), root)
    opened = tables.read_table(spark, root)
    publish_version(spark.range(5), root)
    assert opened.count() == 3 and tables.read_table(spark, root).count() == 5


def test_a_failed_write_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "table")
    publish_version(spark.range(3), root)
    broken = spark.range(100).repartition(4).select(F.expr("if(id = 57, raise_error('lost'), id)").cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish_version(broken, root)
    assert tables.read_table(spark, root).count() == 3 and len(versions(spark, root)) == 1
    # the next version may be made of the one before
    publish_version(tables.read_table(spark, root).unionByName(spark.range(3, 4)), root)
    assert tables.read_table(spark, root).count() == 4


def test_old_versions_go(spark, tmp_path):
    root = tmp_path / "table"
    for n in range(5):
        publish_version(spark.range(n + 1), str(root), keep=2)
    names = versions(spark, str(root))
    assert len(names) == 2 and sorted(p.name for p in root.glob("v*")) == names
    assert tables.read_table(spark, str(root)).count() == 5
    plain = str(tmp_path / "plain")
    tables.write_table(spark.range(2), plain)
    assert tables.read_table(spark, plain).count() == 2


def test_sorted_files_have_gapless_positions(spark, tmp_path):
    root = str(tmp_path / "sorted")
    publish_version(spark.range(1000).selectExpr("(id * 7919) % 1000 as n", "id % 3 as m"), root, order=("n", "m"))
    rows = positions(spark, tables.current(spark, root)).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 1001)) and [r.n for r in rows] == list(range(1000))
    text = spark.range(10).repartitionByRange("id")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in text


# Streams

EVENT = "date string, base string, quote string, rate double, at string, ingestion_id string"


def test_the_stream_lands_the_first_of_each_key(spark, tmp_path):
    schema = spark.createDataFrame([], EVENT).schema
    root, target, offsets = (str(tmp_path / n) for n in ("drops", "bronze", "offsets"))

    def drop(*rows):
        append_documents(spark.createDataFrame([(f"2026-08-{d:02d}", b, "USD", r, at, "") for d, b, r, at in rows], EVENT), root)
        land_new_files(spark, root, schema, FX_KEY, ("at",), target, offsets, "events", multi_line=False).awaitTermination()
        return sorted((r.date, r.base or "", r.rate) for r in read_landed(spark, target, schema).collect())

    first = [("2026-08-01", "", 7.0), ("2026-08-01", "EUR", 2.0), ("2026-08-02", "EUR", 3.0)]
    assert drop((1, "EUR", 1.0, "09:30"), (1, "EUR", 2.0, "09:10"), (2, "EUR", 3.0, "09:00"), (1, None, 7.0, "09:00")) == first
    # an earlier time in a later drop changes nothing, and neither does the same record without a key
    second = drop((1, "EUR", 9.0, "08:00"), (3, "GBP", 4.0, "09:00"), (1, None, 7.0, "09:00"), (1, None, 8.0, "09:00"))
    assert second == sorted([*first, ("2026-08-03", "GBP", 4.0), ("2026-08-01", "", 8.0)])
    assert drop((2, "EUR", 5.0, "01:00")) == second


# Outcomes

def test_outcomes_of_runs(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    pairs = pair_frame(spark, [("EUR", "USD"), ("GBP", "USD"), ("AUD", "USD")])
    failed = spark.createDataFrame([("AUD", "USD")], "base string, quote string")
    fetched = rates(spark, (8, 3, "EUR", 1.0), (8, 4, "EUR", 1.0), (8, 4, "EUR", 2.0))
    expected = {("AUD", "failed", 0, 0), ("EUR", "successful", 2, 1), ("GBP", "successful", 0, 0)}
    read = lambda: {(r.base, r.status, r.uploaded, r.skipped) for r in jobs.read_outcomes(spark, paths).where("run = 'a'").collect()}
    jobs.run(spark, paths, ("2026-08-03", "2026-08-04"), fetched, pairs=pairs, failures=failed, run_key="a")
    assert read() == expected
    jobs.run(spark, paths, ("2026-08-03", "2026-08-04"), fetched, pairs=pairs, failures=failed, run_key="b")
    assert read() == expected  # another run has its own rows
    jobs.run(spark, paths, ("2026-08-03", "2026-08-04"), fetched, pairs=pairs, run_key="a")
    assert read() == {("AUD", "successful", 0, 0), ("EUR", "successful", 0, 2), ("GBP", "successful", 0, 0)}  # replaced


# Models

def test_plans_follow_the_declarations():
    names = lambda target: [m.name for m in models.plan(models.MODELS, target)]
    assert names("silver") == ["silver"]
    assert set(names("+silver")) == {"staging_fx", "staging_equity", "observations", "silver"} and names("+silver")[-1] == "silver"
    assert len(names("*")) == len(models.MODELS)
    with pytest.raises(ValueError, match="no model"):
        names("+nothing")
    with pytest.raises(ValueError, match="kind"):
        models.Model("x", "snapshot", (), stage_fx)
    with pytest.raises(ValueError, match="key"):
        models.Model("x", "incremental", (), stage_fx)
    loop = [models.Model("a", "view", ("b",), stage_fx), models.Model("b", "view", ("a",), stage_fx)]
    with pytest.raises(ValueError):
        models.plan(loop, "+a")


def test_kinds_of_models(spark, tmp_path):
    root = str(tmp_path / "models")
    bronze = lambda *rows: spark.createDataFrame(
        [(f"2026-08-{d:02d}", b, "USD", r, "fx", at, str(i)) for i, (d, b, r, at) in enumerate(rows)], FX_BRONZE)
    bars = spark.createDataFrame([], EQUITY_BRONZE)
    run = lambda target, *rows: models.build(
        spark, models.MODELS, target, {"bronze_fx": bronze(*rows), "bronze_equity": bars}, "kinds", root)
    try:
        run("+weekly_performance", (3, "EUR", 1.0, "2026-09-01"), (4, "EUR", 2.0, "2026-09-01"))
        # an incremental model keeps what the second build does not touch
        built = run("+gold_returns", (4, "EUR", 3.0, "2026-09-02"))
        assert built == ["staging_fx", "staging_equity", "observations", "silver", "gold_returns"]
        assert sorted((r.date.day, r.rate) for r in spark.table("kinds.staging_fx").collect()) == [(3, 1.0), (4, 3.0)]
        assert sorted((r.date.day, r.eur_usd) for r in spark.table("kinds.gold_returns").collect()) == [(3, None), (4, 2.0)]
        assert spark.table("kinds.weekly_performance").first().end_rate == 2.0  # not selected, not rebuilt
        assert "kinds_observations" in {t.name for t in spark.catalog.listTables()}
    finally:
        spark.sql("drop database if exists kinds cascade")
        spark.catalog.dropTempView("kinds_observations")


# Index

def test_the_index_takes_new_objects_only(spark, documents, tmp_path):
    root, index = documents(RATE, RATE), str(tmp_path / "index")
    assert new_objects(spark, root, index).count() == 2
    update_index(spark, root, index)
    assert new_objects(spark, root, index).count() == 0
    time.sleep(1.1)
    documents(RATE, RATE, RATE)  # rewrites both and adds one
    assert new_objects(spark, root, index).count() == 3
    update_index(spark, root, index)
    assert indexed_paths(spark, index).count() == 3 and read_index(spark, index).count() == 3
    update_index(spark, root, index)
    assert read_index(spark, index).count() == 3


# Strict casts

@pytest.mark.parametrize(("field", "value"), [("rate", "1.5"), ("rate", True), ("date", "24.08.2026")])
def test_strict_rates(spark, documents, field, value):
    clean = read_documents(spark, documents(RATE), FX_BRONZE)
    assert stage_fx(clean, strict=True).count() == 1
    damaged = read_documents(spark, documents(RATE, {**RATE, field: value}, root="damaged"), FX_BRONZE)
    assert stage_fx(damaged).count() == 1
    with pytest.raises(Exception, match=f"{field} cannot be read.*base=EUR"):
        stage_fx(damaged, strict=True).collect()


def test_strict_bars(spark):
    bar = ("2026-08-24", "^A", "1", "1", "1", "1", "1", "7", "eq", "2026-09-01", "a")
    rows = lambda **bad: spark.createDataFrame([tuple({**dict(zip(EQUITY_BRONZE.fieldNames(), bar)), **bad}.values())], EQUITY_BRONZE)
    assert stage_equity(rows(), strict=True).count() == 1 and stage_equity(rows(volume=None), strict=True).count() == 1
    assert stage_equity(rows(high="x")).count() == 0
    for field in ("high", "volume", "date"):
        with pytest.raises(Exception, match=f"{field} cannot be read.*ticker"):
            stage_equity(rows(**{field: "x"}), strict=True).collect()


def test_a_strict_run_fails_and_publishes_nothing(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    fetched = spark.createDataFrame([("2026-08-24", "EUR", "USD", 1.0), ("nonsense", "EUR", "USD", 1.0)], "date string, base string, quote string, rate double")
    with pytest.raises(Exception, match="date cannot be read"):
        jobs.run(spark, paths, ("2026-08-24", "2026-08-24"), fetched, strict=True)
    assert not (tmp_path / "lake" / "silver").exists()
    jobs.run(spark, paths, ("2026-08-24", "2026-08-24"), fetched)
    assert tables.read_by_date(spark, paths.of("silver", "silver"), SILVER).count() == 1


def test_layouts(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    jobs.run(spark, paths, ("2026-08-24", "2026-08-24"), rates(spark, (8, 24, "EUR", 1.0)))
    assert jobs.read_returns(spark, paths).schema == GOLD_RETURNS and jobs.read_weekly(spark, paths).schema == WEEKLY
    assert layers.ordered(jobs.read_weekly(spark, paths), "weekly").count() == 1
