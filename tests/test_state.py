import datetime as dt

import pytest

from marketspark.operators.upsert import upsert
from marketspark.plans import jobs, layers
from marketspark.plans.staging import FX_ORDER, stage_fx
from marketspark.schemas import FX_BRONZE, FX_KEY, FX_STAGING, SILVER
from marketspark.session import stored
from marketspark.sources import tables
from marketspark.sources.bronze import append_documents, read_landed
from marketspark.sources.universe import parse_tickers
from marketspark.streaming.landing import stage_new_files

SHAPE = "date date, base string, quote string, rate double, ingestion_timestamp timestamp, ingestion_id string"


def batch(spark, *rows):
    at = dt.datetime(2026, 9, 1)
    return spark.createDataFrame(
        [(dt.date(2026, m, d), b, "USD", rate, at, str(i)) for i, (m, d, b, rate) in enumerate(rows)], SHAPE)


def content(spark, path, schema=None):
    df = tables.read_by_date(spark, path, schema or batch(spark, (1, 1, "EUR", 1.0)).schema)
    return sorted((r.date.month, r.date.day, r.base, r.rate) for r in df.collect())


@pytest.mark.parametrize("grain", ["day", "month"])
def test_upsert_laws(spark, tmp_path, grain):
    path = str(tmp_path / "t")
    apply = lambda *rows: upsert(batch(spark, *rows), path, FX_KEY, FX_ORDER, grain)
    first = [(8, 24, "EUR", 1.0), (8, 24, "GBP", 2.0), (9, 1, "EUR", 3.0)]
    apply(*first)
    assert content(spark, path) == sorted(first)
    apply(*first)
    assert content(spark, path) == sorted(first)
    # the last batch wins per key, other keys of the date and other dates stay
    apply((8, 24, "EUR", 1.5), (8, 25, "EUR", 4.0))
    assert content(spark, path) == [(8, 24, "EUR", 1.5), (8, 24, "GBP", 2.0), (8, 25, "EUR", 4.0), (9, 1, "EUR", 3.0)]
    # a key twice in one batch: the later row
    apply((9, 1, "EUR", 7.0), (9, 1, "EUR", 8.0))
    assert content(spark, path)[-1] == (9, 1, "EUR", 8.0)
    # a sparse batch leaves the dates between alone; an empty one changes nothing
    apply((7, 1, "EUR", 0.5), (10, 1, "EUR", 0.6))
    upsert(batch(spark, *first).limit(0), path, FX_KEY, FX_ORDER, grain)
    assert len(content(spark, path)) == 6


def test_windows_with_other_keys_commute(spark, tmp_path):
    early, late = [(8, 24, "EUR", 1.0)], [(8, 24, "GBP", 2.0), (9, 3, "GBP", 3.0)]
    for name, order in (("a", (early, late)), ("b", (late, early))):
        for rows in order:
            upsert(batch(spark, *rows), str(tmp_path / name), FX_KEY, FX_ORDER)
    assert content(spark, str(tmp_path / "a")) == content(spark, str(tmp_path / "b"))


def test_day_directories(spark, tmp_path):
    path = tmp_path / "silver"
    df = batch(spark, (8, 4, "EUR", 1.0), (12, 31, "EUR", 2.0))
    tables.write_by_date(df, str(path))
    assert (path / "year=2026" / "month=08" / "day=04").is_dir()
    assert (path / "year=2026" / "month=12" / "day=31").is_dir()
    only = tables.read_by_date(spark, str(path), df.schema, (20261201, 20261231))
    assert [r.rate for r in only.collect()] == [2.0]
    scan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan


def test_nothing_written_yet(spark, tmp_path):
    assert tables.read_by_date(spark, str(tmp_path / "none"), SILVER) is None
    assert read_landed(spark, str(tmp_path / "none"), FX_BRONZE).count() == 0


def records(spark, *rows, at="2026-09-01T00:00:00Z"):
    return spark.createDataFrame(
        [(f"2026-{m:02d}-{d:02d}", b, "USD", rate, "fx", at, str(i))
         for i, (m, d, b, rate) in enumerate(rows)], FX_BRONZE)


def test_stream_reads_new_files_once_and_equals_batch(spark, tmp_path):
    root, target, offsets = (str(tmp_path / n) for n in ("bronze", "staging", "offsets"))

    def run():
        query = stage_new_files(spark, root, FX_BRONZE, stage_fx, target, FX_KEY, FX_ORDER, offsets,
                                multi_line=False)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    append_documents(records(spark, (8, 24, "EUR", 1.0), (8, 24, "E1R", 1.0), (8, 25, "EUR", 2.0)), root)
    assert run() == 3
    append_documents(records(spark, (8, 24, "GBP", 3.0), (8, 25, "EUR", 2.5), at="2026-09-02T00:00:00Z"), root)
    assert run() == 2
    assert run() == 0
    expected = [(8, 24, "EUR", 1.0), (8, 24, "GBP", 3.0), (8, 25, "EUR", 2.5)]
    assert content(spark, target, FX_STAGING) == expected


@pytest.mark.parametrize("files", [1, 100])
def test_the_stream_does_not_depend_on_the_size_of_its_steps(spark, tmp_path, files):
    root, target = str(tmp_path / "bronze"), str(tmp_path / "staging")
    # the later record of a key lies in the earlier file
    for number, at in enumerate(("2026-09-03", "2026-09-02", "2026-09-01")):
        append_documents(records(spark, (8, 24, "EUR", 10.0 - number), (8, 25 + number, "GBP", 1.0), at=f"{at}T00:00:00Z"), root)
    stage_new_files(spark, root, FX_BRONZE, stage_fx, target, FX_KEY, FX_ORDER, str(tmp_path / "offsets"),
                    multi_line=False, files_per_batch=files).awaitTermination()
    assert content(spark, target, FX_STAGING) == [
        (8, 24, "EUR", 10.0), (8, 25, "GBP", 1.0), (8, 26, "GBP", 1.0), (8, 27, "GBP", 1.0)]


def test_upsert_reads_touched_partitions_only_and_leaves_no_copy(spark, tmp_path):
    path = str(tmp_path / "table")
    upsert(batch(spark, (1, 1, "EUR", 1.0), (6, 1, "EUR", 2.0), (12, 1, "EUR", 3.0)), path, FX_KEY, FX_ORDER)
    only = tables.read_by_date(spark, path, batch(spark, (1, 1, "EUR", 1.0)).schema, only=[20260100, 20261200])
    scan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan
    assert sorted(r.rate for r in only.collect()) == [1.0, 3.0]
    from pathlib import Path
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("batch-*"))
    upsert(batch(spark, (6, 1, "EUR", 9.0)), path, FX_KEY, FX_ORDER)
    assert set(shared.glob("batch-*")) == before


def test_first_arrival_lands_whatever_its_value(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    window = ("2026-08-24", "2026-08-25")
    fetched = spark.createDataFrame(
        [("2026-08-24", "EUR", "USD", 9.0), ("2026-08-24", "EUR", "USD", 2.0), ("2026-08-25", "EUR", None, 3.0),
         ("2026-08-25", "EUR", None, 4.0), ("2026-08-25", "EUR", None, 3.0)],
        "date string, base string, quote string, rate double").coalesce(1)
    for _ in range(3):
        jobs.run(spark, paths, window, fetched)
        bronze = read_landed(spark, paths.of("bronze", "rates"), FX_BRONZE).collect()
        assert sorted((r.date, r.rate) for r in bronze) == [("2026-08-24", 9.0), ("2026-08-25", 3.0), ("2026-08-25", 4.0)]
    rejects = jobs.rejects(spark, paths, "rates").collect()
    assert sorted((r.rate, r.first_reason) for r in rejects) == [(3.0, "required"), (4.0, "required")]
    steps = jobs.attrition(spark, paths, "rates").where("rows_removed > 0").collect()
    assert [(r.rule, r.rows_before, r.rows_after) for r in steps] == [("required", 3, 1)]


def test_windows_out_of_order_and_refusals(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    jobs.run(spark, paths, ("2026-08-28", "2026-08-28"), rates(spark, (28, "EUR", 2.0)))
    jobs.run(spark, paths, ("2026-08-03", "2026-08-03"), rates(spark, (3, "EUR", 1.0)))
    silver = tables.read_by_date(spark, paths.of("silver", "silver"), SILVER)
    assert sorted((r.date.day, r["return"]) for r in silver.collect()) == [(3, None), (28, 1.0)]
    with pytest.raises(ValueError, match="later than the start"):
        jobs.run(spark, paths, ("2026-08-01", "2026-08-31"), rates(spark, (4, "EUR", 1.0)), since="2026-08-28")
    with pytest.raises(ValueError, match="partitioned by day"):
        jobs.run(spark, paths, ("2026-08-01", "2026-08-31"), rates(spark, (4, "EUR", 1.0)), grain="month")
    assert read_landed(spark, paths.of("bronze", "rates"), FX_BRONZE).count() == 2


def test_a_rebuild_keeps_no_stale_partition(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    source = lambda *rows: batch(spark, *rows).selectExpr("*", "'fx' as source").select(*FX_STAGING.fieldNames())
    tables.write_by_date(source((8, 3, "EUR", 1.0), (9, 4, "EUR", 2.0)), paths.of("staging", "rates"), "month")
    jobs.build_silver(spark, paths)
    tables.write_by_date(source((8, 3, "EUR", 1.0)), paths.of("staging", "rates"), "month", replace=True)
    jobs.build_silver(spark, paths)
    assert tables.read_by_date(spark, paths.of("models", "silver"), SILVER).count() == 1


def test_an_unfinished_run_is_made_up_for(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    jobs.run(spark, paths, ("2026-08-28", "2026-08-28"), rates(spark, (28, "EUR", 2.0)))
    jobs._note(spark, paths, "lost", "2026-08-03")  # it staged, and then the driver went away
    source = batch(spark, (8, 3, "EUR", 1.0)).selectExpr("*", "'fx' as source").select(*FX_STAGING.fieldNames())
    upsert(source, paths.of("staging", "rates"), FX_KEY, FX_ORDER)
    jobs.run(spark, paths, ("2026-08-29", "2026-08-29"), rates(spark, (29, "EUR", 4.0)))
    silver = tables.read_by_date(spark, paths.of("silver", "silver"), SILVER)
    assert sorted((r.date.day, r["return"]) for r in silver.collect()) == [(3, None), (28, 1.0), (29, 1.0)]
    assert jobs.changed_from(spark, paths) is None  # and is not made up for again


BAR = ("Open", "High", "Low", "Close", "Adj Close", "Volume")


def vendor(spark, *rows):
    cells = [(dt.date(2026, 8, day), c, c, c, c, c, 1) for day, c in rows]
    names = ["Date date", *[f"`^GSPC|{f}` {'bigint' if f == 'Volume' else 'double'}" for f in BAR]]
    return spark.createDataFrame(cells, ", ".join(names))


def rates(spark, *rows):
    return spark.createDataFrame(
        [(dt.date(2026, 8, d), b, "USD", r) for d, b, r in rows], "date date, base string, quote string, rate double")


def test_run_twice_and_a_later_window(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    tickers = parse_tickers("^GSPC,^NONE")
    window = ("2026-08-24", "2026-08-25")

    def market():
        rows = tables.read_table(spark, paths.of("gold", "market_data")).orderBy("date").collect()
        return [(r.date.day, r.eur_usd, r.gspc, r.eur_usd_log_return is None) for r in rows]

    jobs.run(spark, paths, window, rates(spark, (24, "EUR", 1.0), (25, "EUR", 2.0), (26, "EUR", 9.0)),
             bars=vendor(spark, (24, 10.0), (25, 11.0)), tickers=tickers)
    first = [(24, 1.0, 10.0, True), (25, 2.0, 11.0, False)]
    assert market() == first
    # Bronze is first-wins: a second fetch of the same days changes nothing
    jobs.run(spark, paths, window, rates(spark, (24, "EUR", 5.0), (25, "EUR", 6.0)))
    assert market() == first
    # staging accumulates, Gold holds the window only, Silver looks back past it
    jobs.run(spark, paths, ("2026-08-26", "2026-08-26"), rates(spark, (26, "EUR", 4.0)), since="2026-08-26")
    assert market() == [(26, 4.0, None, True)]
    silver = tables.read_by_date(spark, paths.of("silver", "silver"), SILVER)
    got = {(r.instrument, r.date.day): r["return"] for r in silver.collect()}
    assert got[("EUR/USD", 26)] == 1.0 and got[("^GSPC", 25)] == pytest.approx(0.1)
    weekly = tables.read_table(spark, paths.of("analytics", "latest_performance")).collect()
    assert [(r.base, r.start_rate, r.end_rate, r.weekly_return_pct) for r in weekly] == [("EUR", 1.0, 4.0, 300.0)]
    assert tables.read_table(spark, paths.of("analytics", "weekly_summary")).count() == 1
    assert tables.run_query(
        spark, "select count(*) from weekly_performance where base = ? and end_rate > ?", ["EUR", 3]
    ).first()[0] == 1


def test_refresh_equals_rebuild(spark, tmp_path):
    paths, full = jobs.Paths(str(tmp_path / "lake")), jobs.Paths(str(tmp_path / "full"))

    def table(at):
        rows = tables.read_by_date(spark, at.of("models", "silver"), SILVER).collect()
        return sorted(tuple(map(repr, r)) for r in rows)

    def stage(*rows):
        for at in (paths, full):
            source = batch(spark, *rows).selectExpr("*", "'fx' as source").select(*FX_STAGING.fieldNames())
            upsert(source, at.of("staging", "rates"), FX_KEY, FX_ORDER)

    stage((7, 30, "EUR", 1.0), (7, 30, "GBP", 5.0), (8, 24, "EUR", 2.0), (9, 7, "EUR", 8.0))
    jobs.refresh_silver(spark, paths, "2026-07-30")
    # a late window in the middle changes its own days and the return that follows it
    stage((8, 24, "EUR", 4.0), (8, 25, "GBP", 6.0), (8, 25, "AUD", 1.0))
    jobs.refresh_silver(spark, paths, "2026-08-24")
    jobs.build_silver(spark, full)
    assert table(paths) == table(full) and len(table(full)) == 6
    # months: the whole month of the window is rebuilt
    stage((9, 8, "EUR", 16.0))
    jobs.refresh_silver(spark, paths, "2026-09-08")
    jobs.build_silver(spark, full)
    assert table(paths) == table(full)


def test_catalog_table_is_published_through_the_gate(spark, tmp_path):
    tables.save_table(spark.range(3), "three")
    jobs.publish_table(spark, "three", str(tmp_path / "three"))
    assert tables.read_table(spark, str(tmp_path / "three")).count() == 3
    tables.save_table(spark.range(0), "three")
    with pytest.raises(ValueError, match="three is empty"):
        jobs.publish_table(spark, "three", str(tmp_path / "three"))
    assert tables.read_table(spark, str(tmp_path / "three")).count() == 3
    spark.sql("drop table three")


def test_bronze_to_silver(spark, documents, tmp_path):
    target = str(tmp_path / "silver")
    assert not jobs.bronze_to_silver(spark, str(tmp_path / "no"), str(tmp_path / "none"), target)
    lineage = {"source": "fx", "ingestion_timestamp": "2026-09-01T00:00:00Z", "ingestion_id": "a"}
    rate = {"date": "2026-08-24", "base": "eur", "quote": "USD", "rate": 1.0, **lineage}
    bad = documents({**rate, "rate": -1}, root="bad")
    with pytest.raises(ValueError, match="silver is empty"):
        jobs.bronze_to_silver(spark, bad, str(tmp_path / "none"), target)
    assert tables.read_by_date(spark, target, SILVER) is None
    good = documents(rate, {**rate, "date": "2026-08-25", "rate": 1.5}, "{broken", root="good")
    bar = {"date": "2026-08-24", "ticker": "^A", "open": 1, "high": 1, "low": 1, "close": 1, "adj_close": 1,
           "volume": None, **lineage, "source": "eq"}
    assert jobs.bronze_to_silver(spark, good, documents(bar, root="bars"), target)
    rows = layers.ordered(tables.read_by_date(spark, target, SILVER), "silver").collect()
    assert [(r.date.day, r.instrument, r["return"]) for r in rows] == [
        (24, "^A", None), (24, "EUR/USD", None), (25, "EUR/USD", 0.5)]


def test_a_bad_record_does_not_stop_the_run(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    fetched = spark.createDataFrame(
        [("2026-08-24", "EUR", "USD", 1.0), ("24.08.2026", "EUR", "USD", 2.0), ("2026-8-25", "EUR", "USD", 3.0),
         ("2026-08-25", "EUR", None, 3.0)],
        "date string, base string, quote string, rate double")
    window = ("2026-08-24", "2026-08-25")
    for _ in range(2):
        jobs.run(spark, paths, window, fetched)
    bronze = read_landed(spark, paths.of("bronze", "rates"), FX_BRONZE, window).collect()
    assert [r.date for r in bronze].count("24.08.2026") == 1
    silver = layers.ordered(tables.read_by_date(spark, paths.of("silver", "silver"), SILVER), "silver").collect()
    assert [(r.date.day, r.rate) for r in silver] == [(24, 1.0), (25, 3.0)]


def test_an_empty_run_is_refused_before_publishing(spark, tmp_path):
    paths = jobs.Paths(str(tmp_path / "lake"))
    with pytest.raises(ValueError, match="silver"):
        jobs.run(spark, paths, ("2026-08-24", "2026-08-25"))
    assert not (tmp_path / "lake" / "silver").exists()


def test_bronze_to_silver_keeps_no_copy_without_dead_letters(spark, documents, tmp_path, monkeypatch):
    names = []
    monkeypatch.setattr(jobs, "stored", lambda df, name: names.append(name) or stored(df, name))
    bar = {"date": "2026-08-24", "ticker": "A", "open": 10.0, "high": 12.0, "low": 9.0, "close": 11.0, "adj_close": 11.0, "volume": 5}
    bars = documents(bar, {**bar, "open": -1}, "not json", root="bars")
    assert jobs.bronze_to_silver(spark, str(tmp_path / "none"), bars, str(tmp_path / "silver"))
    assert names == ["silver"]
    assert [r.instrument for r in spark.read.parquet(str(tmp_path / "silver")).collect()] == ["A"]
