import datetime as dt

import pytest

from marketspark.operators import coverage as cov
from marketspark.operators import landing
from marketspark.plans import catalog
from marketspark.schemas import FX_BRONZE, FX_KEY
from marketspark.session import scratch, setting
from marketspark.sources import bronze
from marketspark.sources.universe import pair_frame, parse_pairs, parse_tickers
from marketspark.sources.vendor import wide_to_long
from marketspark.functions.text import safe_ticker


def d(day):
    return dt.date(2026, 8, day)


def keys(spark, *values):
    return spark.createDataFrame([(d(day), b, q) for day, b, q in values], "date date, base string, quote string")


def test_universe():
    assert parse_pairs(" eur/usd , ,GBP/USD") == [("EUR", "USD"), ("GBP", "USD")]
    with pytest.raises(ValueError, match="EURUSD"):
        parse_pairs("EURUSD,GBP/USD")
    assert parse_pairs("EURUSD,GBP/USD", strict=False) == [("GBP", "USD")]
    for parse in (parse_pairs, parse_tickers):
        with pytest.raises(ValueError, match="no"):
            parse(" , ")
    assert parse_tickers(" ^GSPC, brk.B") == ["^GSPC", "brk.B"]


def test_paths_to_coverage(spark):
    paths = spark.createDataFrame([(p,) for p in (
        "b/rates/2026/08/24/EUR_USD.json", "b/rates/2026/08/26/EUR_USD.json", "b/rates/2026/08/26/EUR_USD.json",
        "b/rates/2026/13/26/EUR_USD.json", "b/rates/2026/08/26/EURUSD.json", "b/rates/2026/08/26/A_B_C.json",
        "b/rates/2026/08/26/EUR_USD.txt",
    )], "path string")
    report = cov.coverage(cov.keys_from_paths(paths)).collect()
    assert [tuple(r) for r in report] == [("EUR/USD", 3, d(24), d(26), 3, 2)]
    assert tuple(cov.coverage_totals(cov.coverage(cov.keys_from_paths(paths))).first()) == (1, 3, 3)


def test_missing_dates(spark):
    universe = pair_frame(spark, [("EUR", "USD"), ("GBP", "USD"), ("USD", "JPY")])
    present = keys(spark, (24, "EUR", "USD"), (26, "EUR", "USD"), (24, "GBP", "USD"), (25, "GBP", "USD"),
                   (26, "GBP", "USD"), (1, "USD", "JPY"))
    report = {r.pair: [x.day for x in r.missing]
              for r in cov.missing_report(universe, present, "2026-08-24", "2026-08-26").collect()}
    assert report == {"EUR/USD": [25], "GBP/USD": [], "USD/JPY": [24, 25, 26]}
    work = landing.work_list(universe, present, "2026-08-24", "2026-08-26").collect()
    assert len(work) == 4
    assert "2026/08/25/EUR_USD.json" in {r.path for r in work}


def test_keep_first_and_summary(spark):
    batch = spark.createDataFrame(
        [(d(24), "EUR", "USD", 1), (d(25), "EUR", "USD", 3), (d(25), "EUR", "USD", 2), (d(25), "GBP", "USD", 9)],
        "date date, base string, quote string, arrived int",
    )
    known = keys(spark, (24, "EUR", "USD"), (24, "EUR", "USD"))
    landed = landing.keep_first(batch, known, FX_KEY, ["arrived"]).collect()
    assert sorted((r.date.day, r.base, r.arrived) for r in landed) == [(25, "EUR", 2), (25, "GBP", 9)]
    summary = {r.base: (r.uploaded, r.skipped)
               for r in landing.landing_summary(batch, known, FX_KEY, ("base", "quote")).collect()}
    assert summary == {"EUR": (1, 2), "GBP": (1, 0)}


def test_one_bad_pair_does_not_stop_the_others(spark):
    universe = pair_frame(spark, [("EUR", "USD"), ("E1R", "USD"), ("AUD", "USD")])
    batch = keys(spark, (24, "EUR", "USD"), (25, "EUR", "USD"), (25, "EUR", "USD"))
    outcomes = landing.pair_outcomes(universe, batch, keys(spark, (24, "EUR", "USD")), "2026-08-24", "2026-08-26")
    assert {(r.base, r.status): (r.uploaded, r.skipped) for r in outcomes.collect()} == {
        ("EUR", "successful"): (1, 2), ("E1R", "failed"): (0, 0), ("AUD", "successful"): (0, 0)}
    assert tuple(landing.outcome_totals(outcomes).first()) == (2, 1, 1, 2)
    # a fetch that the caller reports as failed
    told = landing.pair_outcomes(universe, batch.limit(0), batch.limit(0), "2026-08-24", "2026-08-26", pair_frame(spark, [("AUD", "USD")]))
    assert {r.base for r in told.where("status = 'failed'").collect()} == {"E1R", "AUD"}


def test_enrich(spark):
    rows = landing.enrich(spark.range(100), "fx").collect()
    assert {r.source for r in rows} == {"fx"} and len({r.ingestion_id for r in rows}) == 100
    assert dt.datetime.fromisoformat(rows[0].ingestion_timestamp).utcoffset() == dt.timedelta(0)


def test_tickers_that_share_a_path_stay_distinct_keys(spark):
    df = spark.createDataFrame([("^A",), ("/A",), (" A",)], "ticker string")
    assert {r[0] for r in df.selectExpr(safe_ticker("ticker")).collect()} == {"_A"}
    dated = df.selectExpr("date '2026-08-24' as date", "ticker")
    assert landing.keep_first(dated, dated.limit(0), ["date", "ticker"], ["ticker"]).count() == 3


FIELDS = ("Open", "High", "Low", "Close", "Adj Close", "Volume")


def wide(spark, nested=False):
    nan = float("nan")
    cells = [("2026-08-24", 1.0, 2.0, 0.5, 1.5, 1.5, 7, None, 2.0, 1.0, 1.5, nan, None),
             ("2026-08-25", 1.0, 2.0, 0.5, nan, 1.5, 7, 3.0, 2.0, 1.0, None, 1.5, 4)]
    names = ["Date", *[f"BRK.B|{f}" for f in FIELDS], *[f"^A|{f}" for f in FIELDS]]
    kinds = ["string", *["double"] * 5, "bigint", *["double"] * 5, "bigint"]
    df = spark.createDataFrame(cells, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))
    if not nested:
        return df
    group = lambda t: "struct(" + ", ".join(f"`{t}|{f}` as `{f}`" for f in FIELDS) + f") as `{t}`"
    return df.selectExpr("Date", group("BRK.B"), group("^A"))


@pytest.mark.parametrize("nested", [False, True])
def test_wide_to_long(spark, nested):
    long = wide_to_long(wide(spark, nested), ["BRK.B", "^A", "NONE"]).collect()
    assert [tuple(r) for r in sorted(long)] == [
        (d(24), "BRK.B", 1.0, 2.0, 0.5, 1.5, 1.5, 7),
        (d(24), "^A", None, 2.0, 1.0, 1.5, None, None),
    ] if not nested else len(long) == 2
    assert wide_to_long(wide(spark, nested), ["NONE"]).count() == 0


def test_wide_frame_errors(spark):
    with pytest.raises(ValueError, match="two-level"):
        wide_to_long(spark.range(1), ["A"])
    with pytest.raises(ValueError, match="Adj Close"):
        wide_to_long(wide(spark).drop("^A|Adj Close"), ["^A"])


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.mark.parametrize("open_files", [128, 2])  # with two, a task sorts what belongs to further days
def test_packed_documents_are_compressed_and_not_shuffled(spark, tmp_path, monkeypatch, open_files):
    monkeypatch.setattr(bronze, "_OPEN_FILES", open_files)
    monkeypatch.setitem(bronze._PACKING, "maxRecordsPerFile", 30)
    rates = spark.range(2000, numPartitions=2).selectExpr(
        "if(id % 100 = 0, 'soon', cast(date_add(date '2026-08-24', cast(id % 7 as int)) as string)) as date",
        "if(id % 90 = 0, null, 'EUR') as base", "'USD' as quote", "id / 7 as rate", "'fx' as source",
        "'2026-09-01T00:00:00Z' as ingestion_timestamp", "cast(id as string) as ingestion_id")
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    bronze.append_documents(rates, plain)
    group = f"packed-{open_files}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        bronze.append_documents(rates, packed, packed=True)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getJobInfo(job).stageIds for job in tracker.getJobIdsForGroup(group)]
    assert stages and all(len(ids) == 1 for ids in stages), "a second stage reads a shuffle"
    files = [f for f in (tmp_path / "packed").rglob("part-*")]
    assert files and all(f.name.endswith(".json.gz") for f in files)
    size = lambda root: sum(f.stat().st_size for f in root.rglob("part-*"))
    assert size(tmp_path / "packed") < size(tmp_path / "plain") / 2
    read = lambda root, pattern: sorted(
        map(repr, bronze.read_documents(spark, root, FX_BRONZE, multi_line=False, pattern=pattern).drop("source_file", "file_modified").collect()))
    expected = read(plain, "*.json")
    assert len(expected) == 2000 and read(packed, bronze.PACKED) == expected
    held = bronze.read_documents(spark, packed, FX_BRONZE, multi_line=False, pattern=bronze.PACKED).groupBy("source_file").count()
    assert held.selectExpr("max(count) as most").first().most == 30
    assert {f.parent.name for f in files} == {f.parent.name for f in (tmp_path / "plain").rglob("part-*")}


def test_a_setting_ends_with_its_block(spark):
    before = spark.conf.get(OPEN_FILES)
    with pytest.raises(ZeroDivisionError), setting(spark, OPEN_FILES, "7"):
        assert spark.conf.get(OPEN_FILES) == "7"
        1 / 0
    assert spark.conf.get(OPEN_FILES) == before and spark.conf.get(OPEN_FILES, None) is None
    with setting(spark, OPEN_FILES, "7"):
        with setting(spark, OPEN_FILES, "8"):
            pass
        assert spark.conf.get(OPEN_FILES) == "7"


def test_the_bronze_to_silver_job_keeps_no_plain_documents(spark, tmp_path, monkeypatch):
    roots = {}
    monkeypatch.setattr(catalog, "scratch", lambda spark, name: roots.setdefault(name, scratch(spark, name)))
    day = "timestamp_ntz '1996-03-01' + make_dt_interval(cast(id % 40 as int))"
    spark.range(400).selectExpr(
        "id as o_orderkey", "id % 9 as o_custkey", f"{day} as o_orderdate", "9000.25D + id as o_totalprice",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(400).selectExpr(
        "id as l_orderkey", "1 as l_linenumber", "id % 9 as l_partkey", "20D as l_quantity", "8000.5D + id as l_extendedprice",
        "0.05D as l_discount", "0.02D as l_tax", f"{day} as l_shipdate",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    silver = catalog.bronze_to_silver_job(spark, str(tmp_path))
    assert {r.asset_type for r in silver.select("asset_type").distinct().collect()} == {"FX", "EQUITY"}
    for name in ("rates", "bars"):
        documents = spark.read.option("recursiveFileLookup", True).json(roots[name])
        assert documents.count() == 400
        assert all(f.endswith(".json.gz") for f in documents.inputFiles())
