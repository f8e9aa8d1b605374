import datetime as dt
import math

import pytest

from marketspark.functions.dates import check_window, half_open, spine
from marketspark.operators.dedupe import dedupe
from marketspark.operators.returns import daily_levels, log_returns, simple_returns
from marketspark.operators import weekly as w
from marketspark.plans import layers
from marketspark.schemas import SILVER

COLUMNS = "date date, asset_type string, instrument string, base string, quote string, rate double, adj_close double, source string"


def d(day, month=8):
    return dt.date(2026, month, day)


def rows(spark, *values):
    return spark.createDataFrame(list(values), COLUMNS)


def fx(day, rate, base="EUR", quote="USD", source="fx"):
    return (d(day), "FX", f"{base}/{quote}", base, quote, rate, None, source)


def test_spine(spark):
    days = lambda a, b: [r[0] for r in spark.range(1).selectExpr(spine(a, b)).collect()]
    assert days("2026-08-24", "2026-08-29") == [d(i) for i in range(24, 30)]
    assert days("2026-08-24", "2026-08-24") == [d(24)]
    with pytest.raises(ValueError, match="starts after"):
        spine("2026-08-25", "2026-08-24")


@pytest.mark.parametrize("bad", [("2026-8-1", "2026-08-02"), ("x", "2026-08-02"), (None, "2026-08-02")])
def test_window_arguments(bad):
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        check_window(*bad)


def test_half_open():
    assert half_open("2026-08-24", "2026-08-31") == ("2026-08-24", "2026-09-01")


def test_returns_follow_observations_per_series(spark):
    df = rows(
        spark, fx(24, 1.0), fx(28, 1.5), fx(31, 3.0),
        (d(25), "EQUITY", "EUR/USD", None, None, None, 10.0, "eq"),
        (d(26), "EQUITY", "EUR/USD", None, None, None, 20.0, "eq"),
        (d(25), "FX", "EUR/USD", "EUR", "USD", 7.0, None, "other"),
    )
    got = {(r.asset_type, r.source, r.date.day): r["return"] for r in simple_returns(df).collect()}
    assert got == {
        ("FX", "fx", 24): None, ("FX", "fx", 28): 0.5, ("FX", "fx", 31): 1.0,
        ("EQUITY", "eq", 25): None, ("EQUITY", "eq", 26): 1.0, ("FX", "other", 25): None,
    }


def test_window_filter_comes_before_lag(spark):
    df = rows(spark, fx(24, 1.0), fx(25, 2.0), fx(26, 4.0), fx(27, -1.0), fx(28, None))
    inside = log_returns(daily_levels(df, ("2026-08-25", "2026-08-28"))).orderBy("date").collect()
    assert [(r.date.day, r.log_return) for r in inside] == [(25, None), (26, pytest.approx(math.log(2)))]
    assert inside[1].volatility == pytest.approx(math.log(2) ** 2)
    late = log_returns(daily_levels(df)).where("date >= date '2026-08-25'").orderBy("date").first()
    assert late.log_return == pytest.approx(math.log(2))


def test_dedupe_keeps_last_or_first_and_sources_apart(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, 5.0), (1, "a", 2, None), (1, "b", 1, 6.0), (2, "a", 1, 7.0), (2, "a", 1, 8.0)],
        "day int, source string, id int, v double",
    )
    last = {(r.day, r.source): (r.id, r.v) for r in dedupe(df, ["day", "source"], ["id", "v"]).collect()}
    assert last == {(1, "a"): (2, None), (1, "b"): (1, 6.0), (2, "a"): (1, 8.0)}
    first = {(r.day, r.source): r.v for r in dedupe(df, ["day", "source"], ["id", "v"], keep="first").collect()}
    assert first == {(1, "a"): 5.0, (1, "b"): 6.0, (2, "a"): 7.0}
    with pytest.raises(ValueError):
        dedupe(df, ["day"], ["id"], keep="any")


def test_silver_layout(spark):
    stage = spark.createDataFrame(
        [(d(24), "EUR", "USD", 1.0, "fx", dt.datetime(2026, 8, 24), "x")],
        "date date, base string, quote string, rate double, source string, ingestion_timestamp timestamp, ingestion_id string",
    )
    bars = spark.createDataFrame(
        [(d(24), "^GSPC", 1.0, 1.0, 1.0, 1.0, 1.0, None, "eq", dt.datetime(2026, 8, 24), "y")],
        "date date, instrument string, open double, high double, low double, close double, adj_close double, "
        "volume bigint, source string, ingestion_timestamp timestamp, ingestion_id string",
    )
    silver = layers.silver(stage, bars)
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in SILVER]
    assert {r.instrument for r in silver.collect()} == {"EUR/USD", "^GSPC"}


def test_wide_table_keeps_dates_without_listed_instruments(spark):
    df = rows(spark, fx(24, 1.0), fx(25, 2.0, base="AUD"))
    wide = {r.date.day: r for r in layers.gold_market(df).collect()}
    assert wide[24].eur_usd == 1.0 and wide[25].eur_usd is None and len(wide[25]) == 37
    assert [c for c in layers.gold_returns(simple_returns(df)).columns][:3] == ["date", "eur_usd", "eur_gbp"]


def weekly_rows(spark):
    return w.weekly_performance(rows(
        spark, fx(23, 5.0), fx(24, 1.0), fx(26, 4.0), fx(30, 2.0), fx(25, 3.0, base="GBP"),
        (d(24), "EQUITY", "^GSPC", None, None, None, 10.0, "eq"),
    ))


def test_cells_of_an_instrument_come_from_one_source(spark):
    df = rows(spark, fx(24, 1.0, source="a"), fx(25, 2.0, source="a"), fx(24, 40.0, source="b"), fx(25, 10.0, source="b"), fx(26, 3.0, source="b"))
    got = {r.date.day: (r.eur_usd, r.eur_usd_log_return) for r in layers.gold_market(df).collect()}
    assert got[24][0] in (1.0, 40.0) and got[26][0] == 3.0
    first, second = got[24][0], got[25][0]
    assert (first, second) in ((1.0, 2.0), (40.0, 10.0)) and got[25][1] == pytest.approx(math.log(second / first))
    text = layers.gold_market(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_weekly(spark):
    got = {(str(r.week_start), r.base): tuple(r)[3:] for r in weekly_rows(spark).collect()}
    assert got == {
        ("2026-08-17", "EUR"): (5.0, 5.0, 5.0, 5.0, 5.0, 0.0),
        ("2026-08-24", "EUR"): (1.0, 2.0, 1.0, 4.0, 2.333333, 100.0),
        ("2026-08-24", "GBP"): (3.0, 3.0, 3.0, 3.0, 3.0, 0.0),
    }


def test_weekly_order_ignores_arrival(spark):
    one = rows(spark, fx(26, 4.0), fx(24, 1.0), fx(24, 2.0, source="b"))
    row = w.weekly_performance(one).first()
    assert (row.start_rate, row.end_rate) == (2.0, 4.0)


def test_rounding_modes(spark):
    df = rows(spark, fx(24, 0.5000005), fx(25, 0.5000005))
    assert w.weekly_performance(df).first().start_rate == 0.500001
    assert w.weekly_performance(df, half_even=True).first().start_rate == 0.5


def ranked(spark):
    week = d(24)
    values = [(d(17), "EUR", "USD", 9.0), (week, "B", "X", 1.0), (week, "A", "X", 1.0), (week, "C", "X", None),
              (week, "D", "X", -2.0)]
    return spark.createDataFrame(values, "week_start date, base string, quote string, weekly_return_pct double")


def test_ranked_queries(spark):
    df = ranked(spark)
    bases = lambda frame: [r.base for r in frame.collect()]
    assert bases(w.latest_performance(df)) == ["A", "B", "D", "C"]
    assert bases(w.top_performers(df, 2)) == ["A", "B"]
    assert bases(w.worst_performers(df, 2)) == ["D", "A"]
    assert bases(w.top_performers(df, 99)) == ["A", "B", "D", "C"]
    assert bases(w.newest_first(df)) == ["A", "B", "D", "C", "EUR"]
    assert w.pair_history(df, "EUR", "USD").count() == 1
    summary = w.weekly_summary(df).collect()
    assert [tuple(r)[1:] for r in summary] == [(4, 0.0, 1.0, -2.0), (1, 9.0, 9.0, 9.0)]
