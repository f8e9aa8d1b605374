import pytest

from marketspark.operators import quality as q
from marketspark.plans.staging import stage_equity, stage_fx
from marketspark.schemas import EQUITY_BRONZE, FX_BRONZE
from marketspark.sources.bronze import object_paths, read_documents, unreadable

GOOD = {"date": "2026-08-24", "base": "EUR", "quote": "USD", "rate": 1.1}
BAR = {"date": "2026-08-24", "ticker": "^GSPC", "open": 10.0, "high": 12.0, "low": 9.0,
       "close": 11.0, "adj_close": 11.0, "volume": 5}


def fx_reasons(spark, documents, *records):
    docs = read_documents(spark, documents(*records), FX_BRONZE)
    rows = q.with_reasons(docs, q.fx_rules(docs)).orderBy("source_file").collect()
    return [list(row.reject_reasons) for row in rows]


def test_fx_record_rules(spark, documents):
    missing = {k: v for k, v in GOOD.items() if k != "rate"}
    reasons = fx_reasons(
        spark, documents,
        GOOD, {**GOOD, "rate": 1}, {**GOOD, "date": "2026-8-1"}, {**GOOD, "base": " eur\t\n"},
        {**GOOD, "base": "ÉUR"}, {**GOOD, "quote": " usd "},
        missing, {**GOOD, "rate": "1.1"}, {**GOOD, "rate": True}, {**GOOD, "rate": None},
        {**GOOD, "rate": 0}, {**GOOD, "rate": -1}, {**GOOD, "rate": float("nan")},
        {**GOOD, "rate": float("inf")}, {**GOOD, "base": ""}, {**GOOD, "base": "  "},
        {**GOOD, "base": "E1R"}, {**GOOD, "base": "EU"}, {**GOOD, "base": "EURO"},
        {**GOOD, "date": "2026-13-01"}, {**GOOD, "date": None}, {**GOOD, "date": 20260801}, "not json",
    )
    assert reasons[:6] == [[]] * 6
    assert reasons[6] == ["required", "positive_rate"]
    assert [r[0] for r in reasons[7:9]] == ["rate_type"] * 2
    assert reasons[9][0] == "required"
    assert reasons[10:12] == [["positive_rate"]] * 2
    assert reasons[12] == ["required", "positive_rate"]
    assert reasons[13] == ["positive_rate"]
    assert reasons[14:19] == [["currency"]] * 5
    assert reasons[19] == ["date_format"]
    assert reasons[20] == ["required", "date_format"]
    assert reasons[21] == ["date_format"]
    assert reasons[22][0] == "readable"


def test_unreadable_file_is_set_apart_and_the_rest_loads(spark, documents):
    docs = read_documents(spark, documents(GOOD, "{broken", GOOD), FX_BRONZE)
    assert unreadable(docs, q.FX_COLUMNS).count() == 1
    assert unreadable(docs, q.FX_COLUMNS).first().source_file.endswith("r001.json")
    assert stage_fx(docs).count() == 2


def test_only_json_files_are_listed_and_read(spark, documents, tmp_path):
    root = documents(GOOD)
    (tmp_path / "docs" / "2026" / "notes.txt").write_text("x")
    assert object_paths(spark, root).count() == 1
    assert read_documents(spark, root, FX_BRONZE).count() == 1


def test_currency_check_can_be_left_out(spark, documents):
    docs = read_documents(spark, documents({**GOOD, "base": "E1R"}, {**GOOD, "base": " "}), FX_BRONZE)
    assert [r.base for r in stage_fx(docs, check_currency=False).collect()] == ["E1R"]


@pytest.mark.parametrize("change, reason", [
    ({}, None),
    ({"open": "10", "volume": "7"}, None),
    ({"high": 10, "low": 10, "open": 10, "close": 10}, None),
    ({"volume": None}, None),
    ({"volume": 0}, None),
    ({"volume": "n/a"}, None),
    ({"date": "2026-08-24 00:00:00"}, None),
    ({"volume": -1}, "volume"),
    ({"open": None}, "required"),
    ({"open": "abc"}, "required"),
    ({"open": "1d"}, "required"),
    ({"close": float("nan")}, "required"),
    ({"ticker": " \t"}, "required"),
    ({"date": "24.08.2026"}, "date_format"),
    ({"adj_close": 0}, "positive_price"),
    ({"high": 9.5}, "ohlc"),
    ({"low": 10.5}, "ohlc"),
    ({"high": 8.0, "low": 9.0}, "ohlc"),
])
def test_bar_rules(spark, documents, change, reason):
    docs = read_documents(spark, documents({**BAR, **change}), EQUITY_BRONZE)
    assert q.with_reasons(docs, q.equity_rules(docs)).first().first_reason == reason
    assert stage_equity(docs).count() == (reason is None)


def test_bar_types(spark, documents):
    docs = read_documents(spark, documents({**BAR, "ticker": " ^GSPC ", "open": "10.5", "volume": "12.0"}),
                          EQUITY_BRONZE)
    row = stage_equity(docs).first()
    assert (row.instrument, row.open, row.volume, str(row.date)) == ("^GSPC", 10.5, 12, "2026-08-24")


def test_attrition_is_sequential(spark, documents):
    bad_twice = {**GOOD, "base": "E1R", "rate": -1}
    docs = read_documents(spark, documents(GOOD, bad_twice, {**GOOD, "rate": -1}), FX_BRONZE)
    rows = {r.rule: (r.rows_before, r.rows_removed, r.rows_after)
            for r in q.attrition(docs, q.fx_rules(docs), "FX").collect()}
    assert rows["currency"] == (3, 1, 2)
    assert rows["positive_rate"] == (2, 1, 1)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="quote.*rate"):
        q.fx_rules(spark.createDataFrame([("2026-08-24", "EUR")], "date string, base string"))


def test_table_tests(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), (None, 2)], "k string, v int")
    tests = q.TableTests("t", ("k",), accepted=(("k", ("a",)),), unique=(("v",), ("k",)))
    results = {(r.column_name, r.test): r.failures for r in q.run_tests(df, tests).collect()}
    assert results == {("k", "not_null"): 1, ("k", "accepted_values"): 1, ("v", "unique"): 1, ("k", "unique"): 0}
    with pytest.raises(ValueError, match="t.k not_null: 1"):
        q.check_tests(q.run_tests(df, tests))


def test_publish_gate(spark):
    with pytest.raises(ValueError, match="empty"):
        q.check_publishable(spark.range(0), "t")
    with pytest.raises(ValueError, match="repeats"):
        q.check_publishable(spark.range(1).selectExpr("id", "id"), "t")


def test_junk_after_a_date_and_any_text_as_a_literal(spark):
    from marketspark.functions.dates import day
    from marketspark.functions.text import literal
    from pyspark.sql import types as T

    shown = {
        "2026-08-01": True, "2026-08-01 12:30:00": True, "2026-08-01T12:30:00.5Z": True, "2026-08-01T12:30:00+02:00": True,
        "2026-08-01 garbage": False, "2026-08-01Tjunk": False, "2026-08-01 25:00:00": False, "2026-08-01T": False,
    }
    rows = spark.createDataFrame([(t,) for t in shown], "t string")
    got = {r.t: r.d is not None for r in rows.selectExpr("t", f"{day('t', T.StringType(), allow_time=True)} as d").collect()}
    assert got == shown
    for text in ("a\U0001f600b", "it's", "back\\slash \\n", '"', "\n\t", ""):
        assert spark.range(1).selectExpr(f"{literal(text)} as x").first().x == text


def test_a_rule_is_evaluated_once_per_row(spark):
    rows = spark.createDataFrame([(-1.0,), (1.0,)], "v double")
    marked = q.with_reasons(rows, [q.Rule("large", "v + 4321 > 4321"), q.Rule("any", "v is not null")])
    assert sorted(map(tuple, marked.collect())) == [(-1.0, ["large"], "large"), (1.0, [], None)]
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("> 4321") == 1 and "lambda" not in plan


def test_screened_rows_meet_no_rule_again(spark, documents):
    docs = read_documents(spark, documents({**BAR, "ticker": " A "}), EQUITY_BRONZE)
    assert "rlike" in stage_equity(docs)._jdf.queryExecution().optimizedPlan().toString().lower()
    again = stage_equity(docs, screened=True)
    assert again.collect() == stage_equity(docs).collect()
    assert "isnotnull(ticker" not in again._jdf.queryExecution().optimizedPlan().toString()
