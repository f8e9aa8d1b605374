"""ANSI SQL texts for DuckDB, one per query of the catalog, on the same tables."""

from __future__ import annotations

from marketspark.plans import catalog as q
from marketspark.schemas import DEFAULT_PAIRS, GOLD_INSTRUMENTS
from marketspark.schemas import SILVER as SILVER_LAYOUT

FX_BRONZE = """fx_bronze as (
  select cast(o_orderdate as date) as date,
    case when o_orderkey % 499 = 0 then 'E1R' when o_orderkey % 997 = 0 then null
         when o_orderkey % 3 = 0 then lower(b) || '  ' else b end as base,
    c as quote, o_totalprice - 5000 as rate, 'fx' as source,
    o_orderdate as ingestion_timestamp, o_orderkey as ingestion_id
  from (select *,
    case o_custkey % 8 when 4 then 'GBP' when 5 then 'USD' when 6 then 'AUD' when 7 then 'USD'
                       else 'EUR' end as b,
    case o_custkey % 8 when 0 then 'USD' when 1 then 'GBP' when 2 then 'JPY' when 3 then 'CHF'
                       when 4 then 'USD' when 5 then 'JPY' when 6 then 'USD' else 'CAD' end as c
    from orders) o)"""

EQUITY_BRONZE = """equity_bronze as (
  select cast(l_shipdate as date) as date,
    case l_partkey % 7 when 0 then '^GSPC' when 1 then '^STOXX50E' when 2 then '^GDAXI'
      when 3 then '^FTSE' when 4 then '^N225' when 5 then '^HSI' else ' ^NDX ' end as ticker,
    case when l_quantity = 7 then null else l_extendedprice - 1000 end as open,
    (l_extendedprice - 1000) * (1 + l_tax) as high,
    (l_extendedprice - 1000) * 0.92::double as low,
    (l_extendedprice - 1000) * (1 - l_discount) as close,
    (l_extendedprice - 1000) * (1 - l_discount) * 0.99::double as adj_close,
    case when l_quantity = 5 then null else cast(l_quantity as bigint) - 2 end as volume,
    'equity' as source, l_shipdate as ingestion_timestamp,
    l_orderkey * 10 + l_linenumber as ingestion_id
  from lineitem)"""

FX_RULES = {
    "required": "date is not null and base is not null and quote is not null and rate is not null",
    "date_format": "date is not null",
    "currency": r"regexp_full_match(upper(trim(base)), '\p{L}{3}') "
                r"and regexp_full_match(upper(trim(quote)), '\p{L}{3}')",
    "positive_rate": "rate > 0",
}
EQUITY_RULES = {
    "required": "date is not null and trim(ticker) <> '' and open is not null and high is not null "
                "and low is not null and close is not null and adj_close is not null",
    "date_format": "date is not null",
    "positive_price": "open > 0 and high > 0 and low > 0 and close > 0 and adj_close > 0",
    "ohlc": "high >= low and high >= open and high >= close and low <= open and low <= close",
    "volume": "volume is null or volume >= 0",
}


# Documents as read: what cannot be parsed is null, and so is a rate that is no plain number.
DOCUMENTS = """damaged as (
  select s_suppkey as ingestion_id, date '1996-01-01' + (s_suppkey % 20000)::int as on_day,
    case s_nationkey % 8 when 4 then 'GBP' when 5 then 'USD' when 6 then 'AUD' when 7 then 'USD' else 'EUR' end as b,
    case s_nationkey % 8 when 0 then 'USD' when 1 then 'GBP' when 2 then 'JPY' when 3 then 'CHF'
                         when 4 then 'USD' when 5 then 'JPY' when 6 then 'USD' else 'CAD' end as q,
    s_acctbal + 1000 as amount, s_suppkey % 13 as damage
  from supplier),
documents as (
  select ingestion_id, damage,
    case damage when 0 then null when 3 then strftime(on_day, '%Y/%m/%d') when 4 then strftime(on_day, '%Y-%m') || '-32'
                else cast(on_day as varchar) end as date,
    case damage when 0 then null when 5 then null when 6 then 'E1R' else b end as base,
    case damage when 0 then null else q end as quote,
    case damage when 0 then null when 1 then null when 2 then null when 7 then -amount else amount end as rate
  from damaged)"""

DOCUMENT_RULES = {
    "readable": "damage <> 0",
    "rate_type": "rate is not null",
    "required": "date is not null and base is not null and quote is not null and rate is not null",
    "date_format": "regexp_full_match(date, '\\d{4}-\\d{1,2}-\\d{1,2}') and try_cast(date as date) is not null",
    "currency": r"regexp_full_match(upper(trim(base)), '\p{L}{3}') "
                r"and regexp_full_match(upper(trim(quote)), '\p{L}{3}')",
    "positive_rate": "rate > 0",
}


def _all(rules: dict[str, str]) -> str:
    return " and ".join(f"({rule})" for rule in rules.values())


FX_STAGE = f"""fx_stage as (
  select date, upper(trim(base)) as base, upper(trim(quote)) as quote, rate, source,
    ingestion_timestamp, ingestion_id
  from fx_bronze where {_all(FX_RULES)})"""

EQUITY_STAGE = f"""equity_stage as (
  select date, trim(ticker) as instrument, open, high, low, close, adj_close, volume, source,
    ingestion_timestamp, ingestion_id
  from equity_bronze where {_all(EQUITY_RULES)})"""

_SQL_TYPES = {"string": "varchar", "double": "double", "bigint": "bigint", "date": "date"}


def _aligned(table: str, **values: str) -> str:
    """A stage in the Silver layout: the values given, and nulls of the column's type."""
    cells = [
        f"{values.get(f.name, f'cast(null as {_SQL_TYPES[f.dataType.simpleString()]})')} as {f.name}"
        for f in SILVER_LAYOUT if f.name != "return"]
    return f"select {', '.join(cells)}, ingestion_timestamp, ingestion_id from {table}"


_FX_ALIGNED = _aligned(
    "fx_stage", date="date", asset_type="'FX'", instrument="base || '/' || quote", base="base", quote="quote", rate="rate", source="source")
_EQUITY_ALIGNED = _aligned(
    "equity_stage", asset_type="'EQUITY'",
    **{name: name for name in ("date", "instrument", "open", "high", "low", "close", "adj_close", "volume", "source")})
UNIFIED = f"unified as ({_FX_ALIGNED} union all {_EQUITY_ALIGNED})"

_ORDER = ("ingestion_timestamp", "ingestion_id", "adj_close", "high", "volume", "rate",
          "open", "low", "close")


def _kept(direction: str) -> str:
    order = ", ".join(f"{name} {direction} nulls last" for name in _ORDER)
    return f"""kept as (
  select * exclude (n) from (
    select *, row_number() over (partition by date, instrument, source order by {order}) as n
    from unified) r where n = 1)"""


_LEVEL = "case asset_type when 'FX' then rate when 'EQUITY' then adj_close end"

SILVER = f"""silver as (
  select *, lvl / lag(lvl) over (partition by asset_type, instrument, source order by date) - 1
    as "return"
  from (select *, {_LEVEL} as lvl from kept) k)"""


def _levels(window: tuple[str, str] | None = None) -> str:
    days = f"and date between date '{window[0]}' and date '{window[1]}'" if window else ""
    return f"""levels as (
  select date, asset_type, instrument, source, {_LEVEL} as value from kept
  where {_LEVEL} > 0 {days}),
logs as (
  select *, ln(value / lag(value) over (
    partition by asset_type, instrument, source order by date)) as log_return
  from levels),
vols as (select *, power(log_return, 2) as volatility from logs)"""


def _with(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


_STAGES = (FX_BRONZE, EQUITY_BRONZE, FX_STAGE, EQUITY_STAGE, UNIFIED)
_DEDUPED = (*_STAGES, _kept("desc"))
_COLUMNS = ("date, asset_type, instrument, base, quote, open, high, low, close, adj_close, "
            "volume, rate")


def _wide(source: str, measures: dict[str, str]) -> str:
    cells = ", ".join(
        f"round(max(case when instrument = '{name}' then {measure} end), {q.DIGITS}) as {column}{suffix}"
        for measure, suffix in measures.items() for name, column in GOLD_INSTRUMENTS.items()
    )
    return f"select date, {cells} from {source} group by date"


_MARKET = {"value": "", "log_return": "_log_return", "volatility": "_volatility"}

# Weekly

_UNIFIED_FX = f"unified as ({_FX_ALIGNED})"

_WEEKLY = _with(FX_BRONZE, FX_STAGE, _UNIFIED_FX, _kept("desc"), """raw_weekly as (
  select cast(date_trunc('week', date) as date) as week_start, base, quote,
    arg_min(rate, date) as start_rate, arg_max(rate, date) as end_rate,
    min(rate) as min_rate, max(rate) as max_rate, avg(rate) as avg_rate
  from kept group by all)""", """weekly as (
  select week_start, base, quote, round(start_rate, 6) as start_rate, round(end_rate, 6) as end_rate,
    round(min_rate, 6) as min_rate, round(max_rate, 6) as max_rate, round(avg_rate, 6) as avg_rate,
    round((end_rate / start_rate - 1) * 100, 4) as weekly_return_pct
  from raw_weekly)""")
_LATEST = "week_start = (select max(week_start) from weekly)"
_PERFORMANCE = "select week_start, base, quote, weekly_return_pct from weekly"

# Events

_EVENTS = """records as (
  select cast(ts as date) as date, event_type as base, 'U' || cast(user_id % 40 as varchar) as quote,
    value as rate, ts as arrived_at, event_id as arrival_no
  from events)"""
_UNIVERSE = """universe as (
  select distinct base, quote from records union all select 'none', 'U0')"""
_SPINE = f"""spine as (
  select cast(d as date) as date
  from generate_series(date '{q.SPINE[0]}', date '{q.SPINE[1]}', interval 1 day) g(d))"""
_MISSING = f"""missing as (
  select s.date, u.base, u.quote from universe u cross join spine s
  where not exists (select 1 from records r
    where r.date = s.date and r.base = u.base and r.quote = u.quote))"""


def _coverage(source: str) -> str:
    return f"""select base || '/' || quote as pair, count(*) as records, min(date) as min_date,
  max(date) as max_date, date_diff('day', min(date), max(date)) + 1 as span_days,
  count(distinct date) as distinct_days from {source} group by base, quote"""


# Quality

def _rejects(table: str, columns: str, rules: dict[str, str]) -> str:
    failed = [f"case when not coalesce({rule}, false) then '{name}' end" for name, rule in rules.items()]
    return f"""select {columns}, concat_ws(',', {', '.join(failed)}) as reject_reasons,
  coalesce({', '.join(failed)}) as first_reason
from {table} where not coalesce({_all(rules)}, false)"""


def _attrition(table: str, label: str, rules: dict[str, str]) -> str:
    steps, passed = [], []
    for step, (name, rule) in enumerate(rules.items(), 1):
        before = " and ".join(passed) or "true"
        passed.append(f"coalesce({rule}, false)")
        after = " and ".join(passed)
        steps.append(f"""select '{label}' as table_name, {step} as step, '{name}' as rule,
  count(*) filter ({before}) as rows_before, count(*) filter ({before} and not {passed[-1]}) as rows_removed,
  count(*) filter ({after}) as rows_after from {table}""")
    return "\nunion all\n".join(steps)


def _not_null(table: str, source: str, *columns: str) -> list[str]:
    return [f"select '{table}' as table_name, '{c}' as column_name, 'not_null' as test, "
            f"count(*) filter ({c} is null) as failures from {source}" for c in columns]


def _accepted(table: str, source: str, column: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return (f"select '{table}', '{column}', 'accepted_values', "
            f"count(*) filter ({column} not in ({listed})) from {source}")


def _unique(table: str, source: str, *columns: str) -> str:
    present = " and ".join(f"{c} is not null" for c in columns)
    return (f"select '{table}', '{','.join(columns)}', 'unique', count(*) from (select 1 from {source} "
            f"where {present} group by {', '.join(columns)} having count(*) > 1) d")


# State

def _newest(source: str, key: str, order: str) -> str:
    return (f"select * exclude (n) from (select *, row_number() over (partition by {key} "
            f"order by {order}) as n from {source}) r where n = 1")


_FX_KEY = "date, base, quote"
_FX_NEWEST = "ingestion_timestamp desc nulls last, ingestion_id desc nulls last, rate desc nulls last"
_TEXT_ID = "ingestion_timestamp desc, cast(ingestion_id as varchar) desc, rate desc nulls last"

_TICKERS = [name for name in GOLD_INSTRUMENTS if name.startswith("^")] + ["^NDX"]
_LONG = "long_bars as (" + "\nunion all\n".join(
    f"""select date, '{t}' as ticker, {', '.join(
        f"max(case when trim(ticker) = '{t}' then {c} end) as {c}"
        for c in ('open', 'high', 'low', 'close', 'adj_close', 'volume'))}
  from equity_bronze group by date""" for t in _TICKERS) + ")"

_PAIR_ROWS = ", ".join("('{}', '{}')".format(*pair.split("/")) for pair in DEFAULT_PAIRS.split(","))
_OUTCOMES = _with(FX_BRONZE, f"""batch as (
  select date, upper(trim(base)) as base, upper(trim(quote)) as quote from fx_bronze)""",
    f"known as (select distinct * from batch where date <= date '{q.KNOWN_FX_UNTIL}')",
    "arrived as (select date, base, quote, count(*) as n from batch group by all)",
    f"""days as (
  select cast(d as date) as date
  from generate_series(date '{q.ALL_DAYS[0]}', date '{q.ALL_DAYS[1]}', interval 1 day) g(d))""",
    f"""wanted as (
  select p.base, p.quote, days.date, k.date is not null as is_known, coalesce(a.n, 0) as n
  from (values {_PAIR_ROWS}) p(base, quote) cross join days
  left join known k on k.date = days.date and k.base = p.base and k.quote = p.quote
  left join arrived a on a.date = days.date and a.base = p.base and a.quote = p.quote)""",
    """outcomes as (
  select base, quote, 'successful' as status,
    count(*) filter (not is_known and n > 0) as uploaded,
    cast(sum(case when is_known then 1 when n > 0 then n - 1 else 0 end) as bigint) as skipped
  from wanted group by base, quote
  union all select 'E1R', 'USD', 'failed', 0, 0)""")

_LANDED = (f"""landed as (
  select date, upper(trim(base)) as base, upper(trim(quote)) as quote, arg_min(rate, ingestion_id) as rate
  from fx_bronze group by all)""", f"""fx_stage as (
  select date, base, quote, rate, 'fx' as source, 0 as ingestion_timestamp, 0 as ingestion_id
  from landed where {_all(FX_RULES)})""")
_RUN_STAGES = _with(FX_BRONZE, EQUITY_BRONZE, _LONG, *_LANDED, f"""equity_stage as (
  select date, ticker as instrument, open, high, low, close, adj_close, volume,
    'equity' as source, 0 as ingestion_timestamp, 0 as ingestion_id
  from long_bars where {_all(EQUITY_RULES)})""", UNIFIED, _kept("desc"), _levels())

_LANDED_RAW = """landed as (
  select date, base, quote, arg_min(rate, ingestion_id) as rate from fx_bronze
  where date is not null and base is not null and quote is not null group by all
  union all
  select distinct date, base, quote, rate from fx_bronze where date is null or base is null or quote is null)"""

# Three runs: later days of the euro pairs, earlier ones, one quarter of the others.
_RUNS = f"""runs as (
  select * from (values (1, date '{q.KNOWN_FX_UNTIL}' + 1, date '{q.ALL_DAYS[1]}', true),
    (2, date '{q.ALL_DAYS[0]}', date '{q.KNOWN_FX_UNTIL}', true), (3, date '{q.QUARTER[0]}', date '{q.QUARTER[1]}', false)
  ) r(number, first_day, last_day, euro)),
fetched as (
  select number, cast(first_day as varchar) as run, date, upper(trim(base)) as base, upper(trim(quote)) as quote, rate, ingestion_id
  from fx_bronze join runs on date between first_day and last_day and (upper(trim(base)) = 'EUR') = euro)"""
_RUN_LANDED = f"""landed as (
  select date, base, quote, arg_min(rate, ingestion_id) as rate from fetched group by all),
fx_stage as (
  select date, base, quote, rate, 'fx' as source, 0 as ingestion_timestamp, 0 as ingestion_id
  from landed where {_all(FX_RULES)})"""

ORACLE: dict[str, str] = {
    "silver_unified": _with(*_DEDUPED) + f"select {_COLUMNS}, source from kept",
    "silver_returns": _with(*_DEDUPED, SILVER)
    + f'select {_COLUMNS}, round("return", {q.DIGITS}) as "return", source from silver',
    "dedupe_latest": _with(*_DEDUPED)
    + f"select date, instrument, source, ingestion_id, {_LEVEL} as value from kept",
    "dedupe_first": _with(*_STAGES, _kept("asc"))
    + f"select date, instrument, source, ingestion_id, {_LEVEL} as value from kept",
    "window_half_open": _with(FX_BRONZE, FX_STAGE)
    + f"select {_FX_KEY}, rate, ingestion_id from fx_stage where date >= date '{q.QUARTER[0]}' "
      f"and date < date '{q.QUARTER[1]}' + interval 1 day",
    "fx_rejects": _with(FX_BRONZE)
    + _rejects("fx_bronze", "date, base, quote, rate, source, ingestion_id", FX_RULES),
    "equity_rejects": _with(EQUITY_BRONZE)
    + _rejects("equity_bronze", "date, ticker, open, high, low, close, adj_close, volume, source, "
               "ingestion_id", EQUITY_RULES),
    "rule_attrition": _with(FX_BRONZE, EQUITY_BRONZE, DOCUMENTS) + "\nunion all\n".join([
        _attrition("fx_bronze", "FX", FX_RULES), _attrition("equity_bronze", "EQUITY", EQUITY_RULES),
        _attrition("documents", "DOCUMENTS", DOCUMENT_RULES)]),
    "dq_tests": _with(*_DEDUPED, _levels()) + "\nunion all\n".join([
        *_not_null("staging_fx", "fx_stage", "date", "base", "quote", "rate"),
        *_not_null("staging_equity", "equity_stage", "date", "instrument", "open", "high", "low", "close"),
        *_not_null("silver", "kept", "date", "asset_type", "instrument", "source"),
        _accepted("silver", "kept", "asset_type", ("FX", "EQUITY")),
        *_not_null("gold_market", "(select distinct date from vols)", "date"),
        _unique("gold_market", "(select distinct date from vols)", "date")]),
    "dq_tests_bronze": _with(FX_BRONZE, EQUITY_BRONZE) + "\nunion all\n".join([
        *_not_null("bronze_fx", "fx_bronze", "date", "base", "quote", "rate"),
        _accepted("bronze_fx", "fx_bronze", "base", ("EUR", "GBP", "USD", "AUD")),
        _unique("bronze_fx", "fx_bronze", "date", "base", "quote"),
        _unique("bronze_fx", "fx_bronze", "ingestion_id"),
        *_not_null("bronze_equity", "equity_bronze", "date", "ticker", "open", "volume"),
        _unique("bronze_equity", "equity_bronze", "date", "ticker")]),
    "log_returns": _with(*_DEDUPED, _levels())
    + f"select date, asset_type, instrument, source, value, round(log_return, {q.DIGITS}) as log_return from vols",
    "squared_returns": _with(*_DEDUPED, _levels())
    + f"select date, asset_type, instrument, source, round(volatility, {q.DIGITS}) as volatility from vols",
    "gold_market_wide": _with(*_DEDUPED, _levels()) + _wide("vols", _MARKET),
    "gold_market_window": _with(*_DEDUPED, _levels(q.QUARTER)) + _wide("vols", _MARKET),
    "gold_returns_wide": _with(*_DEDUPED, SILVER) + _wide("silver", {'"return"': ""}),
    "weekly_performance": _WEEKLY + "select * from weekly",
    "latest_performance": _WEEKLY + f"select * from weekly where {_LATEST}",
    "top_performers": _WEEKLY + f"{_PERFORMANCE} where {_LATEST} "
    "order by weekly_return_pct desc nulls last, base, quote limit 5",
    "worst_performers": _WEEKLY + f"{_PERFORMANCE} where {_LATEST} "
    "order by weekly_return_pct asc nulls last, base, quote limit 5",
    "pair_history": _WEEKLY + "select * from weekly where base = 'EUR' and quote = 'USD'",
    "weekly_all": _WEEKLY + "select * from weekly",
    "weekly_summary": _WEEKLY + f"""select week_start, count(*) as pair_count,
  round(avg(weekly_return_pct), {q.DIGITS}) as avg_weekly_return_pct,
  max(weekly_return_pct) as best_weekly_return_pct, min(weekly_return_pct) as worst_weekly_return_pct
from weekly group by week_start""",
    "sql_surface": _WEEKLY
    + f"{_PERFORMANCE} where base = '{q.SQL_ARGS[0]}' and weekly_return_pct > {q.SQL_ARGS[1]}",
    "coverage_report": _with(_EVENTS) + _coverage("records"),
    "coverage_totals": _with(_EVENTS, f"report as ({_coverage('records')})")
    + """select count(*) as total_pairs, cast(sum(records) as bigint) as total_records,
  cast(sum(span_days) as bigint) as total_days from report""",
    "coverage_from_paths": _with(_EVENTS) + _coverage("(select * from records where base <> 'error') e"),
    "missing_dates": _with(_EVENTS, _UNIVERSE, _SPINE, _MISSING) + "select date, base, quote from missing",
    "missing_report": _with(_EVENTS, _UNIVERSE, _SPINE, _MISSING) + """
select u.base || '/' || u.quote as pair, cast(count(m.date) as integer) as missing_days,
  coalesce(string_agg(cast(m.date as varchar), ',' order by m.date), '') as missing
from universe u left join missing m on m.base = u.base and m.quote = u.quote
group by u.base, u.quote""",
    "ingest_worklist": _with(_EVENTS, _UNIVERSE, _SPINE, _MISSING) + """
select date, base, quote, strftime(date, '%Y/%m/%d') || '/' || base || '_' || quote || '.json' as path
from missing""",
    "keep_first_landing": _with(_EVENTS, "firsts as ("
    + _newest("records", _FX_KEY, "arrived_at, arrival_no") + ")")
    + f"""select f.date, f.base, f.quote, f.rate, f.arrival_no from firsts f
where not exists (select 1 from records r where r.date <= date '{q.KNOWN_EVENTS_UNTIL}'
  and r.date = f.date and r.base = f.base and r.quote = f.quote)""",
    "landing_summary": _with(_EVENTS, "counted as (select date, base, quote, count(*) as n, "
    f"date > date '{q.KNOWN_EVENTS_UNTIL}' as is_new from records group by all)")
    + """select base, quote, cast(sum(case when is_new then 1 else 0 end) as bigint) as uploaded,
  cast(sum(case when is_new then n - 1 else n end) as bigint) as skipped
from counted group by base, quote""",
    "pair_outcomes": _OUTCOMES + "select * from outcomes",
    "outcome_totals": _OUTCOMES + """select count(*) filter (status = 'successful') as successful,
  count(*) filter (status = 'failed') as failed, cast(sum(uploaded) as bigint) as uploaded,
  cast(sum(skipped) as bigint) as skipped from outcomes""",
    "bronze_enriched": _with(_EVENTS) + f"""select date, base, quote, rate, arrival_no, 'fx' as source,
  '{q.RUN_AT}' as ingestion_timestamp, 36 as id_length from records""",
    "vendor_wide_to_long": _with(EQUITY_BRONZE, _LONG) + "select * from long_bars where close is not null",
    "ticker_key": _with(EQUITY_BRONZE) + """select trim(ticker) as ticker,
  replace(replace(replace(ticker, '^', '_'), '/', '_'), ' ', '_') as safe_ticker, count(*) as records
from equity_bronze group by all""",
    "upsert_delete_insert": _with(FX_BRONZE, FX_STAGE,
    "target as (" + _newest("fx_stage", _FX_KEY, _FX_NEWEST) + ")",
    f"""revised as (
  select date, base, quote, rate * {q.REVISION}::double as rate, ingestion_timestamp, ingestion_id
  from fx_stage where quote = 'USD' and date >= date '{q.REVISED_FROM}')""",
    "batch as (" + _newest("revised", _FX_KEY, _FX_NEWEST) + ")") + f"""
select {_FX_KEY}, rate, ingestion_id from target t where not exists (
  select 1 from batch b where b.date = t.date and b.base = t.base and b.quote = t.quote)
union all select {_FX_KEY}, rate, ingestion_id from batch""",
    "bronze_json_roundtrip": _with(FX_BRONZE, FX_STAGE)
    + f"select {_FX_KEY}, rate, cast(ingestion_id as varchar) as ingestion_id from fx_stage",
    "silver_partitioned_roundtrip": _with(*_DEDUPED, SILVER)
    + f'select {_COLUMNS}, round("return", {q.DIGITS}) as "return", source from silver',
    "published_gold": _with(*_DEDUPED, _levels()) + _wide("vols", _MARKET),
    "medallion_run": _RUN_STAGES + _wide("vols", _MARKET),
    "medallion_rejects": _with(FX_BRONZE, _LANDED_RAW)
    + "select cast(date as varchar) as date, base, quote, rate, case "
    + " ".join(f"when not coalesce({rule}, false) then '{name}'" for name, rule in FX_RULES.items())
    + f" end as first_reason from landed where not coalesce({_all(FX_RULES)}, false)",
    "medallion_attrition": _with(FX_BRONZE, _LANDED_RAW, "steps as (" + _attrition("landed", "rates", FX_RULES) + ")")
    + "select table_name, rule, rows_before, rows_removed, rows_after from steps",
    "bronze_documents": _with(DOCUMENTS) + "select 'rates' as feed, 1::bigint as copies, * from ("
    + _rejects("documents", "ingestion_id", DOCUMENT_RULES) + ") r",
    "documents_silver": _with(DOCUMENTS) + f"""select try_cast(date as date) as date, base, quote, rate, 'fx' as source
from documents where {_all(DOCUMENT_RULES)}""",
    "bronze_to_silver_job": _with(*_DEDUPED)
    + f"select {_FX_KEY}, asset_type, instrument, rate, adj_close, source from kept",
    "weekly_job": _WEEKLY + "select * from weekly",
    "analytics_latest": _WEEKLY + f"select * from weekly where {_LATEST}",
    "analytics_summary": _WEEKLY + f"""select week_start, count(*) as pair_count,
  round(avg(weekly_return_pct), {q.DIGITS}) as avg_weekly_return_pct,
  max(weekly_return_pct) as best_weekly_return_pct, min(weekly_return_pct) as worst_weekly_return_pct
from weekly group by week_start""",
    "object_listing": _with(FX_BRONZE)
    + "select distinct cast(year(date) as int) as year, cast(month(date) as int) as month from fx_bronze",
    "silver_refresh": _with(FX_BRONZE, *_LANDED, _UNIFIED_FX, _kept("desc"), SILVER)
    + f'select date, instrument, rate, round("return", {q.DIGITS}) as "return", source from silver',
    "stream_incremental": _with(FX_BRONZE, FX_STAGE,
    "newest as (" + _newest("fx_stage", _FX_KEY, _TEXT_ID) + ")")
    + f"select {_FX_KEY}, rate, cast(ingestion_id as varchar) as ingestion_id from newest",
    "stream_keep_first": _with(_EVENTS) + f"""select date, base, quote, rate, arrival_no from (
  select *, row_number() over (partition by {_FX_KEY} order by arrival_no % 2 = 0, arrived_at, arrival_no) as n from records) r where n = 1""",
    "published_versions": _with(*_DEDUPED, _levels(), """days as (
  select date, max(case when instrument = 'EUR/USD' then value end) as eur_usd from vols group by date)""") + f"""
select 'before' as reader, count(*) as days, min(date) as first_day, max(date) as last_day, count(eur_usd) as levels
from days where date <= date '{q.KNOWN_FX_UNTIL}'
union all select 'after', count(*), min(date), max(date), count(eur_usd) from days""",
    "maintained_gold": _with(FX_BRONZE, _RUNS, _RUN_LANDED, _UNIFIED_FX, _kept("desc"), SILVER, """raw_weekly as (
  select cast(date_trunc('week', date) as date) as week_start, base, quote, arg_min(rate, date) as a, arg_max(rate, date) as z
  from kept group by all)""") + f"""
select 'returns' as table_name, date, lower(base || '_' || quote) as name, round("return", {q.DIGITS}) as value from silver
where "return" is not null and instrument in ({', '.join(f"'{n}'" for n in GOLD_INSTRUMENTS)})
union all
select 'weekly', week_start, base || '/' || quote, round(round((z / a - 1) * 100, 4), {q.DIGITS}) from raw_weekly""",
    "run_outcomes": _with(FX_BRONZE, _RUNS, f"""days as (
  select number, cast(first_day as varchar) as run, euro, cast(unnest(generate_series(first_day, last_day, interval 1 day)) as date) as date from runs),
arrived as (select number, date, base, quote, count(*) as n from fetched group by all),
known as (
  select distinct r.number, f.date, f.base, f.quote from runs r join fetched f
  on f.number < r.number and f.date between r.first_day and r.last_day),
pairs as (select * from (values {_PAIR_ROWS}) p(base, quote))""") + f"""
select d.run, p.base, p.quote,
  case when p.quote = '{q.FAILED_QUOTE}' and (p.base = 'EUR') = any_value(d.euro) then 'failed' else 'successful' end as status,
  count(*) filter (status_ok and k.date is null and a.n > 0) as uploaded,
  coalesce(sum(case when not status_ok then 0 when k.date is not null then 1 when a.n > 0 then a.n - 1 else 0 end), 0)::bigint as skipped
from days d cross join pairs p
cross join lateral (select not (p.quote = '{q.FAILED_QUOTE}' and (p.base = 'EUR') = d.euro) as status_ok) o
left join arrived a on a.number = d.number and a.date = d.date and a.base = p.base and a.quote = p.quote
left join known k on k.number = d.number and k.date = d.date and k.base = p.base and k.quote = p.quote
group by d.run, p.base, p.quote""",
    "declared_models": _with(*_DEDUPED, _levels()) + _wide("vols", _MARKET),
    "coverage_from_index": _with(DOCUMENTS) + _coverage("(select on_day as date, b as base, q as quote from damaged) d"),
    "ordered_silver": _with(*_DEDUPED) + """select row_number() over (order by date, asset_type, instrument, source) as position,
  date, asset_type, instrument, source from kept""",
    "strict_staging": _with(FX_BRONZE, FX_STAGE) + f"select {_FX_KEY}, rate, ingestion_id from fx_stage",
    "ticker_coverage": _with(EQUITY_BRONZE) + """select trim(ticker) as ticker, count(*) as records, min(date) as min_date, max(date) as max_date,
  date_diff('day', min(date), max(date)) + 1 as span_days, count(distinct date) as distinct_days from equity_bronze group by trim(ticker)""",
    "ticker_outcomes": _with(EQUITY_BRONZE, f"""tickers as (
  select unnest([{', '.join(f"'{t}'" for t in _TICKERS)}, '^NONE']) as ticker),
days as (select trim(ticker) as ticker, date, count(*) as n from equity_bronze
  where date between date '{q.ALL_DAYS[0]}' and date '{q.ALL_DAYS[1]}' group by all)""") + f"""
select t.ticker, case when t.ticker = '{_TICKERS[0]}' then 'failed' else 'successful' end as status,
  count(d.date) filter (t.ticker <> '{_TICKERS[0]}' and d.date > date '{q.KNOWN_FX_UNTIL}') as uploaded,
  coalesce(sum(case when t.ticker = '{_TICKERS[0]}' then 0 when d.date > date '{q.KNOWN_FX_UNTIL}' then d.n - 1 else 1 end)
    filter (d.date is not null), 0)::bigint as skipped
from tickers t left join days d using (ticker) group by t.ticker""",
}
