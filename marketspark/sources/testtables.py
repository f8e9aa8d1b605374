"""The given test tables seen as Bronze records.

Dirty values are put in on purpose, so that every rule rejects something; those of
``readable``, ``rate_type`` and ``date_format`` need documents, see ``rate_documents``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from marketspark.functions.text import literal
from marketspark.operators.pivot import wide_by_date
from marketspark.sources.vendor import BAR_FIELDS

# Tickers by the remainder of the part key; the last one is padded.
TICKERS = ("^GSPC", "^STOXX50E", "^GDAXI", "^FTSE", "^N225", "^HSI", " ^NDX ")

# Currency pairs by the remainder of the customer key.
PAIRS = (
    ("EUR", "USD"), ("EUR", "GBP"), ("EUR", "JPY"), ("EUR", "CHF"),
    ("GBP", "USD"), ("USD", "JPY"), ("AUD", "USD"), ("USD", "CAD"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: str, values: Iterable[str]) -> str:
    return f"element_at(array({', '.join(map(literal, values))}), cast({index} as int) + 1)"


def fx_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange rates from ``orders``."""
    base = _pick("o_custkey % 8", [b for b, _ in PAIRS])
    quote = _pick("o_custkey % 8", [q for _, q in PAIRS])
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderdate as date) as date",
        f"""case when o_orderkey % 499 = 0 then 'E1R' when o_orderkey % 997 = 0 then null
            when o_orderkey % 3 = 0 then lower({base}) || '  ' else {base} end as base""",
        f"{quote} as quote",
        "o_totalprice - 5000 as rate",
        "'fx' as source",
        "o_orderdate as ingestion_timestamp",
        "o_orderkey as ingestion_id",
    )


# What is wrong with a document, by the remainder of the supplier key.
DAMAGES = ("cut off", "quoted rate", "boolean rate", "slashed date", "no such day", "no base", "bad code", "negative rate")
DAMAGE_CYCLE = 13


def rate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document of a rate per supplier, for folders of one document per file (year, month, day, key)."""
    base = _pick("s_nationkey % 8", [b for b, _ in PAIRS])
    quote = _pick("s_nationkey % 8", [q for _, q in PAIRS])
    damage = f"element_at(array({', '.join(map(literal, DAMAGES))}), cast(s_suppkey % {DAMAGE_CYCLE} as int) + 1)"
    rows = table(spark, sf_dir, "supplier").selectExpr(
        f"if(s_suppkey % {DAMAGE_CYCLE} < {len(DAMAGES)}, {damage}, 'none') as damage",
        "date_add(date '1996-01-01', cast(s_suppkey % 20000 as int)) as on_day", f"{base} as base", f"{quote} as quote",
        "s_acctbal + 1000 as rate", "s_suppkey",
    )
    date_text = "case damage when 'slashed date' then date_format(on_day, 'yyyy/MM/dd') when 'no such day' then date_format(on_day, 'yyyy-MM') || '-32' " \
        "else cast(on_day as string) end"
    rate_text = "case damage when 'quoted rate' then '\"' || rate || '\"' when 'boolean rate' then 'true' when 'negative rate' then '-' || rate " \
        "else cast(rate as string) end"
    base_text = "case damage when 'no base' then '' when 'bad code' then '\"base\": \"E1R\", ' else '\"base\": \"' || base || '\", ' end"
    document = (
        f"concat('{{\\n  \"date\": \"', {date_text}, '\", ', {base_text}, '\"quote\": \"', quote, '\",\\n  \"rate\": ', {rate_text}, "
        f"', \"source\": \"fx\", \"ingestion_id\": \"', s_suppkey, '\"', if(damage = 'cut off', '', '\\n}}'))")
    return rows.selectExpr(
        f"{document} as value", "date_format(on_day, 'yyyy') as year", "date_format(on_day, 'MM') as month",
        "date_format(on_day, 'dd') as day", "base || '_' || quote as key", "s_suppkey")


def equity_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars from ``lineitem``."""
    price = "(l_extendedprice - 1000)"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_shipdate as date) as date",
        f"{_pick('l_partkey % 7', TICKERS)} as ticker",
        f"if(l_quantity = 7, null, {price}) as open",
        f"{price} * (1 + l_tax) as high",
        f"{price} * 0.92D as low",
        f"{price} * (1 - l_discount) as close",
        f"{price} * (1 - l_discount) * 0.99D as adj_close",
        "if(l_quantity = 5, null, cast(l_quantity as bigint) - 2) as volume",
        "'equity' as source",
        "l_shipdate as ingestion_timestamp",
        "l_orderkey * 10 + l_linenumber as ingestion_id",
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing records from ``events``; they arrive in the order of time, then id."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(ts as date) as date", "event_type as base", "'U' || (user_id % 40) as quote",
        "value as rate", "ts as arrived_at", "event_id as arrival_no",
    )


def event_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of ``events`` and one pair without data."""
    known = event_records(spark, sf_dir).select("base", "quote").distinct()
    return known.unionByName(spark.range(1).selectExpr("'none' as base", "'U0' as quote"))


def vendor_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars as the vendor's wide frame with ``ticker|field`` columns."""
    bars = equity_bronze(spark, sf_dir).selectExpr("*", "trim(ticker) as instrument")
    measures = {name: f"|{field}" for field, name in BAR_FIELDS.items()}
    tickers = {t.strip(): t.strip() for t in TICKERS}
    return wide_by_date(bars, tickers, measures).withColumnRenamed("date", "Date")
