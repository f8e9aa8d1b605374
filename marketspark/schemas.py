"""Table shapes shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

FX = "FX"
EQUITY = "EQUITY"

CORRUPT = "_corrupt_record"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STR, _DBL, _LONG, _DATE, _TS, _BOOL, _INT = (
    T.StringType(), T.DoubleType(), T.LongType(), T.DateType(), T.TimestampType(), T.BooleanType(), T.IntegerType(),
)

# The rate is read as a double, so a quoted number is recognised as malformed.
FX_BRONZE = _struct(
    date=_STR, base=_STR, quote=_STR, rate=_DBL,
    source=_STR, ingestion_timestamp=_STR, ingestion_id=_STR,
)

# Prices are read as text: this feed accepts quoted numbers, so they are cast later.
EQUITY_BRONZE = _struct(
    date=_STR, ticker=_STR, open=_STR, high=_STR, low=_STR, close=_STR,
    adj_close=_STR, volume=_STR,
    source=_STR, ingestion_timestamp=_STR, ingestion_id=_STR,
)

# Records that tell when they arrived.
EVENT_BRONZE = _struct(date=_STR, base=_STR, quote=_STR, rate=_DBL, arrived_at=_STR, arrival_no=_LONG)

FX_STAGING = _struct(
    date=_DATE, base=_STR, quote=_STR, rate=_DBL,
    source=_STR, ingestion_timestamp=_TS, ingestion_id=_STR,
)

EQUITY_STAGING = _struct(
    date=_DATE, instrument=_STR, open=_DBL, high=_DBL, low=_DBL, close=_DBL,
    adj_close=_DBL, volume=_LONG,
    source=_STR, ingestion_timestamp=_TS, ingestion_id=_STR,
)

SILVER = _struct(
    date=_DATE, asset_type=_STR, instrument=_STR, base=_STR, quote=_STR,
    open=_DBL, high=_DBL, low=_DBL, close=_DBL, adj_close=_DBL, volume=_LONG,
    rate=_DBL, **{"return": _DBL}, source=_STR,
)

WEEKLY = _struct(
    week_start=_DATE, base=_STR, quote=_STR, start_rate=_DBL, end_rate=_DBL,
    min_rate=_DBL, max_rate=_DBL, avg_rate=_DBL, weekly_return_pct=_DBL,
)

# The version of the file that a record came from.
FILE_LINEAGE = _struct(source_file=_STR, file_modified=_TS)

# A rejected document; ``date`` is the day its file was written.
LETTER = _struct(
    date=_DATE, feed=_STR, source_file=_STR, file_modified=_TS, document=_STR, document_sha256=_STR,
    reject_reasons=T.ArrayType(_STR), first_reason=_STR, copies=_LONG,
)

# An object of a store; ``date`` is the day it was written.
OBJECT = _struct(date=_DATE, path=_STR, modified=_TS, length=_LONG)

ATTRITION = _struct(
    date=_DATE, dated=_BOOL, table_name=_STR, step=_INT, rule=_STR, rows_before=_LONG, rows_removed=_LONG, rows_after=_LONG,
)

FX_KEY = ("date", "base", "quote")
EQUITY_KEY = ("date", "instrument")
SILVER_KEY = ("date", "instrument", "source")

# Instruments of the wide daily tables and their column names.
GOLD_INSTRUMENTS = {
    "EUR/USD": "eur_usd",
    "EUR/GBP": "eur_gbp",
    "EUR/JPY": "eur_jpy",
    "EUR/CHF": "eur_chf",
    "GBP/USD": "gbp_usd",
    "USD/JPY": "usd_jpy",
    "^GSPC": "gspc",
    "^STOXX50E": "stoxx50e",
    "^GDAXI": "gdaxi",
    "^FTSE": "ftse",
    "^N225": "n225",
    "^HSI": "hsi",
}

# Currency pairs collected when no other universe is given.
DEFAULT_PAIRS = "EUR/USD,EUR/GBP,EUR/JPY,EUR/CHF,GBP/USD,USD/JPY,AUD/USD,USD/CAD"

GOLD_RETURNS = _struct(date=_DATE, **{name: _DBL for name in GOLD_INSTRUMENTS.values()})
