"""Bronze records to typed, valid staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketspark.functions.dates import day, in_window
from marketspark.functions.numbers import double, number, whole
from marketspark.functions.text import currency, strip
from marketspark.operators.quality import PRICES, equity_rules, fx_rules, keep_valid, kinds, require_casts

ORDER = ("ingestion_timestamp", "ingestion_id")
FX_ORDER = (*ORDER, "rate")
EQUITY_ORDER = (*ORDER, "adj_close", "high", "volume", "open", "low", "close")


_LINEAGE = (
    "source", "try_cast(ingestion_timestamp as timestamp) as ingestion_timestamp", "ingestion_id",
)


def _window(df: DataFrame, window: tuple[str, str] | None, end_inclusive: bool) -> DataFrame:
    return df.where(in_window("date", *window, end_inclusive)) if window else df


def stage_fx(
    bronze: DataFrame, window: tuple[str, str] | None = None, end_inclusive: bool = True,
    check_currency: bool = True, strict: bool = False, screened: bool = False,
) -> DataFrame:
    """Valid exchange rates with normalised currency codes.

    With ``strict`` a date or rate that cannot be read fails the run instead of its row.
    ``screened`` rows have passed the rules already, which are then not evaluated again.
    """
    if strict:
        kind = kinds(bronze)
        bronze = require_casts(
            bronze, {"date": day("date", kind["date"]), "rate": number("rate", kind["rate"])}, ("date", "base", "quote"))
    valid = bronze if screened else keep_valid(bronze, fx_rules(bronze, check_currency))
    staged = valid.selectExpr(
        f"{day('date', kinds(bronze)['date'])} as date",
        f"{currency('base')} as base",
        f"{currency('quote')} as quote",
        f"{double('rate')} as rate",
        *_LINEAGE,
    )
    return _window(staged, window, end_inclusive)


def stage_equity(
    bronze: DataFrame, window: tuple[str, str] | None = None, end_inclusive: bool = True, strict: bool = False,
    screened: bool = False,
) -> DataFrame:
    """Valid daily bars; the trimmed ticker is the instrument.

    With ``strict`` a date, price or volume that cannot be read fails the run instead of its row.
    ``screened`` rows have passed the rules already, which are then not evaluated again.
    """
    kind = kinds(bronze)
    if strict:
        casts = {"date": day("date", kind["date"], allow_time=True), **{name: number(name, kind[name]) for name in PRICES}}
        bronze = require_casts(bronze, {**casts, "volume": whole("volume", kind["volume"])}, ("date", "ticker"))
    valid = bronze if screened else keep_valid(bronze, equity_rules(bronze))
    staged = valid.selectExpr(
        f"{day('date', kind['date'], allow_time=True)} as date",
        f"{strip('ticker')} as instrument",
        *[f"{double(name)} as {name}" for name in PRICES],
        f"{whole('volume', kind['volume'])} as volume",
        *_LINEAGE,
    )
    return _window(staged, window, end_inclusive)
