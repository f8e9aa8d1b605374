"""Silver and Gold tables as lazy plans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.functions.text import pair_name
from marketspark.operators.align import align, stack
from marketspark.operators.dedupe import SILVER_ORDER, dedupe
from marketspark.operators.pivot import wide_by_date
from marketspark.operators.returns import daily_levels, log_returns, returns_since, simple_returns
from marketspark.schemas import EQUITY, FX, GOLD_INSTRUMENTS, SILVER, SILVER_KEY

_ARRIVAL = ("ingestion_timestamp", "ingestion_id")


# The order that readers of a table expect; a table without one is by date.
ORDERS: dict[str, tuple[str, ...]] = {
    "silver": ("date", "asset_type", "instrument", "source"),
    "weekly": ("week_start", "weekly_return_pct", "base", "quote"),
}


def ordered(df: DataFrame, table: str) -> DataFrame:
    """Rows in the order readers expect; files are sorted like this where a table is published with ``order``."""
    names = ORDERS.get(table, ("date",))
    return df.orderBy(*[F.desc_nulls_last(name) if name == "weekly_return_pct" else F.col(name) for name in names])


def unify_fx(fx: DataFrame) -> DataFrame:
    """Staged rates in the Silver layout, with the columns that order duplicates."""
    return align(fx, SILVER, _ARRIVAL, asset_type=f"'{FX}'", instrument=pair_name("base", "quote"))


def unify_equity(equity: DataFrame) -> DataFrame:
    """Staged bars in the Silver layout, with the columns that order duplicates."""
    return align(equity, SILVER, _ARRIVAL, asset_type=f"'{EQUITY}'")


def unify(fx: DataFrame, equity: DataFrame) -> DataFrame:
    return stack(unify_fx(fx), unify_equity(equity))


def silver(fx: DataFrame, equity: DataFrame, keep: str = "last") -> DataFrame:
    """One row per (date, instrument, source) with its simple return."""
    rows = dedupe(unify(fx, equity), SILVER_KEY, SILVER_ORDER, keep)
    return simple_returns(rows).select(*SILVER.fieldNames())


def silver_since(fx: DataFrame, equity: DataFrame, built: DataFrame, start: str) -> DataFrame:
    """Silver rows from ``start`` on, given all staged rows from then and the built table."""
    rows = dedupe(unify(fx, equity), SILVER_KEY, SILVER_ORDER)
    return returns_since(rows, built, start).select(*SILVER.fieldNames())


def gold_market(
    silver_rows: DataFrame, window: tuple[str, str] | None = None,
    instruments: Mapping[str, str] = GOLD_INSTRUMENTS,
) -> DataFrame:
    """Levels, log returns and squared log returns, one row per date; those of an instrument come from one source."""
    measures = {"value": "", "log_return": "_log_return", "volatility": "_volatility"}
    return wide_by_date(log_returns(daily_levels(silver_rows, window)), instruments, measures, one_of="source")


def gold_returns(
    silver_rows: DataFrame, instruments: Mapping[str, str] = GOLD_INSTRUMENTS
) -> DataFrame:
    """Simple returns, one row per date; that of an instrument comes from one source."""
    return wide_by_date(silver_rows, instruments, {"return": ""}, one_of="source")
