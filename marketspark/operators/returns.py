"""Returns along each instrument's series.

A series is one (asset type, instrument, source). After de-duplication it has at
most one row per calendar day, so the sort behind each window is bounded by the
calendar whatever the size of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.functions.dates import in_window
from marketspark.schemas import EQUITY, FX

# The value that is followed over time: rate for FX, adjusted close for equity.
LEVEL = f"case asset_type when '{FX}' then rate when '{EQUITY}' then adj_close end"

_SERIES = "partition by asset_type, instrument, source order by date"


def _ratio(value: str) -> str:
    """Value over the previous observation's value; null at the start of a series."""
    return f"try_divide({value}, lag({value}) over ({_SERIES}))"


def simple_returns(df: DataFrame) -> DataFrame:
    """Set ``return`` to ``value / previous value - 1``."""
    others = [f"`{name}`" for name in df.columns if name != "return"]
    return df.selectExpr(*others, f"{_ratio(LEVEL)} - 1 as `return`")


def daily_levels(df: DataFrame, window: tuple[str, str] | None = None) -> DataFrame:
    """Positive levels inside a closed date window."""
    keep = "value > 0" + (f" and {in_window('date', *window)}" if window else "")
    return df.selectExpr("date", "asset_type", "instrument", "source", f"{LEVEL} as value").where(keep)


def log_returns(levels: DataFrame) -> DataFrame:
    """Add the log return and its square, the daily volatility proxy.

    The window filter of ``daily_levels`` comes first, so the first row of each
    series inside the window has no return.
    """
    logs = levels.selectExpr("*", f"ln({_ratio('value')}) as log_return")
    return logs.selectExpr("*", "power(log_return, 2) as volatility")


def returns_since(rows: DataFrame, earlier: DataFrame, start: str) -> DataFrame:
    """Simple returns of ``rows`` (all dated ``start`` or later) that continue older series.

    Of the older rows only the last one of each series matters. It is found by an
    aggregate of fixed-width values that is combined before the shuffle, so the old
    rows are read in few columns and are not sorted.
    """
    seeds = (
        earlier.where(f"date < date '{start}'")
        .groupBy("asset_type", "instrument", "source")
        .agg(F.expr("max_by(rate, date) as rate"), F.expr("max_by(adj_close, date) as adj_close"), F.expr("max(date) as date"))
    )
    joined = rows.unionByName(seeds, allowMissingColumns=True)
    return simple_returns(joined).where(f"date >= date '{start}'")
