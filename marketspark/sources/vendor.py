"""The vendor's wide frame: a date, then per ticker a group of bar fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketspark.functions.dates import day
from marketspark.functions.numbers import number, whole
from marketspark.functions.text import literal

# Bar fields of the vendor frame and their Bronze names.
BAR_FIELDS = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
}


def _cells(wide: DataFrame, separator: str) -> dict[str, dict[str, tuple[str, T.DataType]]]:
    """Ticker -> field -> column, from struct columns or from ``ticker|field`` names."""
    cells: dict[str, dict[str, tuple[str, T.DataType]]] = {}
    for top in wide.schema.fields:
        if isinstance(top.dataType, T.StructType):
            for sub in top.dataType.fields:
                cells.setdefault(top.name, {})[sub.name] = (f"`{top.name}`.`{sub.name}`", sub.dataType)
        elif separator in top.name:
            ticker, field = top.name.rsplit(separator, 1)
            cells.setdefault(ticker, {})[field] = (f"`{top.name}`", top.dataType)
    return cells


def wide_to_long(
    wide: DataFrame, tickers: Sequence[str], date_column: str = "Date", separator: str = "|"
) -> DataFrame:
    """One row per date and requested ticker that has a close.

    A ticker the frame lacks gives no rows; a frame without a two-level header, or a
    ticker without one of the fields, is an error. All tickers are unfolded in one pass
    over the rows, with no shuffle.
    """
    cells = _cells(wide, separator)
    if not cells:
        raise ValueError("expected a two-level header of ticker and field")
    if date_column not in wide.columns:
        raise ValueError(f"the frame lacks columns: ['{date_column}']")
    bars = []
    for ticker in tickers:
        fields = cells.get(ticker)
        if fields is None:
            continue
        missing = [name for name in BAR_FIELDS if name not in fields]
        if missing:
            raise ValueError(f"{ticker} lacks columns: {missing}")
        values = ", ".join(
            f"{(whole if name == 'volume' else number)(*fields[field])} as {name}"
            for field, name in BAR_FIELDS.items()
        )
        bars.append(f"struct({literal(ticker)} as ticker, {values})")
    found = bool(bars)
    if not found:
        empty = ", ".join(
            f"cast(null as {'bigint' if name == 'volume' else 'double'}) as {name}"
            for name in BAR_FIELDS.values()
        )
        bars = [f"struct('' as ticker, {empty})"]
    date = day(f"`{date_column}`", wide.schema[date_column].dataType, allow_time=True)
    long = wide.selectExpr(f"{date} as date", f"inline(array({', '.join(bars)}))")
    return long.where("close is not null" if found else "false")
