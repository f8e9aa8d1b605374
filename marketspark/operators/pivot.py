"""Long to wide: one row per date, one column per listed instrument."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.functions.text import literal


def wide_by_date(
    df: DataFrame, instruments: Mapping[str, str], measures: Mapping[str, str], one_of: str | None = None,
) -> DataFrame:
    """``measures`` maps a column to the suffix of its wide columns.

    Conditional aggregates need one shuffle of partial results per date; dates
    without a listed instrument stay as rows of nulls. Of several rows per date and
    instrument each cell is the largest value; with ``one_of``, a column that tells them
    apart, all cells come from the same row, that of the least hash of this column. It is a number, so Spark
    can hash instead of sorting.
    """
    def cell(instrument: str, measure: str) -> str:
        own = f"instrument = {literal(instrument)}"
        if one_of:
            return f"min_by(`{measure}`, xxhash64(`{one_of}`)) filter (where {own})"
        return f"max(if({own}, `{measure}`, null))"

    cells = [
        F.expr(f"{cell(instrument, measure)} as `{name}{suffix}`")
        for measure, suffix in measures.items()
        for instrument, name in instruments.items()
    ]
    return df.groupBy("date").agg(*cells)
