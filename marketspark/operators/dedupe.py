"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# The ingestion id need not be unique, so the values complete the order: rows
# that still tie are equal in everything Silver keeps.
SILVER_ORDER = (
    "ingestion_timestamp", "ingestion_id", "adj_close", "high", "volume", "rate",
    "open", "low", "close",
)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """Keep the ``last`` or ``first`` row per key; nulls lose either way.

    Filtering ``row_number() = 1`` lets Spark cut every key to one row per task
    before the shuffle, so a key that holds a third of all rows still reaches
    its reducer as at most one row per map task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    way = "desc" if keep == "last" else "asc"
    ranked = ", ".join(f"`{name}` {way} nulls last" for name in order)
    by = ", ".join(f"`{name}`" for name in keys)
    rank = f"row_number() over (partition by {by} order by {ranked}) as _rank"
    return df.selectExpr("*", rank).where("_rank = 1").drop("_rank")
