"""The instruments to collect, given as a comma list in a job's arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from marketspark.functions.text import literal


def parse_pairs(text: str, strict: bool = True) -> list[tuple[str, str]]:
    """``"eur/usd, GBP/USD"`` as pairs; a bad item is an error, or dropped if not strict."""
    pairs = []
    for item in filter(None, (part.strip().upper() for part in text.split(","))):
        sides = item.split("/")
        if len(sides) == 2:
            pairs.append((sides[0], sides[1]))
        elif strict:
            raise ValueError(f"not a currency pair: {item!r}, expected BASE/QUOTE")
    if not pairs:
        raise ValueError("the universe holds no currency pair")
    return pairs


def parse_tickers(text: str) -> list[str]:
    tickers = [part.strip() for part in text.split(",") if part.strip()]
    if not tickers:
        raise ValueError("the universe holds no ticker")
    return tickers


def pair_frame(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """A configured universe as a frame (base, quote), made of literals only."""
    rows = ", ".join(f"struct({literal(b)} as base, {literal(q)} as quote)" for b, q in pairs)
    return spark.range(1).selectExpr(f"inline(array({rows}))")
