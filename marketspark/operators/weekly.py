"""Weekly performance per currency pair, and the queries on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.functions.dates import week_start
from marketspark.functions.numbers import rounded

RATE_DIGITS = 6
PCT_DIGITS = 4
PERFORMANCE = ("week_start", "base", "quote", "weekly_return_pct")


def weekly_performance(silver: DataFrame, half_even: bool = False) -> DataFrame:
    """First, last, lowest, highest and mean rate of each pair and week.

    Rows without a pair (equities) drop out. First and last follow the date, then
    a hash of the source, never the arrival order: one number, so that Spark can hash
    instead of sorting. The return uses the unrounded rates.
    """
    rates = {
        "start_rate": "min_by(rate, place)",
        "end_rate": "max_by(rate, place)",
        "min_rate": "min(rate)",
        "max_rate": "max(rate)",
        "avg_rate": "avg(rate)",
    }
    place = "shiftleft(cast(unix_date(date) as bigint), 32) + (xxhash64(source) & 4294967295)"
    pct = "(try_divide(end_rate, start_rate) - 1) * 100"
    return (
        silver.where("base is not null and quote is not null and rate is not null")
        .selectExpr(f"{week_start('date')} as week_start", "base", "quote", "rate", f"{place} as place")
        .groupBy("week_start", "base", "quote")
        .agg(*[F.expr(f"{value} as {name}") for name, value in rates.items()])
        .selectExpr(
            "week_start", "base", "quote",
            *[f"{rounded(name, RATE_DIGITS, half_even)} as {name}" for name in rates],
            f"{rounded(pct, PCT_DIGITS, half_even)} as weekly_return_pct",
        )
    )


def latest_week(weekly: DataFrame) -> DataFrame:
    """Rows of the last week. Give it a stored table: it is read twice."""
    newest = weekly.agg(F.max("week_start")).scalar()
    return weekly.where(F.col("week_start") == newest)


def latest_performance(weekly: DataFrame) -> DataFrame:
    return latest_week(weekly).orderBy(F.desc_nulls_last("weekly_return_pct"), "base", "quote")


def top_performers(weekly: DataFrame, limit: int = 5) -> DataFrame:
    return latest_performance(weekly).select(*PERFORMANCE).limit(limit)


def worst_performers(weekly: DataFrame, limit: int = 5) -> DataFrame:
    ranked = latest_week(weekly).orderBy(F.asc_nulls_last("weekly_return_pct"), "base", "quote")
    return ranked.select(*PERFORMANCE).limit(limit)


def pair_history(weekly: DataFrame, base: str, quote: str) -> DataFrame:
    return weekly.where((F.col("base") == base) & (F.col("quote") == quote)).orderBy("week_start")


def weekly_summary(weekly: DataFrame) -> DataFrame:
    pct = "weekly_return_pct"
    return (
        weekly.groupBy("week_start")
        .agg(
            F.expr("count(*) as pair_count"),
            F.expr(f"avg({pct}) as avg_{pct}"),
            F.expr(f"max({pct}) as best_{pct}"),
            F.expr(f"min({pct}) as worst_{pct}"),
        )
        .orderBy(F.desc("week_start"))
    )


def newest_first(weekly: DataFrame) -> DataFrame:
    return weekly.orderBy(
        F.desc("week_start"), F.desc_nulls_last("weekly_return_pct"), "base", "quote"
    )
