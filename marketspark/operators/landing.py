"""What is to be fetched, what lands, and what is skipped.

Bronze is first-wins: a key that is already there, or that came earlier in the
same batch, is never overwritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.functions.dates import days, in_window
from marketspark.functions.text import has_text, is_currency
from marketspark.operators.coverage import missing_dates, present_days
from marketspark.operators.dedupe import dedupe
from marketspark.schemas import FX_KEY


def work_list(universe: DataFrame, existing: DataFrame, start: str, end: str) -> DataFrame:
    """Pair-days of the closed window that Bronze lacks, with the object path of each."""
    path = "date_format(date, 'yyyy/MM/dd') || '/' || base || '_' || quote || '.json' as path"
    return missing_dates(universe, existing, start, end).selectExpr(*FX_KEY, path)


def enrich(df: DataFrame, source: str, run_at: str | None = None) -> DataFrame:
    """Add lineage: source, UTC time of the run, a random id per record."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return df.withColumns({
        "source": F.lit(source),
        "ingestion_timestamp": F.lit(run_at) if run_at else now,
        "ingestion_id": F.uuid(),
    })


def keep_first(
    batch: DataFrame, existing: DataFrame, keys: Sequence[str], arrival: Sequence[str]
) -> DataFrame:
    """Records to land: the first arrival of each key that Bronze lacks. Nulls in a key equal each other.

    Both sides come down to one row per key before they meet.
    """
    known = existing.selectExpr(*[f"`{key}` as `_known_{key}`" for key in keys]).distinct()
    same = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_known_{key}")) for key in keys))
    return dedupe(batch, keys, arrival, keep="first").join(known, same, "left_anti")


def landing_summary(
    batch: DataFrame, existing: DataFrame, keys: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Records uploaded and skipped per ``by``.

    Works on counts per key, so no record of a repeated key needs a rank.
    """
    arrived = batch.groupBy(*keys).agg(F.expr("count(*) as arrived"))
    known = existing.select(*keys).distinct().selectExpr("*", "true as known")
    return (
        arrived.join(known, list(keys), "left")
        .selectExpr(*by, "arrived", "if(known is null, 1, 0) as uploaded")
        .groupBy(*by)
        .agg(F.expr("sum(uploaded) as uploaded"), F.expr("sum(arrived - uploaded) as skipped"))
    )


def pair_outcomes(
    universe: DataFrame, batch: DataFrame, existing: DataFrame, start: str, end: str,
    failures: DataFrame | None = None,
) -> DataFrame:
    """Per configured pair (base, quote): status, records uploaded, records skipped; see ``_outcomes``.

    A pair with an invalid code fails.
    """
    valid = f"({is_currency('base')}) and ({is_currency('quote')})"
    return _outcomes(universe, batch, existing, ("base", "quote"), valid, start, end, failures)


def ticker_outcomes(
    universe: DataFrame, batch: DataFrame, existing: DataFrame, start: str, end: str,
    failures: DataFrame | None = None,
) -> DataFrame:
    """Per configured ticker: status, records uploaded, records skipped; see ``_outcomes``.

    A blank ticker fails.
    """
    return _outcomes(universe, batch, existing, ("ticker",), has_text("ticker"), start, end, failures)


def _outcomes(
    universe: DataFrame, batch: DataFrame, existing: DataFrame, names: Sequence[str], valid: str, start: str, end: str,
    failures: DataFrame | None,
) -> DataFrame:
    """Outcomes per member of a universe.

    A known day is not fetched and counts as one skip; the second and later
    records of a fetched day are skipped too. A member that is not ``valid``, or
    one whose fetch the caller reports in ``failures``, fails without
    touching the others.
    """
    names = list(names)
    if failures is not None:
        failed = failures.select(*names).distinct().selectExpr("*", "true as _failed")
        universe = universe.join(failed, names, "left")
    else:
        universe = universe.selectExpr("*", "false as _failed")
    universe = universe.repartition(*names)  # the spine is exploded by many tasks
    fetched = f"({valid}) and _failed is not true"
    key = ["date", *names]
    wanted = universe.selectExpr(
        *names, f"if({fetched}, 'successful', 'failed') as status",
        f"explode_outer(if({fetched}, {days(start, end)}, null)) as date",
    )
    known = present_days(existing, start, end, key).selectExpr("*", "1 as known")
    inside = batch.where(in_window("date", start, end))
    arrived = inside.groupBy(*key).agg(F.expr("count(*) as arrived"))
    return (
        wanted.join(known, key, "left").join(arrived, key, "left")
        .selectExpr(
            *names, "status", "coalesce(known, 0) as known",
            "if(known is null, coalesce(arrived, 0), 0) as fetched",
        )
        .groupBy(*names, "status")
        .agg(
            F.expr("count_if(fetched > 0) as uploaded"),
            F.expr("sum(known + greatest(fetched - 1, 0)) as skipped"),
        )
    )


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    return outcomes.selectExpr(
        "count_if(status = 'successful') as successful", "count_if(status = 'failed') as failed",
        "sum(uploaded) as uploaded", "sum(skipped) as skipped",
    )
