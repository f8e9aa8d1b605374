"""Which days of which pairs are present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.functions.dates import in_window, spine
from marketspark.functions.text import pair_name
from marketspark.schemas import FX_KEY

OBJECT_KEY = r"(^|/)\d{4}/\d{1,2}/\d{1,2}/[^/_]+_[^/_]+\.json$"
FOLDER_KEY = r"(^|/)year=\d{4}/month=\d{1,2}/day=\d{1,2}/key=[^/_]+_[^/_]+/[^/]+$"


def keys_from_paths(paths: DataFrame) -> DataFrame:
    """(date, base, quote) out of ``…/YYYY/MM/DD/BASE_QUOTE.json``; other paths are ignored."""
    # The pattern fixes the shape, so plain cuts at the separators give the parts.
    day = "replace(substring_index(substring_index(path, '/', -4), '/', 3), '/', '-')"
    name = "substring_index(path, '/', -1)"
    return (
        paths.where(f"path rlike r'{OBJECT_KEY}'")
        .selectExpr(
            f"try_cast({day} as date) as date",
            f"substring_index({name}, '_', 1) as base",
            f"substring_index(substring_index({name}, '_', -1), '.json', 1) as quote",
        )
        .where("date is not null")
    )


def keys_from_folders(paths: DataFrame) -> DataFrame:
    """(date, base, quote) out of ``…/year=/month=/day=/key=BASE_QUOTE/file``; other paths are ignored."""
    part = lambda name: f"substring_index(substring_index(path, '/{name}=', -1), '/', 1)"
    return (
        paths.where(f"path rlike r'{FOLDER_KEY}'")
        .selectExpr(
            f"try_cast({part('year')} || '-' || {part('month')} || '-' || {part('day')} as date) as date",
            f"substring_index({part('key')}, '_', 1) as base", f"substring_index({part('key')}, '_', -1) as quote",
        )
        .where("date is not null")
    )


def coverage(keys: DataFrame) -> DataFrame:
    """Records, range, span and distinct days per pair."""
    return _coverage(keys, ("base", "quote"), f"{pair_name('base', 'quote')} as pair")


def ticker_coverage(keys: DataFrame) -> DataFrame:
    """Records, range, span and distinct days per ticker."""
    return _coverage(keys, ("ticker",), "ticker")


def _coverage(keys: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    """The distinct count groups by (member, date) first, so a member with a third of
    all records is spread over its days before it is brought together.
    """
    return (
        keys.groupBy(*names)
        .agg(
            F.expr("count(*) as records"), F.expr("min(date) as min_date"),
            F.expr("max(date) as max_date"), F.expr("count(distinct date) as distinct_days"),
        )
        .selectExpr(
            label, "records", "min_date", "max_date",
            "datediff(max_date, min_date) + 1 as span_days", "distinct_days",
        )
    )


def coverage_totals(report: DataFrame) -> DataFrame:
    return report.selectExpr(
        "count(*) as total_pairs", "coalesce(sum(records), 0) as total_records",
        "coalesce(sum(span_days), 0) as total_days",
    )


def present_days(keys: DataFrame, start: str, end: str, names: Sequence[str] = FX_KEY) -> DataFrame:
    """Distinct keys inside the window; bounded by pairs times days, however many records."""
    return keys.where(in_window("date", start, end)).select(*names).distinct()


def missing_dates(universe: DataFrame, keys: DataFrame, start: str, end: str) -> DataFrame:
    """Days of the closed window without a record, per configured pair."""
    # Dealt out first, so that many tasks explode the days.
    wanted = universe.repartition("base", "quote").selectExpr(f"{spine(start, end)} as date", "base", "quote")
    return wanted.join(present_days(keys, start, end), list(FX_KEY), "left_anti")


def missing_report(universe: DataFrame, keys: DataFrame, start: str, end: str) -> DataFrame:
    """Missing days per pair as a sorted list, empty for a complete pair.

    A list is at most as long as the window.
    """
    # Dealt out first, so that many tasks explode the days.
    wanted = universe.repartition("base", "quote").selectExpr(f"{spine(start, end)} as date", "base", "quote")
    found = present_days(keys, start, end).selectExpr("*", "true as found")
    return (
        wanted.join(found, list(FX_KEY), "left")
        .groupBy("base", "quote")
        .agg(F.expr("sort_array(collect_list(if(found is null, date, null))) as missing"))
        .selectExpr(f"{pair_name('base', 'quote')} as pair", "size(missing) as missing_days", "missing")
    )
