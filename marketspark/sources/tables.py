"""Parquet tables, plain or partitioned by date, and named relations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.session import exists
from marketspark.sources.versions import current

GRAINS = {"day": ("year", "month", "day"), "month": ("year", "month")}
PART_VALUES = {
    "year": "year({0})", "month": "lpad(month({0}), 2, '0')", "day": "lpad(day({0}), 2, '0')",
}
_PLACE = {"year": 10_000, "month": 100, "day": 1}


def period(grain: str, by: str = "date") -> str:
    """The partition a date falls in, as one number (YYYYMMDD, or YYYYMM00)."""
    number = f"year({by}) * 10000 + month({by}) * 100"
    return f"{number} + day({by})" if grain == "day" else number


def period_value(day: date, grain: str) -> int:
    return day.year * 10_000 + day.month * 100 + (day.day if grain == "day" else 0)


def in_periods(table: DataFrame, first: int, last: int) -> str:
    """Condition on the partition columns alone, so other directories are not read."""
    present = set(table.columns)
    number = " + ".join(f"{name} * {place}" for name, place in _PLACE.items() if name in present)
    return f"{number} between {first} and {last}"


def among_periods(table: DataFrame, values: Sequence[int]) -> str:
    """Condition that names partitions one by one; the calendar bounds their number."""
    present = set(table.columns)
    number = " + ".join(f"{name} * {place}" for name, place in _PLACE.items() if name in present)
    return among_values(number, values)


def among_values(number: str, values: Sequence[int]) -> str:
    return f"{number} in ({', '.join(map(str, values)) or 'null'})"


def among_months(values: Sequence[int]) -> str:
    """Condition that names months (YYYYMM00), for tables of either grain."""
    return among_values(f"year * {_PLACE['year']} + month * {_PLACE['month']}", values)


def months_after(values: Sequence[int]) -> list[int]:
    """The month after each of some months."""
    return [(m // 10_000 + 1) * 10_000 + 100 if m % 10_000 == 1200 else m + 100 for m in values]


def grain_of(table: DataFrame) -> str | None:
    """Grain of a table read with its partition columns; None if it has none."""
    return "day" if "day" in table.columns else "month" if "month" in table.columns else None


def check_grain(spark: SparkSession, path: str, schema: T.StructType, grain: str, kind: str = "parquet") -> None:
    """Refuse to write ``grain`` into a table that is partitioned by another one."""
    if not exists(spark, path):
        return
    written = grain_of(spark.read.format(kind).schema(schema).load(path))
    if written not in (None, grain):
        raise ValueError(f"{path} is partitioned by {written}, not by {grain}")


def write_by_date(
    df: DataFrame, path: str, grain: str = "day", sort: Sequence[str] = (), tasks: int | None = None,
    replace: bool = False, by: str = "date",
) -> None:
    """Replace the partitions of the date ``by`` that ``df`` holds and leave all others; with
    ``replace`` no others stay.

    The rebalance hint brings each partition together, yet splits one that is much
    larger than the rest and joins small ones, at run time. Where the table has one
    row per key, days are alike and ``tasks`` may fix the number of writers instead:
    many small days are then written side by side.
    """
    parts = GRAINS[grain]
    placed = df.selectExpr("*", *[f"{PART_VALUES[name].format(by)} as {name}" for name in parts])
    if tasks:
        placed = placed.repartition(tasks, *parts)
    else:
        placed = placed.hint("rebalance", *[F.col(name) for name in parts])
    (
        placed.sortWithinPartitions(*parts, *sort)
        .write.mode("overwrite").option("partitionOverwriteMode", "static" if replace else "dynamic")
        .partitionBy(*parts).parquet(path)
    )


def first_of(day: str, grain: str) -> str:
    """First day of the partition that holds ``day``."""
    return day if grain == "day" else f"{day[:7]}-01"


def read_by_date(
    spark: SparkSession, path: str, schema: T.StructType, bounds: tuple[int, int] | None = None,
    only: Sequence[int] | None = None, months: Sequence[int] | None = None,
) -> DataFrame | None:
    """A table written by ``write_by_date``, or None where nothing is written yet.

    ``bounds`` are the first and last partition number (see ``period_value``), ``only`` a list of them,
    ``months`` a list of months (YYYYMM00) whatever the grain.
    """
    if not exists(spark, path):
        return None
    table = spark.read.schema(schema).parquet(path)
    if bounds and "year" in table.columns:
        table = table.where(in_periods(table, *bounds))
    if only is not None and "year" in table.columns:
        table = table.where(among_periods(table, only))
    if months is not None and "year" in table.columns:
        table = table.where(among_months(months))
    return table.select(*schema.fieldNames())


def write_table(df: DataFrame, path: str) -> None:
    """Full rebuild of a plain Parquet table. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A plain table, or the current version of one published by ``publish_version``."""
    return spark.read.parquet(current(spark, path))


def save_table(df: DataFrame, name: str) -> None:
    """Full rebuild of a catalog table. ``df`` must not read from it."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def register(df: DataFrame, name: str = "weekly_performance") -> DataFrame:
    """Make ``df`` visible to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def run_query(spark: SparkSession, text: str, args: Sequence | None = None) -> DataFrame:
    """SQL over registered relations; ``?`` marks take ``args`` by position."""
    return spark.sql(text, args=list(args) if args else None)
