"""Which days of a table differ from an older state of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SUMS = ("rows", "digest", "total")


def day_digests(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per date the number of rows and two sums of their hashes; neither depends on their order.

    The aggregate is combined before the shuffle, so a day costs one row per task.
    """
    names = ", ".join(f"`{name}`" for name in columns)
    return rows.groupBy("date").agg(
        F.expr("count(*) as rows"), F.expr(f"bit_xor(xxhash64({names})) as digest"),
        F.expr(f"sum(cast(xxhash64('again', {names}) as decimal(38, 0))) as total"))


def changed_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """Dates whose rows are not the same in both, one row each; rows are compared in the columns of ``after``."""
    columns = after.columns
    old = day_digests(before, columns).selectExpr("date", *[f"{name} as old_{name}" for name in _SUMS])
    same = " and ".join(f"{name} <=> old_{name}" for name in _SUMS)
    return day_digests(after, columns).join(old, "date", "full").where(f"not ({same})").select("date")
