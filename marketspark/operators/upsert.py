"""Keyed delete-and-insert on date-partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from marketspark.operators.dedupe import dedupe
from marketspark.session import drop_stored, stored
from marketspark.sources.tables import period, read_by_date, write_by_date


def merge(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """New content of the partitions that ``batch`` touches, given their old content.

    Target rows whose key is in the batch go, all others stay, and the batch comes
    in. With ``order`` the last row of each key by it wins, whichever side it is on.
    ``batch`` must hold one row per key.
    """
    known = batch.select(*keys)
    kept = target.join(known, list(keys), "left_anti")
    if order:
        rivals = target.join(known, list(keys), "left_semi")
        batch = dedupe(rivals.unionByName(batch), keys, order)
    return kept.unionByName(batch)


def upsert(
    batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], grain: str = "month",
    keep_latest: bool = False, replaced: Sequence[str] | None = None,
) -> None:
    """Apply ``batch`` to the table at ``path``; the last row per key wins.

    A batch replaces what is there. With ``keep_latest`` a row that is there stays if
    it is later by ``order``, so the result does not depend on how rows are split
    into batches. The batch is written to the scratch folder first, so its plan runs
    once and every later step sees the same rows even if a task is run again; the
    copy is deleted at the end. Only the partitions that the batch touches are read
    and replaced. Running a batch again changes nothing. The commit is per partition:
    readers may see some partitions new and others old until it ends.
    """
    spark = batch.sparkSession
    batch = stored(dedupe(batch, keys, order), "batch")
    touched = sorted(r[0] for r in batch.selectExpr(period(grain)).distinct().collect())  # one per day or month
    if touched:
        target = read_by_date(spark, path, batch.schema, only=touched)
        rows = batch if target is None else merge(target, batch, replaced or keys, order if keep_latest else None)
        write_by_date(rows, path, grain)
    drop_stored(batch)
