"""Published tables of several versions, of which readers see one.

A version is a folder that is written whole before a marker of its name appears below
``_versions``. To make an empty file that must not exist is one step in every store, so a
reader sees the version before or the one after, and a write that fails leaves nothing
that anyone reads. The last marker names the current version.
"""

from __future__ import annotations

import uuid

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.session import delete, exists

KEEP = 3


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the versions below ``root``, the current one last."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_versions")
    if not exists(spark, f"{root}/_versions"):
        return []
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(file.getPath().getName() for file in found)


def current(spark: SparkSession, root: str) -> str:
    """Folder of the current version; ``root`` itself where none was published."""
    names = versions(spark, root)
    return f"{root}/{names[-1]}" if names else root


def sorted_files(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows dealt by ranges of ``order`` and sorted in each, so files of that name order hold them in order.

    Readers of a range skip files and row groups by their bounds. The ranges come from a
    sample that Spark draws, and AQE does not join them.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def positions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a folder of sorted files with ``position``, from 1 on without gaps, as the files have them."""
    rows = spark.read.parquet(folder).selectExpr("*", "_metadata.file_name as _file", "_metadata.row_index as _row")
    # One row per file.
    counts = rows.groupBy("_file").agg(F.expr("count(*) as n")).selectExpr(
        "_file", "sum(n) over (order by _file rows between unbounded preceding and current row) - n as _before")
    return rows.join(counts, "_file").selectExpr("*", "_before + _row + 1 as position").drop("_file", "_row", "_before")


def publish_version(df: DataFrame, root: str, keep: int = KEEP, order: Sequence[str | Column] = ()) -> str:
    """Write ``df`` as a new version, make it the current one, and keep the last ``keep``.

    Readers that opened an older version go on with it until ``keep`` newer ones are
    there. ``df`` may read from the versions before. Of two writers at a time both
    versions are kept, and the one with the later marker is current. ``order`` sorts the
    rows over all files.
    """
    spark = df.sparkSession
    before = versions(spark, root)
    number = int(before[-1][1:9]) + 1 if before else 1
    name = f"v{number:08d}-{uuid.uuid4().hex}"
    (sorted_files(df, order) if order else df).write.parquet(f"{root}/{name}")
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_versions/{name}")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, False).close()
    for old in versions(spark, root)[:-keep]:
        delete(spark, f"{root}/_versions/{old}")
        delete(spark, f"{root}/{old}")
    return name
