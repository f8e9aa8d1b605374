"""A table of the objects below a root, kept up to date by what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.operators.upsert import upsert
from marketspark.schemas import OBJECT
from marketspark.sources.tables import read_by_date

_MARGIN = "interval 2 seconds"  # stores tell times in whole seconds


def read_index(spark: SparkSession, index: str) -> DataFrame:
    """path, modified, length and the date of ``modified``; empty before the first update."""
    table = read_by_date(spark, index, OBJECT)
    return spark.createDataFrame([], OBJECT) if table is None else table


def new_objects(spark: SparkSession, root: str, index: str, suffix: str = ".json") -> DataFrame:
    """Objects that were written since the last update of the index, or rewritten; contents are not read."""
    known = read_index(spark, index)
    last = known.agg(F.expr(f"date_format(max(modified) - {_MARGIN}, \"yyyy-MM-dd'T'HH:mm:ss\")")).first()[0]
    reader = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=f"*{suffix}")
    if last:
        reader = reader.options(modifiedAfter=last, timeZone="UTC")
    listed = reader.load(root).selectExpr(
        "cast(modificationTime as date) as date", "path", "modificationTime as modified", "length")
    # Around the last time of the index some are known already.
    recent = known.where(f"modified >= timestamp '{last}'") if last else known
    return listed.join(recent.select("path", "modified"), ["path", "modified"], "left_anti").select(*OBJECT.fieldNames())


def update_index(spark: SparkSession, root: str, index: str, suffix: str = ".json") -> None:
    """Merge new and rewritten objects into the index, by path. Objects that were deleted stay in it."""
    upsert(new_objects(spark, root, index, suffix), index, ("date", "path"), ("modified", "length"))


def indexed_paths(spark: SparkSession, index: str) -> DataFrame:
    """Every path of the index once; an object that was rewritten on another day has a row a day."""
    return read_index(spark, index).select("path").distinct()
