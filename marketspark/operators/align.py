"""Bring frames to one typed layout and stack them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def align(df: DataFrame, schema: T.StructType, extra: tuple[str, ...] = (), **values: str) -> DataFrame:
    """Select ``schema`` in its order; absent columns become typed nulls.

    ``values`` gives columns by SQL expression, ``extra`` keeps further columns behind.
    """
    present = set(df.columns)

    def pick(field: T.StructField) -> str:
        source = values.get(field.name, f"`{field.name}`" if field.name in present else "null")
        return f"cast({source} as {field.dataType.simpleString()}) as `{field.name}`"

    return df.selectExpr(*[pick(field) for field in schema.fields], *extra)


def stack(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)
