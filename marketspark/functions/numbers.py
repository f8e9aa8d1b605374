"""Numbers: one missing value (null), no NaN or infinity past staging."""

from __future__ import annotations

from pyspark.sql import types as T

NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(value: str, kind: T.DataType) -> str:
    """A column as double; unreadable text and NaN become null."""
    if isinstance(kind, T.StringType):
        return f"if({value} rlike r'{NUMBER_PATTERN}', try_cast({value} as double), null)"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return f"if(isnan({value}), null, cast({value} as double))"
    return f"cast({value} as double)"


def double(value: str) -> str:
    """Plain lenient cast, for values whose shape a rule has already checked."""
    return f"try_cast({value} as double)"


def whole(value: str, kind: T.DataType) -> str:
    """A column as bigint; unreadable values become null."""
    if isinstance(kind, (T.StringType, T.DoubleType, T.FloatType)):
        return f"coalesce(try_cast({value} as bigint), try_cast({number(value, kind)} as bigint))"
    return f"cast({value} as bigint)"


def positive(value: str) -> str:
    """Greater than zero and finite; NaN sorts above infinity, so it fails too."""
    return f"{value} > 0 and {value} < double('Infinity')"


def rounded(value: str, digits: int, half_even: bool = False) -> str:
    return f"{'bround' if half_even else 'round'}({value}, {digits})"
