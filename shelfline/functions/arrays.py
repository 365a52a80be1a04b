"""Expressions on the 24-slot arrays; a column may be a native array or JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 24


def as_array(df: DataFrame, name: str, elem: str = "double") -> Column:
    """The column as an array, parsing it when it is text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.from_json(F.col(name), f"array<{elem}>")
    return F.col(name)


def array_len(arr: Column) -> Column:
    return F.size(arr)


def array_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def slot(arr: Column, idx: Column) -> Column:
    """NULL-safe element access by zero-based position."""
    return F.get(arr, idx)


def open_slots(arr: Column, start: int = 6, end: int = 22) -> Column:
    """The slots of the trading hours."""
    return F.slice(arr, start + 1, end - start)
