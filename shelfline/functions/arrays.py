"""Nested arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def array_levels(kind: T.DataType) -> int:
    """How many arrays lie inside each other in a column type."""
    return 1 + array_levels(kind.elementType) if isinstance(kind, T.ArrayType) else 0


def flatten_all(values: Column, levels: int) -> Column:
    """One array of all elements of arrays nested `levels` deep, in order; a null inner array counts as empty."""
    for _ in range(levels - 1):
        values = F.flatten(F.array_compact(values))
    return values


def flatten_inner(values: Column, levels: int) -> Column:
    """The outer array as it is, each of its elements flattened to one array."""
    return F.transform(values, lambda inner: flatten_all(inner, levels - 1))
