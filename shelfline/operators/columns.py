"""Projections and column-level work."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.plans.ordered import positions


def by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def drop_suffixed(df: DataFrame, suffix: str = ".1") -> DataFrame:
    """Drop the duplicated join columns; the suffix is a literal, not a pattern."""
    kept = [F.col(f"`{c}`") for c in df.columns if not c.endswith(suffix)]
    return df.select(*kept)


def first_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Given columns first, the others behind in their order."""
    unknown = [c for c in first if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.select(*first, *[c for c in df.columns if c not in set(first)])


def column_slice(df: DataFrame, start: int, stop: int) -> DataFrame:
    return df.select(*df.columns[start:stop])


def columns_matching(df: DataFrame, pattern: str, anchored: bool = False) -> DataFrame:
    test = re.fullmatch if anchored else re.search
    return df.select(*[c for c in df.columns if test(pattern, c)])


def select_wanted(df: DataFrame, wanted: Mapping[str, str], missing: str = "error") -> DataFrame:
    """Select name → type; an absent column is an error, skipped, or filled with null."""
    absent = [c for c in wanted if c not in df.columns]
    if absent and missing == "error":
        raise ValueError(f"missing columns: {absent}")
    if missing not in ("error", "skip", "null"):
        raise ValueError(f"unknown policy: {missing}")
    cols = []
    for name, kind in wanted.items():
        if name in df.columns:
            cols.append(F.col(name).cast(kind).alias(name))
        elif missing == "null":
            cols.append(F.lit(None).cast(kind).alias(name))
    return df.select(*cols)


def stamp(df: DataFrame, **literals) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in literals.items()})


def stream_weight(stream: Column, weights: Mapping[str, float], other: float) -> Column:
    out = None
    for name, weight in weights.items():
        out = (F if out is None else out).when(stream == name, F.lit(weight))
    return out.otherwise(F.lit(other)) if out is not None else F.lit(other)


def fill_nulls(df: DataFrame, text: str = "") -> DataFrame:
    """Nulls of every text column become one label."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill(text, subset=names)


def all_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def row_ids(df: DataFrame, order: Sequence[Column], out: str = "row_id") -> DataFrame:
    """Dense 0-based row number in the given total order."""
    return positions(df, order, out)


def conform_text_columns(df: DataFrame, change) -> DataFrame:
    """Apply one text expression to every string column."""
    return df.select(
        *[
            change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
