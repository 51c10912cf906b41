"""Sorts, limits and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.plans.ordered import cut_lineage, positions, union_all


def sorted_by(df: DataFrame, columns: Sequence[str], descending: bool = False) -> DataFrame:
    """One direction for all columns, nulls last either way."""
    return df.orderBy(*order_nulls_last(columns, descending))


def order_nulls_last(columns: Sequence[str], descending: bool = False) -> list[Column]:
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in columns]


def with_sorted_position(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    return positions(df, order, out)


def k_extremes(df: DataFrame, value: str, tiebreak: Sequence[str], k: int, how: str = "max", ascending: bool | None = None) -> DataFrame:
    """The k largest (`max`) or smallest (`min`) values from a bounded heap per task, with their `place`.

    By default the most extreme value comes first; `ascending` sorts the k rows the other way. Null values
    are not extremes.
    """
    if how not in ("max", "min"):
        raise ValueError(f"unknown side: {how}")
    first = F.col(value).desc() if how == "max" else F.col(value).asc()
    best = df.where(F.col(value).isNotNull()).orderBy(first, *[F.col(c).asc() for c in tiebreak]).limit(k)
    rising = ascending if ascending is not None else how == "min"
    shown = F.col(value).asc() if rising else F.col(value).desc()
    # k rows
    order = Window.partitionBy(F.lit(0)).orderBy(shown, *[F.col(c).asc() for c in tiebreak])
    return best.withColumn("place", F.row_number().over(order) - 1)


def top_and_bottom(
    df: DataFrame, value: str, tiebreak: Sequence[str], k: int, position: Sequence[Column] = (), ascending: bool | None = None
) -> DataFrame:
    """k largest and k smallest values with their ids and, given an order of the table, their 0-based position in it."""
    rows = cut_lineage(positions(df, position, "position")) if position else df
    sides = {"largest": "max", "smallest": "min"}
    return append(*[k_extremes(rows, value, tiebreak, k, how, ascending).withColumn("side", F.lit(side)) for side, how in sides.items()])


def append(*frames: DataFrame) -> DataFrame:
    """Append tables; a column absent in one of them is null there."""
    return union_all(frames)


def merge_distinct(master: DataFrame, *new: DataFrame) -> DataFrame:
    """Master plus new rows, duplicates removed."""
    return append(master, *new).dropDuplicates()


def common_values(a: DataFrame, a_col: str, b: DataFrame, b_col: str, out: str = "value") -> DataFrame:
    return a.select(F.col(a_col).alias(out)).intersect(b.select(F.col(b_col).alias(out)))


def containment(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """One row: is every distinct value of a also in b; how many are not."""
    outside = a.select(F.col(a_col).alias("v")).distinct().join(
        b.select(F.col(b_col).alias("v")), "v", "left_anti"
    )
    return outside.agg(F.count(F.lit(1)).alias("n_outside")).select(
        (F.col("n_outside") == 0).alias("is_subset"), "n_outside"
    )
