"""Row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.text import SENTINELS, STOP_PHRASES, blank_to_null, has_stop_phrase
from shelfline.operators.aggregates import describe
from shelfline.plans.ordered import positions, running_sum


def in_list(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def above_group_statistic(df: DataFrame, keys: Sequence[str], value: str, statistic: str = "p75") -> DataFrame:
    """Rows whose value reaches a statistic of their own group (min, mean, p25, p50, p75)."""
    # only the statistic asked for is worked out; min and mean need no ranking at all
    stats = describe(df, keys, value, columns=[statistic])
    return df.join(stats, list(keys)).where(F.col(value) >= F.col(statistic)).drop(statistic)


def without_stop_phrases(
    df: DataFrame, column: str, phrases: Sequence[str] = STOP_PHRASES, literal: bool = False
) -> DataFrame:
    return df.where(~has_stop_phrase(column, phrases, literal))


def without_sentinels(df: DataFrame, column: str, trim: bool = True, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Drop null and no-answer values; `trim=False` keeps values that only differ by spaces."""
    value = F.trim(column) if trim else F.col(column)
    return df.withColumn(column, value).where(F.col(column).isNotNull() & ~F.col(column).isin(*sentinels))


def with_value(df: DataFrame, column: str) -> DataFrame:
    """Null and blank text both count as missing."""
    if dict(df.dtypes)[column] == "string":
        return df.where(blank_to_null(F.col(column)).isNotNull())
    return df.where(F.col(column).isNotNull())


def starts_with_any(column: str | Column, prefixes: Sequence[str]) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    test = F.lit(False)
    for prefix in prefixes:
        test = test | column.startswith(prefix)
    return test


def in_calendar(column: str, years: Sequence[int] = (), months: Sequence[int] = ()) -> Column:
    """Dates in the given years and months, as ranges of the bare column so a scan can skip row groups.

    Months without years cannot be ranges and are read off each date.
    """
    if not years:
        return F.month(column).isin(*months) if months else F.lit(True)
    numbers = sorted({12 * y + m - 1 for y in years for m in (months or range(1, 13))})
    spans: list[list[int]] = []
    for number in numbers:
        if spans and spans[-1][1] == number:
            spans[-1][1] = number + 1
        else:
            spans.append([number, number + 1])
    first_of = lambda number: F.lit(dt.date(number // 12, number % 12 + 1, 1))
    test = F.lit(False)
    for start, stop in spans:
        test = test | ((F.col(column) >= first_of(start)) & (F.col(column) < first_of(stop)))
    return test


def row_range(df: DataFrame, order: Sequence[Column], first: int, last: int | None = None) -> DataFrame:
    """Rows by 0-based position, both ends included; no end means to the last row."""
    placed = positions(df, order, "row_id")
    upto = F.lit(True) if last is None else F.col("row_id") <= last
    return placed.where((F.col("row_id") >= first) & upto)


def share_band(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    share: float = 0.4,
    include_crossing: bool = False,
) -> DataFrame:
    """Head rows of each group whose running total stays within a share of the group total.

    A single row above the share leaves its group empty, unless the row that
    crosses the border is asked for.
    """
    running = running_sum(df, keys, order, value, "running_value", {"total_value": F.sum(value)})
    reached = F.col("running_value") - (F.col(value) if include_crossing else F.lit(0))
    inside = reached / F.col("total_value")
    return running.where(inside < share if include_crossing else inside <= share)


def min_group_size(df: DataFrame, keys: Sequence[str], more_than: int) -> DataFrame:
    """Rows of groups with more than n rows; counted map-side, then a semi join."""
    large = df.groupBy(*keys).count().where(F.col("count") > more_than).select(*keys)
    return df.join(large, list(keys), "left_semi")


def keep_items(values: Column, keep: Sequence) -> Column:
    return F.filter(values, lambda x: x.isin(*keep))


def remove_items(values: Column, remove: Sequence) -> Column:
    return F.filter(F.array_compact(values), lambda x: ~x.isin(*remove))


def null_count(columns: Sequence[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNull().cast("int")
    return total


def equal_across(columns: Sequence[str]) -> Column:
    test = F.lit(True)
    for c in columns[1:]:
        test = test & F.col(columns[0]).eqNullSafe(F.col(c))
    return test
