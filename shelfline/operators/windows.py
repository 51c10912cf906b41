"""Ranking and running totals per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.operators.columns import stream_weight
from shelfline.operators.filters import share_band
from shelfline.plans.ordered import ACCURACY, cut_lineage, keys_present, positions, running_sum


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "rank", sliced: bool = False
) -> DataFrame:
    """First k rows of each group (k rows, rank from 1). Null keys form no group.

    The rank filter sits right on the window, so each task keeps k rows per group before the
    shuffle and a hot group never travels whole; Spark does so up to
    `spark.sql.optimizer.windowGroupLimitThreshold`. `sliced` ranks by sliced positions instead,
    for a k that is not small beside the group.
    """
    if sliced:
        placed = positions(df, order, out, keys)
        return placed.where(F.col(out) < k).withColumn(out, (F.col(out) + 1).cast("int"))
    ranked = keys_present(df, keys).withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(out) <= k)


# The share of a group's rows among which its first distinct rows are looked for.
LEADING = 0.01


def top_distinct_per_group(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column], k: int, spread: DataFrame | None = None, out: str = "rank"
) -> DataFrame:
    """First k distinct rows of each group, largest `value` first and then by `order`, which names all other columns. Null keys form no group.

    A sketch of the values (of `spread`, a table with about their distribution, or `df`) gives a value that about `LEADING` of a
    group's rows reach. Where k distinct rows do, the first k are among them, so no others are made distinct. A group
    with fewer such rows, as it is small or repeats itself, is made distinct whole.
    """
    present = keys_present(df, keys)
    sketched = keys_present(df if spread is None else spread, keys).where(F.col(value).isNotNull())
    cuts = cut_lineage(sketched.groupBy(*keys).agg(F.percentile_approx(value, 1 - LEADING, ACCURACY).alias("_cut")))
    leading = cut_lineage(present.join(cuts, list(keys)).where(F.col(value) >= F.col("_cut")).drop("_cut").dropDuplicates())
    full = cut_lineage(leading.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).drop("_n"))
    others = present.join(full, list(keys), "left_anti").dropDuplicates()
    found = leading.join(full, list(keys), "left_semi").unionByName(others)
    return top_per_group(found, keys, [F.col(value).desc(), *order], k, out)


def pareto_head(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    tiebreak: Sequence[str],
    share: float = 0.4,
    include_crossing: bool = False,
) -> DataFrame:
    """Largest rows of each group that together make up a share of the group total."""
    order = [F.col(value).desc(), *[F.col(c).asc() for c in tiebreak]]
    return share_band(df, keys, order, value, share, include_crossing)


def running_weight(
    df: DataFrame, keys: Sequence[str], stream: str, weights: Mapping[str, float], other: float
) -> DataFrame:
    """Channel weight and its running total per group, channels in name order."""
    weighted = df.withColumn("weight", stream_weight(F.col(stream), weights, other))
    return running_sum(weighted, keys, [F.col(stream).asc()], "weight", "cum_weight")


def ranked_attributes(
    df: DataFrame,
    keyword: str,
    category: str,
    stream: str,
    attribute: str,
    weights: Mapping[str, float],
    other: float,
    k: int = 11,
) -> DataFrame:
    """Distinct keywords per (category, channel, attribute), the k best attributes of each
    channel, and the channel list with the summed channel weight per (category, attribute)."""
    counts = df.groupBy(category, stream, attribute).agg(F.countDistinct(keyword).alias("key_count"))
    best = top_per_group(
        counts, [category, stream], [F.col("key_count").desc(), F.col(attribute).asc()], k
    )
    weighted = best.withColumn("weight", stream_weight(F.col(stream), weights, other))
    return combine_channels(weighted, [category, attribute], stream, "weight")


def combine_channels(df: DataFrame, keys: Sequence[str], stream: str, weight: str) -> DataFrame:
    """Channel list and weight per group; a group holds at most one row per channel."""
    return df.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set(stream)), ", ").alias("streams"),
        F.round(F.sum(weight), 6).alias("cum_weight"),
    )
