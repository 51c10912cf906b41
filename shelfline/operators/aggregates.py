"""Group statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.plans.ordered import bracketed_quantiles, keys_present, rank_picks, ranked_values

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
# A cell and the row around it must stay below the 2 GB a row can have.
MOST_BYTES = 1 << 30
DESCRIBE = ("n", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe(
    df: DataFrame, keys: Sequence[str], value: str, columns: Sequence[str] = DESCRIBE
) -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles per group.

    The deviation of a one-row group falls back to its minimum. The quartiles come from sketched brackets and
    an exact ranking inside them (`bracketed_quantiles`), all other figures from the same aggregate as the sketch.
    """
    if not keys:
        return describe(df.withColumn("_all", F.lit(0)), ["_all"], value, columns).drop("_all")
    plain = {
        "n": F.count(value),
        "mean": F.avg(value),
        "std": F.coalesce(F.stddev_samp(value), F.min(value).cast("double")),
        "min": F.min(value),
        "max": F.max(value),
    }
    wanted = {c: plain[c] for c in columns if c in plain}
    qs = [QUARTILES[c] for c in columns if c in QUARTILES]
    if not qs:
        return keys_present(df, keys).groupBy(*keys).agg(*[a.alias(c) for c, a in wanted.items()])
    return bracketed_quantiles(df, keys, value, qs, **wanted).select(*keys, *columns)


def value_counts(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    return keys_present(df, [column]).groupBy(column).agg(F.count(F.lit(1)).alias(out))


def join_texts(
    df: DataFrame, keys: Sequence[str], text: str, separator: str = ", ", out: str = "texts"
) -> DataFrame:
    """Distinct texts of a group, sorted and joined.

    The joined text is one cell, so a group is as large as a cell may be: beyond `MOST_BYTES`
    the job fails and names the group size; nothing is cut. Repeats are removed by a shuffle on (group, text) first, so a hot group
    brings only its distinct texts to the task that writes the joined value.
    """
    distinct = keys_present(df, keys).where(F.col(text).isNotNull()).select(*keys, text).distinct()
    size = F.sum(F.octet_length(text) + len(separator.encode()))
    joined = distinct.groupBy(*keys).agg(size.alias("_bytes"), F.array_join(F.array_sort(F.collect_list(text)), separator).alias("_joined"))
    refused = F.raise_error(F.concat(F.lit("texts of one group are too large for a cell, bytes: "), F.col("_bytes").cast("string")))
    return joined.select(*keys, F.when(F.col("_bytes") > MOST_BYTES, refused.cast("string")).otherwise(F.col("_joined")).alias(out))


def distinct_over_columns(df: DataFrame, columns: Sequence[str], out: str = "value") -> DataFrame:
    """Distinct non-null values of several columns taken together, in one scan."""
    return (
        df.select(F.explode(F.array_distinct(F.array(*columns))).alias(out))
        .where(F.col(out).isNotNull())
        .distinct()
    )


def nonnull_in_row(columns: Sequence[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNotNull().cast("int")
    return total


def mode_of(df: DataFrame, keys: Sequence[str], value: str, out: str = "mode") -> DataFrame:
    """Most frequent value; the smallest one on a tie. Counted per (group, value) first."""
    counts = keys_present(df, keys).where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    best = counts.groupBy(*keys).agg(F.max("_n").alias("_best"))
    return (
        counts.join(best, list(keys))
        .where(F.col("_n") == F.col("_best"))
        .groupBy(*keys)
        .agg(F.min(value).alias(out))
    )


def by_strategies(df: DataFrame, keys: Sequence[str], value: str, at: str) -> DataFrame:
    """average, min, max, sum, first (by time), median and mode of a value per group; ties take the smallest value.

    All come from one table of values counted per group and ranked. The median of a group is the
    mean of its middle values.
    """
    ranked = ranked_values(df, keys, value, _at=F.min(at))
    picks, (median,) = rank_picks(value, [0.5])
    v = F.col(value)
    stats = ranked.groupBy(*keys).agg(
        (F.max("_sum") / F.max("_size")).alias("average"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.max("_sum").alias("sum"), F.min_by(value, F.struct("_at", value)).alias("first"),
        F.min(F.struct((-F.col("_n")).alias("less"), v.alias("v")))["v"].alias("mode"), *picks,
    )
    return stats.select(*keys, "average", "min", "max", "sum", "first", median.alias("median"), "mode")


def single_value(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The one value of each group, or null and a flag where there are several."""
    found = keys_present(df, keys).groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    one = F.coalesce(F.col("_lo") == F.col("_hi"), F.lit(False))
    return found.select(*keys, F.when(one, F.col("_lo")).alias(value), one.alias("is_single"))


def with_group_total(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Group aggregates on every row.

    An aggregate joined back rather than a window: the group is summed map-side
    and a hot group stays spread over its tasks.
    """
    totals = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return df.join(totals, list(keys), "left")


