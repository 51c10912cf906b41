"""Samples and splits. Random order is a hash of key and seed, so every run draws the same rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.plans.ordered import cut_lineage, hash_head_flag, hash_rank, positions


def sample_rows(df: DataFrame, keys: Sequence[str], seed: int, n: int | None = None, fraction: float | None = None) -> DataFrame:
    """Exactly n rows, or the ceiling of a fraction of the rows, without replacement."""
    wanted = (lambda total: F.lit(n)) if n is not None else (lambda total: F.ceil(total * F.lit(fraction)))
    return hash_head_flag(df, keys, seed, wanted, "_in").where("_in").drop("_in")


# A larger expectation is drawn as a sum of independent parts of at most this size.
POISSON_PART = 16.0


def _poisson_cuts(rate: float) -> list[float]:
    """Cumulated Poisson masses up to the resolution of the 52-bit hash share."""
    cuts, mass, total, k = [], math.exp(-rate), 0.0, 0
    while 1.0 - total > 2.0**-53 and k < 40 + 10 * rate:
        total += mass
        cuts.append(total)
        k += 1
        mass *= rate / k
    return cuts


def sample_with_replacement(
    df: DataFrame, keys: Sequence[str], seed: int, fraction: float | None = None, n: int | None = None
) -> DataFrame:
    """Rows drawn with replacement, numbered by `draw`: exactly n draws, or as many as a fraction of the table.

    With a fraction every row gets a Poisson draw count from its own hash, without a bound: the cut-offs
    run on until what is left is finer than the hash. With n, draw i picks the row at a hashed
    position in key order.
    """
    if n is not None:
        return _n_draws(df, keys, seed, n)
    parts = max(1, math.ceil(fraction / POISSON_PART))
    cuts = F.array(*[F.lit(c) for c in _poisson_cuts(fraction / parts)])
    draws = F.lit(0)
    for part in range(parts):
        u = bucket_share(keys, seed + part)
        draws = draws + F.size(F.filter(cuts, lambda cut: cut < u))
    return df.withColumn("_draws", draws).withColumn(
        "draw", F.explode(F.when(F.col("_draws") > 0, F.sequence(F.lit(1), F.col("_draws"))))
    ).drop("_draws")


def hashed_number(seed: int, counter: str) -> Column:
    """A 60-bit number per counter value."""
    return F.conv(F.substring(F.sha2(F.concat_ws("#", F.col(counter).cast("string"), F.lit(str(seed))), 256), 1, 15), 16, 10).cast("bigint")


def _n_draws(df: DataFrame, keys: Sequence[str], seed: int, n: int) -> DataFrame:
    placed = cut_lineage(positions(df, [F.col(k).asc() for k in keys], "_at"))
    total = placed.count()
    if not total:
        return placed.drop("_at").withColumn("draw", F.lit(0))
    picks = df.sparkSession.range(1, n + 1).withColumnRenamed("id", "draw")
    picks = picks.select("draw", (hashed_number(seed, "draw") % F.lit(total)).alias("_at"))
    return placed.join(picks, "_at").drop("_at")


def bucket_share(keys: Sequence[str], seed: int) -> Column:
    """Uniform number in [0, 1) from the first 52 bits of the row's hash."""
    return F.conv(F.substring(hash_rank(keys, seed), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def chosen_with_probability(keys: Sequence[str], seed: int, p: float) -> Column:
    if p <= 0:
        return F.lit(False)
    if p >= 1:
        return F.lit(True)
    return bucket_share(keys, seed) <= p


def shuffled(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    return df.orderBy(hash_rank(keys, seed), *keys)


def train_test(df: DataFrame, keys: Sequence[str], seed: int, train: float = 0.7, out: str = "part", ceil_test: bool = False) -> DataFrame:
    """Shuffle, then the first int(train · n) rows train and the rest tests.

    `ceil_test` sizes the test part as the ceiling of its share instead.
    """
    def wanted(total: Column) -> Column:
        # rounded first: 0.1 · 30 is a little above 3 in binary
        if ceil_test:
            return total - F.ceil(F.round(total * F.lit(1 - train), 9))
        return F.floor(F.round(total * F.lit(train), 9))

    flagged = hash_head_flag(df, keys, seed, wanted, "_train")
    return flagged.withColumn(out, F.when(F.col("_train"), "train").otherwise("test")).drop("_train")


def any_value_per_group(df: DataFrame, group: Sequence[str], value: str, seed: int, out: str = "picked") -> DataFrame:
    """One seeded random value of each group."""
    return df.groupBy(*group).agg(F.min_by(value, hash_rank([value], seed)).alias(out))
