"""Join shapes.

No side is broadcast by hint: file-backed lookups are broadcast when their
known size allows it, and adaptive execution does the same for aggregated
sides once their real size is known. Beyond that the joins are sort-merge
joins whose hot keys adaptive execution splits.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.text import normalise_label
from shelfline.operators.aggregates import join_texts
from shelfline.operators.columns import fill_nulls
from shelfline.operators.sampling import hashed_number
from shelfline.plans.ordered import cut_lineage, hash_head_flag, positions


def join_renamed(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join on differently named keys; the right keys are dropped."""
    prefixed = right.withColumnsRenamed({r: f"_r_{r}" for r in on.values()})
    condition = F.lit(True)
    for l, r in on.items():
        condition = condition & (left[l] == prefixed[f"_r_{r}"])
    return left.join(prefixed, condition, how).drop(*[f"_r_{r}" for r in on.values()])


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join in which a null key meets a null key."""
    prefixed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(prefixed[f"_r_{k}"])
    return left.join(prefixed, condition, how).drop(*[f"_r_{k}" for k in keys])


def lookup_with_default(left: DataFrame, lookup: DataFrame, on: Sequence[str], default: str) -> DataFrame:
    """Left join a lookup whose own empty cells carry a label."""
    return left.join(fill_nulls(lookup, default), list(on), "left")


def in_other(df: DataFrame, other: DataFrame, column: str, other_column: str) -> DataFrame:
    keys = other.select(F.col(other_column).alias("_key"))
    return df.join(keys, F.col(column) == F.col("_key"), "left_semi")


def in_frequent(df: DataFrame, other: DataFrame, column: str, other_column: str, more_than: int) -> DataFrame:
    """Rows whose id occurs more than n times in the other table."""
    frequent = other.groupBy(other_column).count().where(F.col("count") > more_than)
    return in_other(df, frequent, column, other_column)


def leaves_under(roots: DataFrame, nodes: DataFrame, root: str, path: str) -> DataFrame:
    """Each root with the nodes whose path starts with it, also where it ends inside an element.

    Roots have few distinct lengths. Each path is repeated once per length with its head of that
    length, and heads meet roots by an equi-join: no pair is formed that does not match.
    """
    lengths = roots.select(F.char_length(root).alias("_length")).agg(F.collect_set("_length")).scalar()
    heads = nodes.withColumn("_length", F.explode(lengths)).where(F.char_length(path) >= F.col("_length"))
    headed = heads.withColumn("_head", F.left(F.col(path), F.col("_length"))).drop("_length")
    return roots.join(headed, F.col(root) == F.col("_head")).drop("_head")


# An option table up to this size is sent to every task; a larger one is shuffled by its key.
MOST_OPTION_BYTES = 32 << 20


def with_group_options(
    df: DataFrame, options: DataFrame, keys: Sequence[str], option: str, separator: str = "\n", out: str = "options"
) -> DataFrame:
    """Join every row to the distinct options of its category, as one text.

    The lists are written first and their size is read off: small ones are broadcast, so the
    rows stay where they are; large ones meet the rows in a shuffle.
    """
    lists = cut_lineage(join_texts(options, keys, option, separator, out))
    size = lists.agg(F.sum(F.octet_length(out))).first()[0] or 0
    return df.join(F.broadcast(lists) if size <= MOST_OPTION_BYTES else lists, list(keys), "left")


def join_normalised(left: DataFrame, right: DataFrame, left_on: str, right_on: str, normalise=normalise_label) -> DataFrame:
    """Labels match when equal after normalisation; the smallest right label wins."""
    one = right.groupBy(normalise(F.col(right_on)).alias("_key")).agg(F.min(right_on).alias(right_on))
    return left.withColumn("_key", normalise(F.col(left_on))).join(one, "_key", "left").drop("_key")


def sample_combinations(
    sides: Sequence[tuple[DataFrame, Sequence[Column]]], n: int, seed: int
) -> DataFrame:
    """n distinct random combinations of one row from each side, all equally likely; the product is never formed.

    A side is a table and a total order of its rows. Combination numbers are drawn by hash and decoded
    into one position per side. Beyond half of all combinations their numbers are ranked by hash instead,
    which is then no more than twice the rows asked for.
    """
    spark = sides[0][0].sparkSession
    placed = [cut_lineage(positions(df, order, f"_at{i}")) for i, (df, order) in enumerate(sides)]
    sizes = [p.count() for p in placed]
    total = math.prod(sizes)
    if n > total:
        raise ValueError(f"at most {total} combinations can be made")
    if 2 * n >= total:
        numbers = spark.range(total).withColumnRenamed("id", "_pick")
        picks = hash_head_flag(numbers, ["_pick"], seed, lambda _: F.lit(n), "_in").where("_in").drop("_in")
    else:
        draws = 2 * n + 64
        while True:
            drawn = spark.range(draws).select("id", (hashed_number(seed, "id") % F.lit(total)).alias("_pick"))
            firsts = cut_lineage(drawn.groupBy("_pick").agg(F.min("id").alias("_drawn")))
            if firsts.count() >= n:
                break
            draws *= 2
        picks = top_rows(firsts, "_drawn", n).select("_pick")
    out = picks
    for i in reversed(range(len(placed))):
        out = out.withColumn(f"_at{i}", F.expr(f"({_whole_division(sizes[i + 1:])}) % {sizes[i]}L"))
    for i, side in enumerate(placed):
        out = out.join(side, f"_at{i}").drop(f"_at{i}")
    return out.drop("_pick")


def _whole_division(sizes: Sequence[int]) -> str:
    return "_pick" + "".join(f" div {size}L" for size in reversed(sizes))


def top_rows(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n rows with the smallest values of a unique column, by sliced positions."""
    return positions(df, [F.col(column).asc()], "_rank").where(F.col("_rank") < n).drop("_rank")
