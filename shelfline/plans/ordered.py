"""Ordered work over groups of any size.

A window function sorts a whole group inside one task, which fails once a
single category holds a large part of the table. Here the rows are
range-partitioned by (group, order) instead, so a hot group is spread over as
many slices as it needs. Each slice is summed, the slice totals (at most one
row per group and slice) are accumulated, and every slice continues from the
total of the slices before it. Results are exact; the order given must be
total, so callers always pass a tiebreak column.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.session import passing_shuffles, scratch_path, scratch_table, sweep, tie_to_result

SLICE = "_slice"
LINE = "_line"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and go on from the files.

    The plan is run exactly once, a lost executor costs a re-read only, later
    branches read just the columns they use, and the planner knows the true
    size of what it joins. The files go with the scope, else when nothing reads them any more.
    """
    spark, table = df.sparkSession, scratch_table()
    with passing_shuffles(spark):
        if table:  # dropped with its scope
            df.write.format("parquet").saveAsTable(table)
            return spark.table(table)
        sweep(spark)
        path = scratch_path(spark, "rows")
        df.write.parquet(path)
    return tie_to_result(spark.read.schema(df.schema).parquet(path), path)


# Plan nodes over a file scan that cost no more when they run again.
CHEAP = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}
# Below these lies a shuffle, whose files are read again; what is before it runs once.
SHUFFLED = {"Aggregate", "RepartitionByExpression", "Repartition", "RebalancePartitions"}


def settled(df: DataFrame) -> DataFrame:
    """The rows of a frame that is about to run more than once: written down unless it is a plain scan or ends in a shuffle.

    Sampling the borders of range slices runs the input a second time, so do two passes over it.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in CHEAP and plan.children().size() == 1:
        plan = plan.children().head()
    return df if plan.nodeName() in CHEAP | SHUFFLED else cut_lineage(df)


def keys_present(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups are formed on non-null keys only."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def _sums_in_slice(keys: Sequence[str], value: str, out: str, kind: str):
    """Running sum per group over rows that arrive in order, one batch after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            group = [batch.column(k) for k in keys]
            values = pc.fill_null(batch.column(value), 0).to_numpy(zero_copy_only=False).astype(kind)
            changes = np.zeros(n, bool)
            for column in group:
                changes[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            if [c[0].as_py() for c in group] == last:
                values[0] += total
            borders = [0, *np.flatnonzero(changes).tolist(), n]
            sums = np.concatenate([np.cumsum(values[a:b]) for a, b in zip(borders[:-1], borders[1:])])
            last, total = [c[n - 1].as_py() for c in group], sums[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums)], [*batch.schema.names, out])

    return run


def _summable(df: DataFrame, keys: Sequence[str], value: str) -> str | None:
    """The numpy kind in which a value is summed in the order pass, if it can be."""
    plain = (T.StringType, T.IntegralType, T.BooleanType, T.DateType, T.TimestampType)
    if not all(isinstance(df.schema[k].dataType, plain) for k in keys):
        return None
    kind = df.schema[value].dataType
    return "float64" if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else (
        "int64" if isinstance(kind, T.IntegralType) else None)


def order_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str | None = None, out: str = "_in_slice"
) -> DataFrame:
    """Rows in (keys, order) order, tagged with a slice number and an increasing line number.

    The range borders come from a sample, so two runs may cut differently; the
    tagged rows are therefore written once and read by every later branch. The input runs once: one that is more
    than a scan and ends in no shuffle is written down before it is sampled.

    With a value, its running sum inside the slice is added while the rows pass in order; they
    need no second shuffle or sort for it.
    """
    ordering = [F.col(k).asc() for k in keys] + list(order)
    tagged = (
        settled(df).repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumn(SLICE, F.spark_partition_id())
        .withColumn(LINE, F.monotonically_increasing_id())
    )
    if value is None:
        return cut_lineage(tagged)
    kind = _summable(df, keys, value)
    if kind is None:  # decimals and composite keys: by a window over each slice
        w = Window.partitionBy(*keys, SLICE).orderBy(LINE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return cut_lineage(tagged.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0))))
    summed = T.StructType([*tagged.schema.fields, T.StructField(out, T.DoubleType() if kind == "float64" else T.LongType())])
    return cut_lineage(tagged.mapInArrow(_sums_in_slice(list(keys), value, out, kind), summed))


def _before(totals: DataFrame, keys: Sequence[str], part: str, out: str) -> DataFrame:
    """Sum of `part` over the earlier slices of the same group.

    Without keys there is one row per slice, so the single window is bounded by
    the number of partitions.
    """
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(SLICE)
    earlier = F.sum(part).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return totals.withColumn(out, F.coalesce(earlier, F.lit(0).cast(totals.schema[part].dataType)))


def _join_slices(sliced: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not keys:
        # one row per partition: bounded by the partition count, whatever the data
        return sliced.join(F.broadcast(totals), SLICE)
    return sliced.join(totals, [*keys, SLICE])


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, out: str,
    group_totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Cumulative sum inside each group; a null value keeps a null total at its row.

    `group_totals` (name → sum aggregate) puts whole-group sums on every row.
    They are added up from the slice totals, so they cost no further pass.
    """
    extra = dict(group_totals or {})
    sliced = order_slices(keys_present(df, keys), keys, order, value)
    per_slice = sliced.groupBy(*keys, SLICE).agg(
        F.coalesce(F.sum(value), F.lit(0)).alias("_part"), *[a.alias(n) for n, a in extra.items()]
    )
    totals = _before(per_slice, keys, "_part", "_before").drop("_part")
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    totals = totals.withColumns({n: F.sum(n).over(whole) for n in extra})
    total = F.col("_before") + F.col("_in_slice")
    return (
        _join_slices(sliced, totals, keys)
        .withColumn(out, F.when(F.col(value).isNotNull(), total))
        .drop(SLICE, LINE, "_before", "_in_slice")
    )


def positions(
    df: DataFrame, order: Sequence[Column], out: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Dense 0-based position of every row, over the table or inside each group."""
    sliced = order_slices(keys_present(df, keys), keys, order)
    totals = sliced.groupBy(*keys, SLICE).agg(
        F.count(F.lit(1)).alias("_part"), F.min(LINE).alias("_first")
    )
    totals = _before(totals, keys, "_part", "_before").drop("_part")
    return (
        _join_slices(sliced, totals, keys)
        .withColumn(out, F.col("_before") + F.col(LINE) - F.col("_first"))
        .drop(SLICE, LINE, "_before", "_first")
    )


def quantile_name(q: float) -> str:
    return f"p{round(q * 100):02d}"


def ranked_values(df: DataFrame, keys: Sequence[str], value: str, **extra: Column) -> DataFrame:
    """Distinct non-null values per group with their count `_n`, the rows up to them `_upto`,
    and the group's row count `_size` and value sum `_sum`; `extra` adds aggregates per value.

    Rows are counted per distinct value first, so repeated values never travel.
    """
    present = keys_present(df, keys).where(F.col(value).isNotNull())
    counts = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), *[a.alias(n) for n, a in extra.items()])
    sums = {"_size": F.sum("_n"), "_sum": F.sum(F.col(value).cast("double") * F.col("_n"))}
    return running_sum(counts, keys, [F.col(value).asc()], "_n", "_upto", sums)


def rank_picks(value: str, qs: Sequence[float]) -> tuple[list[Column], list[Column]]:
    """Aggregates over ranked values, and the columns made from them: interpolated quantiles."""
    picks, cols = [], []
    for q in qs:
        name = quantile_name(q)
        spot = (F.col("_size") - 1) * F.lit(float(q))
        for end, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            picks.append(F.min(F.when(F.col("_upto") > rank, F.col(value))).alias(f"_{end}_{name}"))
        picks.append(F.max(spot - F.floor(spot)).alias(f"_f_{name}"))
        lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        cols.append((lo + (hi - lo) * F.col(f"_f_{name}")).alias(name))
    return picks, cols


# Accuracy of the sketch that brackets a quantile: a bracket holds about 6 / ACCURACY of a group's rows.
ACCURACY = 2000
BELOW, INSIDE, ABOVE = 0, 1, 2


def bracket_stats(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float], **extra: Column) -> DataFrame:
    """One row per group with a non-null value: `_cuts`, two values around each quantile from a mergeable sketch, and `extra` aggregates."""
    margin = 3.0 / ACCURACY
    ends = [min(max(q + side, 0.0), 1.0) for q in qs for side in (-margin, margin)]
    cuts = F.percentile_approx(value, ends, ACCURACY).alias("_cuts")
    present = keys_present(df, keys).where(F.col(value).isNotNull())
    return cut_lineage(present.groupBy(*keys).agg(cuts, *[a.alias(n) for n, a in extra.items()]))


def bracket_counts(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float], stats: DataFrame) -> DataFrame:
    """Per group and quantile `_q`: the values inside the bracket with their count `_n`, and one row each for all below and above it.

    Counted where the rows lie; what travels is these counts. `_v` is the value, or the one nearest to the bracket.
    """
    named = stats.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], "_cuts")
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"_g{i}"))
    present = df.where(F.col(value).isNotNull()).join(named, on)
    v = F.col(value)
    zones = F.array(*[
        F.struct(F.lit(i).alias("q"), F.when(v < F.get("_cuts", F.lit(2 * i)), BELOW).when(v > F.get("_cuts", F.lit(2 * i + 1)), ABOVE).otherwise(INSIDE).alias("zone"))
        for i in range(len(qs))
    ])
    placed = present.select(*keys, v.alias("_v"), F.explode(zones).alias("_z"))
    own = F.when(F.col("_z.zone") == INSIDE, F.col("_v"))
    nearest = F.when(F.col("_zone") == BELOW, F.max("_v")).otherwise(F.min("_v"))
    return placed.groupBy(*keys, F.col("_z.q").alias("_q"), F.col("_z.zone").alias("_zone"), own.alias("_own")).agg(
        nearest.alias("_v"), F.count(F.lit(1)).alias("_n")).drop("_own")


def bracketed_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float], **extra: Column) -> DataFrame:
    """Exact quantiles per group with linear interpolation, one column per q (p25, p50, ...), and the `extra` aggregates.

    A sketch brackets each quantile; then the rows below the bracket are counted and only the values inside it
    are ranked. Near-unique values of a large table are never shuffled. A costly input is written down first, so it runs once.
    The sketch's error is bounded, so a rank outside its bracket cannot occur; it would fail the job, not give a wrong value.
    """
    df = settled(df.select(*keys, value))
    stats = bracket_stats(df, keys, value, qs, **extra)
    counts = bracket_counts(df, keys, value, qs, stats)
    ranked = running_sum(
        counts, [*keys, "_q"], [F.col("_zone").asc(), F.col("_v").asc()], "_n", "_upto", {"_size": F.sum("_n")})
    missed = F.raise_error(F.lit("a quantile lies outside its bracket")).cast(df.schema[value].dataType)
    picks, columns = [], []
    for i, q in enumerate(qs):
        spot = (F.col("_size") - 1) * F.lit(float(q))
        name = quantile_name(q)
        for end, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            here = (F.col("_q") == i) & (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)
            # of the rows below only the last is known, of those above only the first
            far = (F.col("_zone") == BELOW) & (F.col("_upto") - 1 != rank) | (F.col("_zone") == ABOVE) & (F.col("_upto") - F.col("_n") != rank)
            picks.append(F.max(F.when(here, F.when(far, missed).otherwise(F.col("_v")))).alias(f"_{end}_{name}"))
        picks.append(F.max(F.when(F.col("_q") == i, spot - F.floor(spot))).alias(f"_f_{name}"))
        lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        columns.append((lo + (hi - lo) * F.col(f"_f_{name}")).alias(name))
    found = ranked.groupBy(*keys).agg(*picks).select(*keys, *columns)
    return stats.drop("_cuts").join(found, list(keys)) if extra else found


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float]
) -> DataFrame:
    """Quantiles per group with linear interpolation, one column per q (p25, p50, ...)."""
    return bracketed_quantiles(df, keys, value, qs)


def hash_rank(key_cols: Sequence[str], seed: int) -> Column:
    """A reproducible random order: hex SHA-256 of the key and the seed."""
    return F.sha2(F.concat_ws("#", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))), 256)


# Hash digits by which a bucket is split per step (65,536 ways), and the bucket size that is ranked at last.
DIGITS = 4
RANKED_ROWS = 10_000


def hash_head_flag(
    df: DataFrame, key_cols: Sequence[str], seed: int, wanted: Callable[[Column], Column], out: str
) -> DataFrame:
    """Flag the first `wanted(total)` rows in hash order, without sorting the table.

    The key must identify a row. The hashes are written once; rows are counted per hash prefix, and
    the bucket that holds the cut is split by further digits until it is small enough to rank, so
    no step grows beyond 65,536 counts or `RANKED_ROWS` hashes. The table is then compared with
    the last hash taken in a plain scan. A costly input is written down first, so it runs once.
    """
    spark, df = df.sparkSession, settled(df)
    hashes = cut_lineage(df.select(hash_rank(key_cols, seed).alias("_hash")))
    total = hashes.count()
    missing = spark.range(1).select(wanted(F.lit(total)).cast("bigint")).first()[0]
    if missing <= 0:
        return df.withColumn(out, F.lit(False))
    if missing >= total:
        return df.withColumn(out, F.lit(True))
    prefix, inside = "", total
    while inside > RANKED_ROWS and len(prefix) < 64:
        bucket = F.substring("_hash", 1, len(prefix) + DIGITS).alias("_bucket")
        sizes = hashes.where(F.col("_hash").startswith(prefix)).groupBy(bucket).agg(F.count(F.lit(1)).alias("_n"))
        upto = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
        edge = sizes.withColumn("_upto", upto).where(F.col("_upto") >= missing).orderBy("_bucket").first()
        prefix, inside, missing = edge["_bucket"], edge["_n"], missing - (edge["_upto"] - edge["_n"])
    head = hashes.where(F.col("_hash").startswith(prefix)).orderBy("_hash").limit(missing)
    last = head.agg(F.max("_hash")).first()[0]
    return df.withColumn(out, hash_rank(key_cols, seed) <= F.lit(last))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
