"""Profiles and roll-ups over text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions.dates import as_date
from shelfline.functions.maps import NUMBER, as_integer
from shelfline.functions.paths import ancestor_paths
from shelfline.operators.sampling import chosen_with_probability, sample_rows


def _readable(name: str, kind: T.DataType) -> dict[str, Column]:
    """Tests of a column's values. The type answers for a typed column; each later test of a
    text column runs only where the earlier ones failed."""
    value = F.col(f"`{name}`")
    filled, never = value.isNotNull(), F.lit(False)
    if isinstance(kind, T.BooleanType):
        return {"n_bool": filled, "n_int": never, "n_float": never, "n_date": never}
    if isinstance(kind, T.IntegralType):
        return {"n_bool": never, "n_int": filled, "n_float": filled, "n_date": never}
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return {"n_bool": never, "n_int": never, "n_float": filled & ~F.isnan(value) & (F.abs(value) < float("inf")), "n_date": never}
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return {"n_bool": never, "n_int": never, "n_float": never, "n_date": filled}
    text = value.cast("string")
    is_bool = F.lower(F.trim(text)).isin("true", "false")
    is_float = F.when(is_bool, False).otherwise(text.rlike(NUMBER))
    is_int = F.when(is_float, as_integer(text).isNotNull())
    is_date = F.when(is_bool | is_float, False).otherwise(as_date(text).isNotNull())
    return {"n_bool": is_bool, "n_int": is_int, "n_float": is_float, "n_date": is_date}


def column_types(
    df: DataFrame, columns: Sequence[str] | None = None, sample: int | float | None = None, keys: Sequence[str] = (), seed: int = 0
) -> DataFrame:
    """For each column: rows, nulls, rows readable as bool, int, float, date, and the
    narrowest type that fits all non-null rows.

    One aggregate over one scan; its single row is turned into one row per column. `sample` looks at
    so many rows (int) or that share of them (float) instead of all, picked by the key columns.
    """
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if isinstance(sample, float):
        df = df.where(chosen_with_probability(list(keys) or columns, seed, sample))
    elif sample is not None:
        df = sample_rows(df, list(keys) or columns, seed, n=sample)
    figures = []
    for i, c in enumerate(columns):
        tests = {"n_null": F.col(f"`{c}`").isNull(), **_readable(c, kinds[c])}
        figures.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(F.lit(1)).alias("n"),
                *[F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in tests.items()],
            ).alias(f"c{i}")
        )
    wide = df.agg(*figures)
    rows = wide.select(F.inline(F.array(*[f"c{i}" for i in range(len(columns))])))
    filled = F.col("n") - F.col("n_null")
    narrowest = (
        F.when(filled == 0, "null")
        .when(F.col("n_bool") == filled, "bool")
        .when(F.col("n_int") == filled, "int")
        .when(F.col("n_float") == filled, "float")
        .when(F.col("n_date") == filled, "date")
        .otherwise("text")
    )
    return rows.withColumn("narrowest", narrowest)


def path_rollup(df: DataFrame, parts: Column, separator: str) -> DataFrame:
    """Every ancestor of every path with its depth, the rows and distinct paths at or below
    it, whether it is itself a path, and whether it is both a path and an inner node."""
    paths = df.select(F.array_join(parts, separator).alias("full"), parts.alias("parts"))
    counted = paths.groupBy("full", "parts").agg(F.count(F.lit(1)).alias("_rows"))
    nodes = counted.select(
        "full", "_rows", F.posexplode(ancestor_paths(F.col("parts"), separator)).alias("_i", "node")
    )
    return (
        nodes.groupBy("node", (F.col("_i") + 1).alias("depth"))
        .agg(
            F.sum("_rows").alias("n_rows"),
            F.count(F.lit(1)).alias("n_paths"),
            F.max(F.col("full") == F.col("node")).alias("is_path"),
        )
        .withColumn("is_inner_path", F.col("is_path") & (F.col("n_paths") > 1))
    )
