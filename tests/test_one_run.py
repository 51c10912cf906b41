"""Ranked and bracketed work runs a costly input once, counted by an accumulator in the input itself."""

import pytest
from pyspark.sql import functions as F

from shelfline.operators import aggregates, sampling, windows
from shelfline.plans import ordered


def counted(spark, n=2000):
    """A frame whose rows count themselves when they are made."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.range(n).select((F.col("id") % 5).alias("g"), F.col("id").alias("k"), (F.col("id") * 37 % 101).cast("double").alias("v"))
    return rows.mapInArrow(run, rows.schema), made


WORK = {
    "running sum": lambda df: ordered.running_sum(df, ["g"], [F.desc("v"), F.asc("k")], "v", "upto"),
    "positions": lambda df: ordered.positions(df, [F.asc("v"), F.asc("k")], "at"),
    "pareto head": lambda df: windows.pareto_head(df, ["g"], "v", tiebreak=["k"]),
    "quantiles": lambda df: ordered.exact_quantiles(df, ["g"], "v", [0.25, 0.75]),
    "describe": lambda df: aggregates.describe(df, ["g"], "v"),
    "strategies": lambda df: aggregates.by_strategies(df, ["g"], "v", "k"),
    "exact sample": lambda df: sampling.train_test(df, ["k"], 7),
}


@pytest.mark.parametrize("name", WORK)
def test_the_input_runs_once(spark, name):
    df, made = counted(spark)
    assert WORK[name](df).count() > 0
    assert made.value == 2000


def test_scans_and_shuffled_rows_are_not_copied(spark, tables):
    plain = tables.lineitem.where("l_quantity > 3").select("l_orderkey", (F.col("l_tax") * 2).alias("x"))
    assert ordered.settled(plain) is plain
    summed = tables.lineitem.groupBy("l_orderkey").agg(F.sum("l_tax").alias("x")).where("x > 0")
    assert ordered.settled(summed) is summed
    joined = tables.lineitem.join(tables.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    assert ordered.settled(joined) is not joined
