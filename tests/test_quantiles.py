"""Bracketed quantiles: exact for every shape of data, and only the brackets travel."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.operators import aggregates
from shelfline.plans import ordered

QS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def shapes():
    rng = np.random.default_rng(11)
    yield "one", [3.0]
    for n in (2, 3, 4, 5, 7, 8, 101, 999, 2001):
        yield f"distinct{n}", rng.permutation(n).astype(float).tolist()
        yield f"ties{n}", rng.integers(0, max(2, n // 10), n).astype(float).tolist()
    yield "unique", rng.normal(0, 1, 60_000).tolist()
    yield "hot", [1.0] * 50_000 + rng.normal(0, 1, 10_000).tolist()
    yield "two", [0.0] * 20_000 + [1.0] * 20_000
    yield "sorted", np.arange(30_000.0).tolist()
    yield "infinite", [float("-inf"), 1.0, 2.0, float("inf")]


@pytest.fixture(scope="module")
def groups(spark):
    import pandas as pd

    data = dict(shapes())
    pdf = pd.concat([pd.DataFrame({"g": g, "v": v}) for g, v in data.items()])
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([("null", None), (None, 1.0), ("one", None)], "g string, v double"))
    return ordered.cut_lineage(df.repartition(6)), data


def test_quantiles_equal_numpy(groups):
    df, data = groups
    got = {r.g: r for r in ordered.exact_quantiles(df, ["g"], "v", QS).collect()}
    assert set(got) == set(data)
    for g, values in data.items():
        if g != "infinite":
            assert np.allclose([got[g][ordered.quantile_name(q)] for q in QS], np.quantile(values, QS), rtol=0, atol=1e-12), g
    assert got["infinite"].p25 == float("-inf") or np.isnan(got["infinite"].p25) and got["infinite"].p50 == 1.5


def test_only_the_brackets_are_ranked(groups, spark):
    df, data = groups
    qs = [0.25, 0.5, 0.75]
    one = df.where("g = 'unique'")
    stats = ordered.bracket_stats(one, ["g"], "v", qs)
    counts = ordered.bracket_counts(one, ["g"], "v", qs, stats)
    assert counts.count() < len(data["unique"]) * 3 * 8 / ordered.ACCURACY + 3 * 2
    assert counts.groupBy("_q").agg(F.sum("_n").alias("n")).where(F.col("n") != len(data["unique"])).count() == 0
    # rows meet the brackets by a broadcast and are counted before they travel
    plan = counts._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning")[1]
    assert "partial_count" in below and "SortMergeJoin" not in plan


def test_a_rank_outside_its_bracket_fails(groups, monkeypatch):
    df, _ = groups
    wrong = lambda *a, **k: ordered_stats(*a, **k).withColumn("_cuts", F.array(F.lit(0.9), F.lit(0.95)))
    ordered_stats = ordered.bracket_stats
    monkeypatch.setattr(ordered, "bracket_stats", wrong)
    with pytest.raises(Exception, match="outside its bracket"):
        ordered.exact_quantiles(df.where("g = 'unique'"), ["g"], "v", [0.1]).collect()


def test_describe_equals_pandas(groups):
    import pandas as pd

    df, data = groups
    got = aggregates.describe(df, ["g"], "v").toPandas().set_index("g")
    for g in ("unique", "hot", "ties101", "distinct8"):
        want = pd.Series(data[g]).describe()
        assert np.allclose(got.loc[g, ["n", "mean", "std", "min", "p25", "p50", "p75", "max"]].astype(float), want.to_numpy())
    assert got.loc["one", "std"] == 3.0 and "null" not in got.index
