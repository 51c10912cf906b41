"""Properties over seeded random data, with one group holding most of the rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.functions.text import fingerprint
from shelfline.operators import aggregates, sampling, sets, timeseries, windows
from shelfline.operators.joins import sample_combinations
from shelfline.plans.ordered import exact_quantiles, positions, running_sum
from shelfline.views import FINE_ITEM, weekly_series


@pytest.fixture(scope="module")
def skewed(spark):
    """4,000 rows; one category holds two thirds of them and a third share one value."""
    rng = random.Random(5)
    data = []
    for i in range(4000):
        category = "hot" if rng.random() < 0.66 else f"c{rng.randint(0, 30)}"
        value = 1.0 if rng.random() < 0.33 else float(rng.randint(1, 500))
        data.append((i, category, value))
    return spark.createDataFrame(data, "id bigint, category string, value double").repartition(16, "id")


def test_running_sum_and_positions_equal_pandas(skewed):
    order = [F.desc("value"), F.asc("id")]
    got = running_sum(skewed, ["category"], order, "value", "cum", {"total": F.sum("value")}).toPandas()
    got = got.sort_values(["category", "value", "id"], ascending=[True, False, True])
    assert np.allclose(got["cum"], got.groupby("category")["value"].cumsum())
    assert np.allclose(got["total"], got.groupby("category")["value"].transform("sum"))

    placed = positions(skewed, order, "pos", ["category"]).toPandas().sort_values(["category", "pos"])
    assert (placed["pos"] == placed.groupby("category").cumcount()).all()
    ordered = placed.sort_values(["category", "value", "id"], ascending=[True, False, True])
    assert (ordered["pos"] == ordered.groupby("category").cumcount()).all()

    whole = positions(skewed, order, "pos").toPandas().sort_values(["value", "id"], ascending=[False, True])
    assert list(whole["pos"]) == list(range(4000))


def test_a_hot_group_is_spread_over_slices(spark, skewed):
    from shelfline.plans.ordered import SLICE, order_slices

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sliced = order_slices(skewed, ["category"], [F.asc("value"), F.asc("id")])
        largest = sliced.groupBy("category", SLICE).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert largest <= 1200  # the hot group has about 2,700 rows


def test_quantiles_equal_the_linear_definition(skewed):
    got = {r["category"]: r for r in exact_quantiles(skewed, ["category"], "value", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for category, part in skewed.toPandas().groupby("category"):
        for q, name in ((0.0, "p00"), (0.25, "p25"), (0.5, "p50"), (0.9, "p90"), (1.0, "p100")):
            assert np.isclose(got[category][name], part["value"].quantile(q))


def test_describe_equals_pandas(skewed):
    got = aggregates.describe(skewed, ["category"], "value").toPandas().set_index("category").sort_index()
    want = skewed.toPandas().groupby("category")["value"].describe()
    want["std"] = want["std"].fillna(want["min"])
    for ours, theirs in (("n", "count"), ("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p75", "75%"), ("max", "max")):
        assert np.allclose(got[ours].to_numpy(float), want[theirs].to_numpy(float))


def test_pareto_head_is_a_head_within_its_share(skewed):
    head = windows.pareto_head(skewed, ["category"], "value", ["id"])
    pdf = head.toPandas()
    assert (pdf["running_value"] / pdf["total_value"] <= 0.4).all()
    assert head.join(skewed, ["id", "category", "value"], "left_anti").count() == 0
    crossing = windows.pareto_head(skewed, ["category"], "value", ["id"], include_crossing=True)
    reached = crossing.groupBy("category").agg((F.sum("value") / F.max("total_value")).alias("s")).toPandas()
    assert (reached["s"] >= 0.4).all() and len(reached) == skewed.select("category").distinct().count()


def test_topn_never_exceeds_n(skewed):
    top = windows.top_per_group(skewed, ["category"], [F.desc("value"), F.asc("id")], 7)
    assert top.groupBy("category").count().agg(F.max("count")).first()[0] == 7


def test_samples_are_exact_reproducible_and_disjoint(skewed):
    one = {r.id for r in sampling.sample_rows(skewed, ["id"], 3, fraction=0.1).collect()}
    two = {r.id for r in sampling.sample_rows(skewed.repartition(3), ["id"], 3, fraction=0.1).collect()}
    other = {r.id for r in sampling.sample_rows(skewed, ["id"], 4, n=400).collect()}
    assert one == two and len(one) == 400 and len(other) == 400 and one != other
    split = sampling.train_test(skewed, ["id"], 1)
    counts = {r.part: (r["n"], r["d"]) for r in split.groupBy("part").agg(F.count("id").alias("n"), F.countDistinct("id").alias("d")).collect()}
    assert counts == {"train": (2800, 2800), "test": (1200, 1200)}


def test_sample_with_replacement_has_the_expected_size_and_repeats(skewed):
    drawn = sampling.sample_with_replacement(skewed, ["id"], 7, 0.8)
    n = drawn.count()
    assert 2950 < n < 3450  # expected 3,200, standard deviation 57
    assert drawn.select("id").distinct().count() < n


def test_bernoulli_rate(skewed):
    rate = skewed.select(sampling.chosen_with_probability(["id"], 3, 0.25).cast("int").alias("c")).agg(F.avg("c")).first()[0]
    assert 0.22 < rate < 0.28
    assert skewed.where(sampling.chosen_with_probability(["id"], 3, 0)).count() == 0


def test_sampled_pairs_are_distinct(spark):
    left, right = spark.range(300).withColumnRenamed("id", "l"), spark.range(7).withColumnRenamed("id", "r")
    pairs = sample_combinations([(left, [F.asc("l")]), (right, [F.asc("r")])], 300, 5)
    assert pairs.count() == 300 and pairs.distinct().count() == 300


def test_merge_is_idempotent(skewed):
    once = sets.merge_distinct(skewed, skewed.where("id < 100"))
    assert once.count() == 4000 and sets.merge_distinct(once, once).count() == 4000


def test_gap_filled_series_have_no_gaps_and_keep_their_sum(tables):
    series = weekly_series(tables, FINE_ITEM)
    filled = timeseries.gap_fill(series, ["item"], "week", "y")
    assert filled.agg(F.sum("y")).first()[0] == series.agg(F.sum("y")).first()[0]
    spans = filled.groupBy("item").agg(F.count("*").alias("n"), F.datediff(F.max("week"), F.min("week")).alias("d"))
    assert spans.where("n != d / 7 + 1").count() == 0


def test_quantile_forecasts_rise_with_q(tables):
    out = timeseries.forecast_quantiles(weekly_series(tables), ["item"], "week", "y", 4)
    assert out.where("p50 > p60 or p60 > p70 or p70 > p80 or p80 > p90").count() == 0 and out.count() == 24


def test_additive_forecast_finds_trend_season_and_regressor(spark):
    weeks = pd.date_range("2020-01-06", periods=212, freq="7D")
    t = np.array([(w - pd.Timestamp(timeseries.ORIGIN)).days // 7 for w in weeks], dtype=float)
    flag = (np.arange(212) % 13 == 0).astype(float)
    y = 50 + 0.3 * (t - t[0]) + 10 * np.sin(2 * np.pi * t / 52.18) + 5 * flag
    pdf = pd.DataFrame({"item": "a", "week": weeks.date, "y": y, "flag": flag})
    pdf.loc[208:, "y"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("y", F.when(F.isnan("y"), None).otherwise(F.col("y")))
    out = timeseries.forecast_additive(df, "item", "week", "y", regressors=["flag"]).toPandas().sort_values("week")
    assert len(out) == 4 and np.allclose(out["yhat"], y[208:], atol=0.3)
    assert (out["yhat_lower"] <= out["yhat"]).all() and (out["yhat"] <= out["yhat_upper"]).all()


def test_additive_forecast_of_short_series(spark):
    import datetime as dt

    d = [dt.date(2024, 1, 1) + dt.timedelta(weeks=i) for i in range(4)]
    df = spark.createDataFrame([("a", d[0], 5.0), ("a", d[1], 5.0), ("a", d[2], None), ("b", d[3], None)], "item string, week date, y double")
    got = {r["item"]: r for r in timeseries.forecast_additive(df, "item", "week", "y").collect()}
    assert abs(got["a"]["yhat"] - 5.0) < 0.1 and got["b"]["yhat"] is None or np.isnan(got["b"]["yhat"])


def test_fingerprints_are_equal_exactly_for_equal_rows(spark):
    rows = [(1, "a", None), (2, "a", None), (3, "a", ""), (4, None, "a"), (5, "a", "\\N")]
    df = spark.createDataFrame(rows, "id int, x string, y string").withColumn("f", fingerprint(["y", "x"]))
    found = {r.id: r.f for r in df.collect()}
    assert found[1] == found[2] and len(set(found.values())) == 4


def test_weighted_quantile_loss_of_a_known_case(spark):
    df = spark.createDataFrame([(10.0, 8.0, 12.0), (10.0, 12.0, 14.0)], "y double, p50 double, p90 double")
    got = timeseries.weighted_quantile_loss(df, "y", {0.5: "p50", 0.9: "p90"}).first()[0]
    p50, p90 = 2 * (0.5 * 2 + 0.5 * 2), 2 * (0.1 * 2 + 0.1 * 4)
    assert np.isclose(got, (p50 + p90) / 2 / 20)
