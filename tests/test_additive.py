"""The additive forecast against a plain solve over the rows and an independent simulation of its bounds."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.catalog import runnable
from shelfline.operators import timeseries as T

MONDAY = dt.date(1990, 1, 1)


def series(seed, n, bend_at=0.5, gaps=True):
    """A trend that bends, a wave, a flag and noise: (period, y, flag)."""
    rng = np.random.default_rng(seed)
    p = np.arange(1500, 1500 + n)
    u = np.arange(n) / n
    y = 40 + 30 * u - 80 * np.maximum(u - bend_at, 0) + 8 * np.sin(2 * np.pi * p / T.SEASON) + rng.normal(0, 2, n)
    flag = (rng.random(n) < 0.1).astype(float)
    y += 6 * flag
    keep = rng.random(n) > (0.1 if gaps else -1)
    return p[keep], y[keep], flag[keep]


def design(p, lo, hi, flag, order, changes):
    rows = []
    for x, f in zip(p, flag):
        u = (x - lo) / max(hi - lo, 1)
        row = [1.0, u, *[max(u - 0.8 * j / changes, 0.0) for j in range(1, changes + 1)]]
        row += [math.sin(2 * math.pi * k * x / T.SEASON) for k in range(1, order + 1)]
        row += [math.cos(2 * math.pi * k * x / T.SEASON) for k in range(1, order + 1)]
        rows.append([*row, f])
    return np.array(rows)


def plain_fit(p, y, flag, order=3, changes=T.CHANGES, ridge=1e-3):
    """Coordinate descent over the rows themselves, in turns with the spread."""
    x, scale = design(p, p.min(), p.max(), flag, order, changes), np.abs(y).max()
    target = y / scale
    width = x.shape[1]
    bends = np.zeros(width, bool)
    bends[2: 2 + changes] = True
    held = x.T @ x + ridge * np.diag([0.0] + [1.0] * (width - 1))
    w = np.zeros(width)
    keep = ~bends
    w[keep] = np.linalg.solve(held[np.ix_(keep, keep)], x[:, keep].T @ target)
    variance = max(np.mean((target - x @ w) ** 2), 1e-8)
    for _ in range(50):
        penalty = np.where(bends, variance / T.CHANGE_SCALE, 0.0)
        right = x.T @ target
        for _ in range(40_000):
            most = 0.0
            for j in range(width):
                rest = right[j] - held[j] @ w + held[j, j] * w[j]
                new = math.copysign(max(abs(rest) - penalty[j], 0.0), rest) / held[j, j]
                most, w[j] = max(most, abs(new - w[j])), new
            if most < 1e-10:
                break
        before, variance = variance, max(np.mean((target - x @ w) ** 2), 1e-8)
        if abs(variance - before) <= 1e-6 * before:
            break
    return w, math.sqrt(variance), scale


def frame(spark, items, ahead=6):
    rows = []
    for name, (p, y, flag) in items.items():
        day = lambda k: MONDAY + dt.timedelta(weeks=int(k))
        rows += [(name, day(a), float(b), float(c)) for a, b, c in zip(p, y, flag)]
        rows += [(name, day(p[-1] + k), None, float(k % 2)) for k in range(1, ahead + 1)]
    return spark.createDataFrame(rows, "item string, week date, y double, flag double")


@pytest.mark.parametrize("cut", [1, 7])
def test_weights_and_forecasts_equal_a_plain_solve(spark, cut):
    items = {"a": series(1, 120), "b": series(2, 90, 0.3), None: series(3, 60, 0.6)}
    df = frame(spark, items).repartition(cut)
    fits = {r.item: r for r in T.fit_additive(df, "item", "week", "y", regressors=["flag"], changes=8).collect()}
    out = {(r.item, r.week): r for r in T.forecast_additive(df, "item", "week", "y", regressors=["flag"], changes=8).collect()}
    assert len(out) == 18
    for name, (p, y, flag) in items.items():
        w, sigma, scale = plain_fit(p, y, flag, changes=8)
        fit = fits[name]
        assert fit.n == len(p) and math.isclose(fit.scale, scale) and math.isclose(fit.sigma, sigma, rel_tol=1e-4)
        assert np.allclose(fit.weights, w, atol=2e-4) and math.isclose(fit.bend, np.abs(w[2:10]).mean(), abs_tol=1e-4)
        coming = np.arange(p[-1] + 1, p[-1] + 7)
        yhat = design(coming, p.min(), p.max(), [k % 2 for k in range(1, 7)], 3, 8) @ w * scale
        for k, x in enumerate(coming):
            r = out[name, MONDAY + dt.timedelta(weeks=int(x))]
            assert math.isclose(r.yhat, yhat[k], rel_tol=1e-3) and r.yhat_lower < r.yhat < r.yhat_upper


def test_the_sign_search_meets_the_conditions_of_the_optimum():
    rng = np.random.default_rng(7)
    for _ in range(200):
        n, d = int(rng.integers(3, 40)), int(rng.integers(1, 12))
        x = rng.normal(0, 1, (n, d))
        x[:, -1] = x[:, 0] + rng.normal(0, 1e-3, n)  # nearly the same column twice
        gram, right = x.T @ x + 1e-3 * np.eye(d), x.T @ rng.normal(0, 1, n)
        penalty = np.where(rng.random(d) < 0.3, 0.0, rng.choice([0.01, 1.0, 5.0]))
        w = T.sparse_solve(gram, right, penalty)
        left = gram @ w - right
        assert (np.abs(left) <= penalty + 1e-6).all()
        assert np.allclose(left[w != 0], -(penalty * np.sign(w))[w != 0], atol=1e-6)


def test_a_bend_is_found_where_it_is(spark):
    items = {"bent": series(5, 200, 0.4, gaps=False)}
    df = frame(spark, items)
    fit = T.fit_additive(df, "item", "week", "y", regressors=["flag"]).first()
    bends = np.array(fit.weights[2: 2 + T.CHANGES])
    places = 0.8 * np.arange(1, T.CHANGES + 1) / T.CHANGES
    assert (np.abs(bends) < 1e-9).sum() > T.CHANGES / 2
    assert abs((places * np.abs(bends)).sum() / np.abs(bends).sum() - 0.4) < 0.08


def test_bounds_equal_an_independent_simulation():
    rng = np.random.default_rng(0)
    for ahead, sigma, bend in ((0.0, 0.1, 0.3), (0.05, 0.05, 0.4), (0.3, 0.02, 0.2), (0.3, 0.1, 0.0)):
        rest = []
        for _ in range(20_000):
            value = rng.normal(0, sigma)
            for _ in range(rng.poisson(25 / 0.8 * ahead)):
                value += rng.laplace(0, bend) * (ahead - rng.uniform(0, ahead)) if bend else 0.0
            rest.append(value)
        wanted = np.quantile(rest, [0.025, 0.975])
        got = np.mean([T.simulated_bounds("x", p, ahead, sigma, bend, 25, 1) for p in range(30)], axis=0)
        assert np.allclose(got, wanted, rtol=0.08)
    assert T.simulated_bounds("x", 3, 0.2, 0.1, 0.1, 25, 1) == T.simulated_bounds("x", 3, 0.2, 0.1, 0.1, 25, 1)


def test_the_query_returns_forecasts_and_bounds(spark, folder):
    out = runnable()["forecast_additive"](spark, folder)
    assert out.columns == ["item", "week", "yhat", "yhat_lower", "yhat_upper"]
    n, bad, items = out.agg(F.count("*"), F.count_if(F.expr("yhat is null or not (yhat_lower < yhat and yhat < yhat_upper)")), F.count_distinct("item")).first()
    assert n == 4 * items and bad == 0 and items > 1
