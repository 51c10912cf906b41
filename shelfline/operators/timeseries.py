"""Many time series at once: regular calendars, forecasts, back-tests.

A series is a table of (item, date, y) with one row per period, so an item's
length is bounded by the calendar whatever the size of the raw table. Time runs
in whole periods of `STEP` days counted from a fixed Monday.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.aggregates import with_group_total
from shelfline.plans.ordered import exact_quantiles, keys_present, quantile_name, union_all

STEP = 7
ORIGIN = "1990-01-01"  # a Monday
YEAR = 52  # periods in one season
QUANTILES = (0.5, 0.6, 0.7, 0.8, 0.9)


def period_number(at: str | Column) -> Column:
    return F.floor(F.datediff(at, F.lit(ORIGIN).cast("date")) / STEP).cast("int")


def resample(
    df: DataFrame, keys: Sequence[str], at: str, unit: str, aggregates: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Regular frequency: out → (column, sum | avg | first | min | max) per key and period."""
    made = {
        "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max,
        "first": lambda c: F.min_by(c, F.struct(at, c)),
    }
    columns = [made[how](column).alias(out) for out, (column, how) in aggregates.items()]
    period = F.to_date(F.date_trunc(unit, at)).alias("period")
    return keys_present(df, keys).groupBy(*keys, period).agg(*columns)


def gap_fill(
    df: DataFrame, keys: Sequence[str], at: str, y: str, step_days: int = STEP, to_common_end: bool = True,
    fill: str | float = 0.0,
) -> DataFrame:
    """Every period from an item's first to its last (or to the common end); gaps are
    filled with a value, or with the item's own mean."""
    spans = df.groupBy(*keys).agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"), F.avg(y).alias("_mean"))
    end = df.agg(F.max(at)).scalar() if to_common_end else F.col("_hi")
    calendar = spans.withColumn("_end", end).select(
        *keys, "_mean", F.explode(F.sequence("_lo", "_end", F.expr(f"interval {step_days} days"))).alias(at)
    )
    filler = F.col("_mean") if fill == "mean" else F.lit(float(fill))
    return (
        calendar.join(df, [*keys, at], "left")
        .withColumn("is_filled", F.col(y).isNull())
        .withColumn(y, F.coalesce(F.col(y), filler))
        .drop("_mean")
    )


def future_rows(
    df: DataFrame, keys: Sequence[str], at: str, y: str, horizon: int, static: Sequence[str] = (), step_days: int = STEP
) -> DataFrame:
    """The next periods of every item: static columns carried on, no target."""
    last = df.groupBy(*keys).agg(F.max(at).alias("_last"), *[F.max_by(c, at).alias(c) for c in static])
    coming = F.transform(
        F.sequence(F.lit(1), F.lit(horizon)), lambda i: F.date_add("_last", (i * step_days).cast("int"))
    )
    return last.select(
        *keys, F.explode(coming).alias(at), F.lit(None).cast(df.schema[y].dataType).alias(y), *static
    )


def min_history(df: DataFrame, keys: Sequence[str], y: str, n: int) -> DataFrame:
    """Rows of series with at least n values."""
    long = df.groupBy(*keys).agg(F.count(y).alias("_n")).where(F.col("_n") >= n).select(*keys)
    return df.join(long, list(keys), "left_semi")


def join_holiday_table(df: DataFrame, holidays: DataFrame, at: str) -> DataFrame:
    """Holiday name and flag of each date from a calendar table (date, name); several names
    on a day become one."""
    one = holidays.groupBy(F.col("date").alias(at)).agg(F.min("name").alias("holiday"))
    return df.join(one, at, "left").withColumn("is_holiday", F.col("holiday").isNotNull())


def line(y: Column, x: Column) -> list[Column]:
    """Least-squares slope and intercept as aggregates; a level line where there is one period only."""
    return [
        F.coalesce(F.regr_slope(y, x), F.when(F.count(y) > 0, 0.0)).alias("slope"),
        F.coalesce(F.regr_intercept(y, x), F.avg(y)).alias("intercept"),
    ]


def fit_trend(df: DataFrame, keys: Sequence[str], at: str, y: str) -> DataFrame:
    """Least-squares line per item as one aggregate."""
    return df.groupBy(*keys).agg(*line(F.col(y), period_number(at)))


def trend_at(at: str | Column) -> Column:
    return F.col("intercept") + F.col("slope") * period_number(at)


def forecast_trend(df: DataFrame, keys: Sequence[str], at: str, y: str, horizon: int) -> DataFrame:
    coming = future_rows(df, keys, at, y, horizon).drop(y)
    return coming.join(fit_trend(df, keys, at, y), list(keys)).select(*keys, at, trend_at(at).alias("yhat"))


def shift_season(df: DataFrame, item: str, at: str, y: str, season_days: int = YEAR * STEP, out: str = "yhat") -> DataFrame:
    """The value one season ago, as the forecast of the shifted period."""
    return df.select(item, F.date_add(at, season_days).alias(at), F.col(y).alias(out))


def forecast_seasonal_naive(df: DataFrame, keys: Sequence[str], at: str, y: str, horizon: int) -> DataFrame:
    """Next periods: the value of the same season one cycle ago, and its mean over all cycles."""
    coming = future_rows(df, keys, at, y, horizon).drop(y)
    phased = df.select(*keys, F.col(at).alias("_then"), F.col(y).alias("_y"), (period_number(at) % YEAR).alias("_phase"))
    matched = coming.withColumn("_phase", period_number(at) % YEAR).join(phased, [*keys, "_phase"], "left")
    one_back = F.datediff(at, "_then") == YEAR * STEP
    return matched.groupBy(*keys, at).agg(
        F.max(F.when(one_back, F.col("_y"))).alias("yhat"), F.avg("_y").alias("seasonal_mean")
    )


SEASON = 52.18  # periods of a year in the wave terms
CHANGES = 25  # places where the trend may bend, evenly over the first BENDING of an item's history
BENDING = 0.8
CHANGE_SCALE = 0.05  # prior scale of a bend, in units of the item's largest value over its whole span
SIMULATIONS = 1000


def _design(period: np.ndarray, span: np.ndarray, order: int, changes: int, given: np.ndarray) -> np.ndarray:
    """Per row: 1, time as a share of the history, its excess over every change point, yearly waves, regressors."""
    places = BENDING * np.arange(1, changes + 1) / max(changes, 1)
    angle = period[:, None] * (2 * math.pi * np.arange(1, order + 1) / SEASON)
    bends = np.maximum(span[:, None] - places, 0.0)
    return np.concatenate([np.ones((len(period), 1)), span[:, None], bends, np.sin(angle), np.cos(angle), given], axis=1)


def _span(period: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return (period - lo) / np.maximum(hi - lo, 1)


def sparse_solve(gram: np.ndarray, right: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """The weights w with the least w'Gw/2 - r'w + sum(penalty * |w|), by a search over their signs; no penalty leaves a weight free.

    A weight joins when its gradient exceeds its penalty; the joined ones are solved for together, and where one would
    change its sign on the way, the best point of the way is taken. Every step lowers the target, so the search ends.
    """
    free = penalty == 0
    w, sign, active = np.zeros(len(right)), np.zeros(len(right)), free.copy()

    def target(x: np.ndarray) -> float:
        return float(x @ gram @ x / 2 - right @ x + penalty @ np.abs(x))

    for _ in range(20 * len(right)):
        while True:
            at = np.flatnonzero(active)
            new = np.zeros_like(w)
            if len(at):
                new[at] = np.linalg.solve(gram[np.ix_(at, at)], right[at] - penalty[at] * sign[at])
            turned = active & ~free & (np.sign(new) != sign)
            if not turned.any():
                w = new
                break
            step = new - w
            crossing = np.flatnonzero(active & ~free & (w * new < 0))
            points = [new, *(w - step * (w[i] / step[i]) for i in crossing)]
            for point, i in zip(points[1:], crossing):
                point[i] = 0.0
            best = min(points, key=target)
            if target(best) >= target(w) - 1e-15:
                break
            w = best
            active &= free | (w != 0)
            sign = np.where(free, 0.0, np.sign(w))
        left = gram @ w - right
        excess = np.where(active, 0.0, np.abs(left) - penalty)
        joins = int(excess.argmax())
        if excess[joins] <= 1e-12 + 1e-9 * abs(penalty[joins]):
            break
        active[joins], sign[joins] = True, -np.sign(left[joins])
    return w


def solve_additive(
    n: float, square: float, gram: np.ndarray, right: np.ndarray, changes: int, ridge: float, change_scale: float = CHANGE_SCALE
) -> tuple[np.ndarray, float]:
    """(weights, sigma) of scaled values: the penalty of a bend is sigma^2 / change_scale, sigma^2 the mean squared rest.

    Both are found in turns, beginning without bends, until sigma stands still.
    """
    width = len(right)
    held = gram + ridge * np.diag([0.0] + [1.0] * (width - 1))
    bends = np.zeros(width, bool)
    bends[2: 2 + changes] = True
    rest = lambda w: max((square - 2 * w @ right + w @ gram @ w) / max(n, 1), 1e-8)
    straight = np.flatnonzero(~bends)
    w = np.zeros(width)
    w[straight] = np.linalg.solve(held[np.ix_(straight, straight)], right[straight])
    variance = rest(w)
    for _ in range(50):
        w = sparse_solve(held, right, np.where(bends, variance / change_scale, 0.0))
        before, variance = variance, rest(w)
        if abs(variance - before) <= 1e-6 * before:
            break
    return w, math.sqrt(variance)


def fit_additive(
    df: DataFrame, item: str, at: str, y: str, order: int = 3, regressors: Sequence[str] = (), ridge: float = 1e-3, changes: int = CHANGES
) -> DataFrame:
    """Per item: n, first and last period `lo` and `hi`, the largest absolute value `scale`, and for values divided by it the
    weights of level, trend, bends, waves and regressors, the spread `sigma` and the mean size of a bend `bend`.

    Every task adds up the normal equations of the rows it reads, per item, so no item's rows need to meet; the few sums of
    an item meet and are solved. An item without a target has no row.
    """
    width = 2 + changes + 2 * order + len(regressors)
    upper = np.triu_indices(width)
    rows = df.where(F.col(y).isNotNull()).select(
        F.col(item).cast("string").alias("item"), period_number(at).cast("double").alias("p"), F.col(y).cast("double").alias("y"),
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in regressors]).cast("array<double>").alias("given"))
    spans = rows.groupBy(F.col("item").alias("_item")).agg(
        F.min("p").alias("lo"), F.max("p").alias("hi"), F.greatest(F.max(F.abs("y")), F.lit(1e-12)).alias("scale"))
    placed = rows.join(spans, F.col("item").eqNullSafe(F.col("_item"))).select("item", "lo", "hi", "scale", "p", "y", "given")
    sums = "item string, lo double, hi double, scale double, n double, yy double, xx array<double>, xy array<double>"

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def out():
            keys = list(held)
            columns = [pa.array([k[0] for k in keys], pa.string()), *[pa.array([k[j] for k in keys], pa.float64()) for j in (1, 2, 3)]]
            for j in range(4):
                columns.append(pa.array([held[k][j] for k in keys], pa.float64() if j < 2 else pa.list_(pa.float64())))
            return pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in sums.split(", ")])

        for batch in batches:
            numbers = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:6]]
            lo, hi, scale, period, value = numbers
            given = batch.column(6).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(regressors))
            x = _design(period, _span(period, lo, hi), order, changes, given)
            codes = batch.column(0).dictionary_encode(null_encoding="encode")
            index = codes.indices.to_numpy()
            by_item = np.argsort(index, kind="stable")
            borders = np.flatnonzero(np.diff(index[by_item], prepend=-1, append=-2))
            names = codes.dictionary.to_pylist()
            for a, b in zip(borders[:-1], borders[1:]):
                mine = by_item[a:b]
                first = mine[0]
                part, target = x[mine], value[mine] / scale[first]
                key = (names[index[first]], lo[first], hi[first], scale[first])
                new = (float(b - a), float(target @ target), (part.T @ part)[upper], part.T @ target)
                held[key] = tuple(p + q for p, q in zip(held[key], new)) if key in held else new
            if len(held) >= 1000:
                yield out()
                held.clear()
        if held:
            yield out()

    def solved(table: pa.Table) -> pa.Table:
        n, square = (float(np.sum(table.column(c).to_numpy())) for c in ("n", "yy"))
        gram, right = np.zeros((width, width)), np.zeros(width)
        parts = lambda c, k: table.column(c).combine_chunks().flatten().to_numpy().reshape(-1, k).sum(axis=0)
        gram[upper] = parts("xx", len(upper[0]))
        gram = gram + np.triu(gram, 1).T
        right = parts("xy", width)
        w, sigma = solve_additive(n, square, gram, right, changes, ridge)
        head = table.select(["item", "lo", "hi", "scale"]).slice(0, 1)
        bend = float(np.abs(w[2: 2 + changes]).mean()) if changes else 0.0
        for name, value in (("n", pa.array([int(n)])), ("weights", pa.array([w.tolist()])), ("sigma", pa.array([sigma])), ("bend", pa.array([bend]))):
            head = head.append_column(name, value)
        return head

    fitted = "item string, lo double, hi double, scale double, n long, weights array<double>, sigma double, bend double"
    return placed.mapInArrow(added, sums).groupBy("item").applyInArrow(solved, fitted)


def simulated_bounds(
    item: str | None, period: float, ahead: float, sigma: float, bend: float, changes: int, seed: int, level: float = 0.95
) -> tuple[float, float]:
    """Bounds of the rest around a forecast whose time lies `ahead` of the history (as a share of it).

    The trend goes on bending as often and as much as it did: a Poisson number of bends at even places, of Laplace size, plus noise.
    """
    name = np.frombuffer(hashlib.sha256(f"{seed}:{item}:{period:.0f}".encode()).digest(), np.uint32)
    draw = np.random.default_rng(name)
    rest = draw.normal(0.0, sigma, SIMULATIONS)
    if ahead > 0 and bend > 0:
        n = draw.poisson(changes / BENDING * ahead, SIMULATIONS)
        run = np.repeat(np.arange(SIMULATIONS), n)
        rest += np.bincount(run, draw.laplace(0.0, bend, len(run)) * draw.uniform(0.0, ahead, len(run)), SIMULATIONS)
    return tuple(np.quantile(rest, [(1 - level) / 2, (1 + level) / 2]).tolist())


def forecast_additive(
    df: DataFrame, item: str, at: str, y: str, order: int = 3, regressors: Sequence[str] = (), ridge: float = 1e-3, changes: int = CHANGES,
    seed: int = 1729,
) -> DataFrame:
    """A trend that bends, plus yearly waves and regressors per item, with a simulated 95 % interval.

    Rows with a target are fitted, rows without one are forecast; regressors (holiday flags, encoded
    columns) must be set on both. The order asked for is used whatever the length of the history; the
    ridge keeps short ones tame. An item without any target has a null forecast.
    """
    fit = fit_additive(df, item, at, y, order, regressors, ridge, changes)
    coming = df.where(F.col(y).isNull()).select(
        F.col(item).cast("string").alias("_item"), F.col(at), period_number(at).cast("double").alias("_p"),
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in regressors]).cast("array<double>").alias("_given"))

    @F.arrow_udf("yhat double, yhat_lower double, yhat_upper double")
    def predicted(
        names: pa.Array, period: pa.Array, given: pa.Array, lo: pa.Array, hi: pa.Array, scale: pa.Array, weights: pa.Array,
        sigma: pa.Array, bend: pa.Array,
    ) -> pa.Array:
        known = weights.is_valid().to_numpy(zero_copy_only=False)
        out = np.full((3, len(names)), np.nan)
        p, low, high, size, spread, bends = (c.to_numpy(zero_copy_only=False)[known] for c in (period, lo, hi, scale, sigma, bend))
        if known.any():
            span = _span(p, low, high)
            extra = given.flatten().to_numpy(zero_copy_only=False).reshape(len(names), len(regressors))[known]
            w = weights.filter(pa.array(known)).flatten().to_numpy().reshape(len(p), -1)
            mid = (_design(p, span, order, changes, extra) * w).sum(axis=1)
            items = [x for x, k in zip(names.to_pylist(), known) if k]
            around = np.array([simulated_bounds(*row, changes, seed) for row in zip(items, p, span - 1, spread, bends)])
            out[:, known] = np.stack([mid, mid + around[:, 0], mid + around[:, 1]]) * size
        return pa.StructArray.from_arrays([pa.array(x, from_pandas=True) for x in out], ["yhat", "yhat_lower", "yhat_upper"])

    joined = coming.join(fit, F.col("_item").eqNullSafe(F.col("item")), "left")
    made = predicted("_item", "_p", "_given", "lo", "hi", "scale", "weights", "sigma", "bend")
    return joined.withColumn("_f", made).select(F.col("_item").alias("item"), at, "_f.yhat", "_f.yhat_lower", "_f.yhat_upper")


def forecast_quantiles(
    df: DataFrame, keys: Sequence[str], at: str, y: str, horizon: int, qs: Sequence[float] = QUANTILES
) -> DataFrame:
    """Trend forecast plus the quantiles of the item's own residuals."""
    trend = fit_trend(df, keys, at, y)
    residuals = df.join(trend, list(keys)).select(*keys, (F.col(y) - trend_at(at)).alias("_rest"))
    spread = exact_quantiles(residuals, keys, "_rest", qs)
    points = forecast_trend(df, keys, at, y, horizon).join(spread, list(keys))
    names = [quantile_name(q) for q in qs]
    return points.select(*keys, at, *[(F.col("yhat") + F.col(n)).alias(n) for n in names])


def backtest(
    df: DataFrame, keys: Sequence[str], at: str, y: str, windows: int = 3, horizon: int = 4
) -> DataFrame:
    """Hold-out forecasts of the trend and the seasonal model for several cut-offs.

    The last `windows` stretches of `horizon` periods of each item are forecast, counted from the
    item's own last period, each from the periods before it. A row is repeated once per cut-off it serves.
    """
    placed = with_group_total(df.withColumn("_p", period_number(at)), keys, _last=F.max(period_number(at)))
    cutoffs = F.array(*[F.col("_last") - F.lit(horizon * w) for w in range(1, windows + 1)])
    rows = placed.withColumn("_cut", F.explode(cutoffs))
    trend = (
        rows.where(F.col("_p") <= F.col("_cut"))
        .groupBy(*keys, "_cut")
        .agg(*line(F.col(y), F.col("_p")))
    )
    held = rows.where((F.col("_p") > F.col("_cut")) & (F.col("_p") <= F.col("_cut") + horizon))
    ago = df.select(*keys, (period_number(at) + YEAR).alias("_p"), F.col(y).alias("_ago"))
    both = held.join(trend, [*keys, "_cut"], "left").join(ago, [*keys, "_p"], "left")
    models = F.array(
        F.struct(F.lit("trend").alias("model"), (F.col("intercept") + F.col("slope") * F.col("_p")).alias("yhat")),
        F.struct(F.lit("seasonal").alias("model"), F.col("_ago").cast("double").alias("yhat")),
    )
    cut_date = F.date_add(F.lit(ORIGIN).cast("date"), F.col("_cut") * STEP)
    return both.select(*keys, cut_date.alias("cutoff"), at, y, F.inline(models)).where(F.col("yhat").isNotNull())


def window_errors(held: DataFrame, keys: Sequence[str], y: str) -> DataFrame:
    """Absolute error relative to the actual volume, per item, cut-off and model."""
    return held.groupBy(*keys, "cutoff", "model").agg(
        (F.sum(F.abs(F.col(y) - F.col("yhat"))) / F.sum(F.abs(y))).alias("error")
    )


def model_errors(errors: DataFrame, keys: Sequence[str]) -> DataFrame:
    return errors.groupBy(*keys, "model").agg(F.avg("error").alias("error"))


def best_model(errors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Least mean error; the first name on a tie."""
    ranked = F.struct(F.round("error", 9).alias("e"), F.col("model").alias("m"))
    return model_errors(errors, keys).groupBy(*keys).agg(
        F.min(ranked)["m"].alias("best"), F.min("error").alias("error")
    )


def weighted_quantile_loss(
    df: DataFrame, y: str, forecasts: Mapping[float, str], keys: Sequence[str] = (), out: str = "wql"
) -> DataFrame:
    """Mean over the quantiles of Σ 2·[q·max(y−ŷ,0) + (1−q)·max(ŷ−y,0)] / Σ|y|."""
    losses = []
    for q, column in forecasts.items():
        under = F.greatest(F.col(y) - F.col(column), F.lit(0.0))
        over = F.greatest(F.col(column) - F.col(y), F.lit(0.0))
        losses.append(F.sum(2 * (q * under + (1 - q) * over)))
    total = losses[0]
    for loss in losses[1:]:
        total = total + loss
    return df.groupBy(*keys).agg((total / len(losses) / F.sum(F.abs(y))).alias(out))


FLOOR = 1e-6


def log_target(y: Column) -> Column:
    return F.log(F.greatest(y.cast("double"), F.lit(FLOOR)))


def unlog_target(y_log: Column) -> Column:
    return F.exp(y_log)


def ensemble_blend(
    candidates: Mapping[str, DataFrame], errors: DataFrame, keys: Sequence[str], at: str, floor: float = 1e-6
) -> DataFrame:
    """Weighted mean of the candidate forecasts, weights the inverse of each model's error.

    A model without a known error counts with the mean error of the item's other models; where none
    is known all weigh the same. No item is dropped.
    """
    named = union_all(
        [f.select(*keys, at, "yhat", F.lit(name).alias("model")) for name, f in candidates.items()]
    ).where(F.col("yhat").isNotNull())
    usual = errors.groupBy(*keys).agg(F.avg("error").alias("_usual"))
    known = F.coalesce("error", "_usual", F.lit(1.0))
    weighted = named.join(errors, [*keys, "model"], "left").join(usual, list(keys), "left").withColumn(
        "_w", 1 / F.greatest(known, F.lit(floor)))
    return weighted.groupBy(*keys, at).agg((F.sum(F.col("_w") * F.col("yhat")) / F.sum("_w")).alias("yhat"))
