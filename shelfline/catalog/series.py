"""Time series."""

from pyspark.sql import functions as F

from shelfline.catalog.registry import query
from shelfline.functions.dates import month_start, week_start
from shelfline.operators import timeseries as T
from shelfline.plans.ordered import cut_lineage
from shelfline.views import FINE_ITEM, SERIES, SERIES_DAY, daily_series, series_sql, weekly_series

KEYS = ["item"]
P = "CAST(date_diff('day', DATE '1990-01-01', {0}) // 7 AS INTEGER)"
DAY = "strftime({0}, '%Y-%m-%d')"
FINE = series_sql("fine", FINE_ITEM)
PART_ITEM = "CAST(p_partkey AS VARCHAR)"
TREND = f"""trend AS (SELECT item, regr_slope(y, {P.format('week')}) AS slope, regr_intercept(y, {P.format('week')}) AS intercept,
                   max(week) AS last FROM {{src}} GROUP BY 1)"""
COMING = """coming AS (SELECT item, CAST(last + INTERVAL 7 DAY * i AS DATE) AS week, slope, intercept
                   FROM trend, (SELECT unnest(range(1, 5)) AS i))"""


def settled_series(t, item="p_type"):
    """The weekly series as a written table: the operators below read it several times,
    the line items are read once."""
    return cut_lineage(weekly_series(t, item))


def _dated(df, *columns):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


def _rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "week_start_from_parts",
    f"""SELECT o_orderkey,
          {DAY.format("CAST(date_trunc('week', make_date(year(o_orderdate), 1, 1) + INTERVAL 6 DAY) AS DATE) + INTERVAL 7 DAY * (month(o_orderdate) - 1)")} AS week_day,
          {DAY.format("make_date(year(o_orderdate), month(o_orderdate), 1)")} AS month_day
        FROM orders""",
)
def _(t):
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return _dated(
        t.orders.select("o_orderkey", week_start(y, m).alias("week_day"), month_start(y, m).alias("month_day")),
        "week_day", "month_day",
    )


@query(
    "bucket_resample",
    f"""SELECT event_type, user_id, {DAY.format("CAST(date_trunc('week', ts) AS DATE)")} AS period, round(sum(value), 2) AS total,
               round(avg(value), 6) AS mean, arg_min(value, ts) AS first, min(value) AS lowest, max(value) AS highest
        FROM events GROUP BY 1, 2, 3""",
)
def _(t):
    wanted = {
        "total": ("value", "sum"), "mean": ("value", "avg"), "first": ("value", "first"),
        "lowest": ("value", "min"), "highest": ("value", "max"),
    }
    weekly = T.resample(t.events, ["event_type", "user_id"], "ts", "week", wanted)
    return _rounded(_rounded(_dated(weekly, "period"), "total", digits=2), "mean", digits=6)


@query(
    "gap_fill",
    f"""WITH {FINE}, span AS (SELECT item, min(week) AS lo FROM fine GROUP BY 1),
             cal AS (SELECT item, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), (SELECT CAST(max(week) AS TIMESTAMP) FROM fine),
                     INTERVAL 7 DAY)) AS DATE) AS week FROM span)
        SELECT item, {DAY.format('week')} AS week, coalesce(y, 0) AS y, y IS NULL AS is_filled FROM cal LEFT JOIN fine USING (item, week)""",
)
def _(t):
    return _dated(T.gap_fill(settled_series(t, FINE_ITEM), KEYS, "week", "y"), "week")


@query(
    "gap_fill_mean",
    f"""WITH {FINE}, span AS (SELECT item, min(week) AS lo, max(week) AS hi, avg(y) AS m FROM fine GROUP BY 1),
             cal AS (SELECT item, m, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week
                     FROM span)
        SELECT item, {DAY.format('week')} AS week, round(coalesce(y, m), 6) AS y, y IS NULL AS is_filled
        FROM cal LEFT JOIN fine USING (item, week)""",
)
def _(t):
    filled = T.gap_fill(settled_series(t, FINE_ITEM), KEYS, "week", "y", to_common_end=False, fill="mean")
    return _rounded(_dated(filled, "week"), "y", digits=6)


@query(
    "future_rows",
    """WITH s AS (SELECT concat(p_brand, '/', p_type) AS item, CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
                         sum(l_quantity) AS y, min(p_type) AS category FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
            l AS (SELECT item, max(week) AS last, min(category) AS category FROM s GROUP BY 1)
       SELECT item, strftime(week, '%Y-%m-%d') AS week, y, category FROM s
       UNION ALL SELECT item, strftime(last + INTERVAL 7 DAY * i, '%Y-%m-%d'), NULL, category
                 FROM l, (SELECT unnest(range(1, 5)) AS i)""",
)
def _(t):
    series = settled_series(t, FINE_ITEM).withColumn("category", F.element_at(F.split("item", "/"), -1))
    coming = T.future_rows(series, KEYS, "week", "y", 4, static=["category"])
    return _dated(series.unionByName(coming), "week")


@query(
    "min_history_filter",
    f"""WITH {series_sql('p', PART_ITEM)} SELECT item, {DAY.format('week')} AS week, y FROM p
        WHERE item IN (SELECT item FROM p GROUP BY 1 HAVING count(y) >= 30)""",
)
def _(t):
    series = settled_series(t, "CAST(p_partkey AS STRING)")
    return _dated(T.min_history(series, KEYS, "y", 30), "week")


# The holiday calendar of the tests: days on which many lines of a kind were shipped; several names may share a day.
HOLIDAYS = """holidays AS (SELECT CAST(l_shipdate AS DATE) AS date, 'busy ' || l_returnflag AS name FROM lineitem
                           GROUP BY 1, 2 HAVING count(*) >= 12)"""


def busy_days(t):
    return (
        t.lineitem.groupBy(F.to_date("l_shipdate").alias("date"), F.concat(F.lit("busy "), "l_returnflag").alias("name"))
        .agg(F.count(F.lit(1)).alias("n")).where("n >= 12").drop("n")
    )


@query(
    "holiday_join",
    f"""WITH {HOLIDAYS}, one AS (SELECT date AS day, min(name) AS holiday FROM holidays GROUP BY 1),
             d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
        SELECT {DAY.format('d.day')} AS day, n, holiday, holiday IS NOT NULL AS is_holiday FROM d LEFT JOIN one ON d.day = one.day""",
)
def _(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return _dated(T.join_holiday_table(daily, busy_days(t), "day"), "day")


@query(
    "forecast_trend",
    f"""WITH {SERIES}, {TREND.format(src='series')}, {COMING}
        SELECT item, {DAY.format('week')} AS week, round(intercept + slope * {P.format('week')}, 4) AS yhat FROM coming""",
)
def _(t):
    return _rounded(_dated(T.forecast_trend(settled_series(t), KEYS, "week", "y", 4), "week"), "yhat")


SEASONAL = f"""seasonal AS (
  SELECT c.item, c.week, max(CASE WHEN date_diff('day', s.week, c.week) = 364 THEN y END) AS yhat, avg(y) AS seasonal_mean
  FROM coming c LEFT JOIN series s ON c.item = s.item AND {P.format('c.week')} % 52 = {P.format('s.week')} % 52 GROUP BY 1, 2)"""


@query(
    "forecast_seasonal_naive",
    f"""WITH {SERIES}, {TREND.format(src='series')}, {COMING}, {SEASONAL}
        SELECT item, {DAY.format('week')} AS week, yhat, round(seasonal_mean, 4) AS seasonal_mean FROM seasonal""",
)
def _(t):
    out = T.forecast_seasonal_naive(settled_series(t), KEYS, "week", "y", 4)
    return _rounded(_dated(out, "week"), "seasonal_mean")


# Not SQL: tests/test_additive.py holds forecasts and bounds against a plain solve over the rows.
@query("forecast_additive")
def _(t):
    # trend, waves, a holiday flag and an encoded column; every item runs to the common end
    filled = cut_lineage(T.gap_fill(settled_series(t, FINE_ITEM), KEYS, "week", "y").drop("is_filled"))
    rows = filled.unionByName(T.future_rows(filled, KEYS, "week", "y", 4))
    weeks = busy_days(t).select(F.to_date(F.date_trunc("week", "date")).alias("date"), "name")
    flagged = T.join_holiday_table(rows, weeks, "week").withColumn("is_holiday", F.col("is_holiday").cast("double"))
    flagged = cut_lineage(flagged.withColumn("size", F.char_length("item").cast("double")))
    return _dated(T.forecast_additive(flagged, "item", "week", "y", regressors=["is_holiday", "size"]), "week")


def _quantile_sql(src):
    picks = ", ".join(f"quantile_cont(y - (intercept + slope * {P.format('week')}), {q}) AS p{round(q * 100)}" for q in T.QUANTILES)
    return f"""rest AS (SELECT item, {picks} FROM {src} JOIN trend USING (item) GROUP BY 1),
      fq AS (SELECT item, week, {', '.join(f'intercept + slope * {P.format("week")} + p{round(q * 100)} AS p{round(q * 100)}' for q in T.QUANTILES)}
             FROM coming JOIN rest USING (item))"""


NAMES = [f"p{round(q * 100)}" for q in T.QUANTILES]


@query(
    "forecast_quantiles",
    f"""WITH {SERIES}, {TREND.format(src='series')}, {COMING}, {_quantile_sql('series')}
        SELECT item, {DAY.format('week')} AS week, {', '.join(f'round({n}, 4) AS {n}' for n in NAMES)} FROM fq""",
)
def _(t):
    out = T.forecast_quantiles(settled_series(t), KEYS, "week", "y", 4)
    return _rounded(_dated(out, "week"), *NAMES)


def _line(on):
    """Slope and intercept of a group; level where it has one period."""
    return f"""coalesce(regr_slope(y, {on}), CASE WHEN count(y) > 0 THEN 0.0 END) AS slope, coalesce(regr_intercept(y, {on}), avg(y)) AS intercept"""


# Items end at different weeks, some have a few rows only.
ENDED = series_sql("series", FINE_ITEM)
BACKTEST = f"""placed AS (SELECT item, week, y, {P.format('week')} AS p FROM series),
cuts AS (SELECT item, max(p) - 4 * w AS cut FROM placed, (SELECT unnest(range(1, 4)) AS w) GROUP BY item, w),
fits AS (SELECT item, cut, {_line('p')} FROM placed JOIN cuts USING (item) WHERE p <= cut GROUP BY 1, 2),
held AS (SELECT a.item, a.cut, a.week, a.p, a.y, intercept + slope * a.p AS trend, ago.y AS seasonal
         FROM (SELECT * FROM placed JOIN cuts USING (item) WHERE p > cut AND p <= cut + 4) a
         LEFT JOIN fits f ON f.item = a.item AND f.cut = a.cut
         LEFT JOIN placed ago ON ago.item = a.item AND ago.p = a.p - 52),
longer AS (SELECT item, cut, y, 'trend' AS model, trend AS yhat FROM held WHERE trend IS NOT NULL
           UNION ALL SELECT item, cut, y, 'seasonal', seasonal FROM held WHERE seasonal IS NOT NULL),
errors AS (SELECT item, cut, model, sum(abs(y - yhat)) / sum(abs(y)) AS error FROM longer GROUP BY 1, 2, 3),
means AS (SELECT item, model, avg(error) AS error FROM errors GROUP BY 1, 2)"""


@query(
    "backtest_windows",
    f"""WITH {ENDED}, {BACKTEST}, best AS (SELECT item, arg_min(model, (round(error, 9), model)) AS best FROM means GROUP BY 1)
        SELECT item, strftime(DATE '1990-01-01' + INTERVAL 7 DAY * cut, '%Y-%m-%d') AS cutoff, model, round(error, 5) AS error, best
        FROM errors JOIN best USING (item)""",
)
def _(t):
    errors = T.window_errors(T.backtest(settled_series(t, FINE_ITEM), KEYS, "week", "y"), KEYS, "y")
    best = T.best_model(errors, KEYS).drop("error")
    return _rounded(_dated(errors.join(best, KEYS), "cutoff"), "error", digits=5)


WQL_TERMS = " + ".join(
    f"sum(2 * ({q} * greatest(y - p{round(q * 100)}, 0) + {1 - q} * greatest(p{round(q * 100)} - y, 0)))" for q in T.QUANTILES
)


@query(
    "weighted_quantile_loss",
    f"""WITH {SERIES}, train AS (SELECT * FROM series WHERE week <= (SELECT max(week) - INTERVAL 28 DAY FROM series)),
             {TREND.format(src='train')}, {COMING}, {_quantile_sql('train')}
        SELECT item, round(({WQL_TERMS}) / 5 / sum(abs(y)), 6) AS wql
        FROM fq JOIN series USING (item, week) GROUP BY 1""",
)
def _(t):
    series = settled_series(t)
    cut = F.date_sub(series.agg(F.max("week")).scalar(), 28)
    train = series.withColumn("_cut", cut).where(F.col("week") <= F.col("_cut")).drop("_cut")
    held = T.forecast_quantiles(train, KEYS, "week", "y", 4).join(series, ["item", "week"])
    loss = T.weighted_quantile_loss(held, "y", dict(zip(T.QUANTILES, NAMES)), KEYS)
    return _rounded(loss, "wql", digits=6)


@query(
    "log_target",
    f"""WITH {SERIES_DAY} SELECT item, {DAY.format('day')} AS day, round(ln(greatest(y - 300, 0.000001)), 6) AS y_log,
               round(exp(ln(greatest(y - 300, 0.000001))), 5) AS y_back FROM series_day""",
)
def _(t):
    logged = daily_series(t).withColumn("y_log", T.log_target(F.col("y") - 300))
    out = logged.select("item", "day", "y_log", T.unlog_target(F.col("y_log")).alias("y_back"))
    return _rounded(_rounded(_dated(out, "day"), "y_log", digits=6), "y_back", digits=5)


@query(
    "ensemble_blend",
    f"""WITH {ENDED}, {BACKTEST}, trend AS (SELECT item, {_line(P.format('week'))}, max(week) AS last FROM series GROUP BY 1),
             {COMING}, {SEASONAL}, usual AS (SELECT item, avg(error) AS usual FROM means GROUP BY 1),
             cand AS (SELECT item, week, 'trend' AS model, intercept + slope * {P.format('week')} AS yhat FROM coming
                      UNION ALL SELECT item, week, 'seasonal', yhat FROM seasonal WHERE yhat IS NOT NULL),
             w AS (SELECT item, week, yhat, 1 / greatest(coalesce(error, usual, 1.0), 0.000001) AS w
                   FROM cand LEFT JOIN means USING (item, model) LEFT JOIN usual USING (item))
        SELECT item, {DAY.format('week')} AS week, round(sum(w * yhat) / sum(w), 3) AS yhat FROM w GROUP BY 1, 2""",
    )
def _(t):
    series = settled_series(t, FINE_ITEM)
    errors = T.model_errors(T.window_errors(T.backtest(series, KEYS, "week", "y"), KEYS, "y"), KEYS)
    candidates = {
        "trend": T.forecast_trend(series, KEYS, "week", "y", 4),
        "seasonal": T.forecast_seasonal_naive(series, KEYS, "week", "y", 4),
    }
    return _rounded(_dated(T.ensemble_blend(candidates, cut_lineage(errors), KEYS, "week"), "week"), "yhat", digits=3)
