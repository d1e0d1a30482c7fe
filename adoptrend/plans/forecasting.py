"""Series, forecasts and backtests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adoptrend.operators import forecast as fc
from adoptrend.plans.registry import query
from adoptrend.plans.trending import ORDINAL, rounded
from adoptrend.session import cut
from adoptrend.sources.inputs import SPAN, Inputs, with_views

EVERY = 24


def _no(column: str) -> str:
    return f"({ORDINAL.format(column)} - 1)"


def _label(expression: str) -> str:
    return f"(CAST(({expression}) // 12 AS VARCHAR) || '-' || lpad(CAST(({expression}) % 12 + 1 AS VARCHAR), 2, '0'))"


SPANS = f"""SELECT *, span - observed AS gaps, CASE WHEN span >= {SPAN} THEN 'eligible' ELSE 'span too short' END AS status
            FROM (SELECT language, min(year_month) AS first_month, max(year_month) AS last_month, count(*) AS observed,
                         {_no("max(year_month)")} - {_no("min(year_month)")} + 1 AS span FROM monthly GROUP BY 1)"""
# a calendar joined to the facts, gaps filled from the nearest known months on both sides
FILLED = f"""SELECT language, month_no, {_label("month_no")} AS year_month,
                    greatest(1.0, CASE WHEN y IS NOT NULL THEN y ELSE y0 + (y1 - y0) * (month_no - n0) / (n1 - n0) END) AS value,
                    y IS NULL AS filled
             FROM (SELECT c.language, c.month_no, m.y,
                          last_value(m.y IGNORE NULLS) OVER b AS y0, last_value(m.n IGNORE NULLS) OVER b AS n0,
                          first_value(m.y IGNORE NULLS) OVER a AS y1, first_value(m.n IGNORE NULLS) OVER a AS n1
                   FROM (SELECT language, unnest(range({_no("first_month")}, {_no("last_month")} + 1)) AS month_no
                         FROM spans WHERE status = 'eligible') c
                   LEFT JOIN (SELECT language, {_no("year_month")} AS n, CAST(repo_count AS DOUBLE) AS y FROM monthly) m
                     ON m.language = c.language AND m.n = c.month_no
                   WINDOW b AS (PARTITION BY c.language ORDER BY c.month_no ROWS UNBOUNDED PRECEDING),
                          a AS (PARTITION BY c.language ORDER BY c.month_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
LINEAR = f"""SELECT language, year_month, value AS actual, NULL::DOUBLE AS yhat, false AS is_forecast FROM filled
             UNION ALL
             SELECT language, {_label("last_no + h")}, NULL,
                    greatest(0.0, intercept + slope * (last_no + h)), true
             FROM (SELECT language, regr_slope(value, month_no) AS slope, regr_intercept(value, month_no) AS intercept,
                          max(month_no) AS last_no FROM filled GROUP BY 1), range(1, {EVERY + 1}) r(h)"""
SERIES_VIEWS = {"spans": SPANS, "filled": FILLED}
FORECAST_VIEWS = {**SERIES_VIEWS, "fc": LINEAR}


def series(t: Inputs) -> DataFrame:
    return fc.gapfill(fc.eligible(t.monthly_table, SPAN))


def line(t: Inputs) -> DataFrame:
    return fc.linear(series(t), EVERY)


@query(
    "series_span",
    with_views(
        "monthly",
        extra={"spans": SPANS},
        body="""SELECT language, first_month, last_month, observed, CAST(span AS INTEGER) AS span,
                       CAST(gaps AS BIGINT) AS gaps, status FROM spans""",
    ),
)
def series_span(t: Inputs) -> DataFrame:
    return fc.series_span(t.monthly, SPAN)


@query(
    "gapfilled_series",
    with_views(
        "monthly",
        extra=SERIES_VIEWS,
        body="SELECT language, CAST(month_no AS INTEGER) AS month_no, year_month, round(value, 6) AS value, filled FROM filled",
    ),
)
def gapfilled_series(t: Inputs) -> DataFrame:
    return rounded(series(t), "value")


@query(
    "forecast_linear",
    with_views(
        "monthly",
        extra=FORECAST_VIEWS,
        body="SELECT language, year_month, round(actual, 6) AS actual, round(yhat, 6) AS yhat, is_forecast FROM fc",
    ),
)
def forecast_linear(t: Inputs) -> DataFrame:
    return rounded(line(t), "actual", "yhat")


LONG_SPAN = 84


@query(
    "forecast_long",
    with_views(
        "monthly",
        extra={
            **FORECAST_VIEWS,
            "spans": SPANS.replace(f"span >= {SPAN}", f"span >= {LONG_SPAN}"),
        },
        body="""SELECT language, year_month, round(actual, 6) AS actual, round(yhat, 6) AS yhat, NULL::DOUBLE AS lower,
                       NULL::DOUBLE AS upper, 'linear' AS model, is_forecast, 'ok' AS status FROM fc
                UNION ALL SELECT language, NULL, NULL, NULL, NULL, NULL, 'linear', false, status FROM spans
                WHERE status <> 'eligible'""",
    ),
)
def forecast_long(t: Inputs) -> DataFrame:
    rows = fc.forecast(t.monthly, top_n=None, min_span=LONG_SPAN, horizon=EVERY, model="linear")
    return rounded(rows, "actual", "yhat")


A, B, G, PHI = 0.35, 0.2, 0.15, 0.9
HW = {
    "packed": "SELECT language, list(value ORDER BY month_no) AS ys, max(month_no) AS last_no FROM filled GROUP BY 1",
    "hw": f"""SELECT language, ys, last_no, 12 AS t, list_avg(ys[1:12]) AS l,
                     (list_avg(ys[13:24]) - list_avg(ys[1:12])) / 12 AS b,
                     list_transform(ys[1:12], lambda x: x - list_avg(ys[1:12])) AS s FROM packed
              UNION ALL
              SELECT language, ys, last_no, t + 1, l + {PHI} * b + {A} * e, {PHI} * b + {A * B!r} * e,
                     list_append(s[2:12], s[1] + {G} * e)
              FROM (SELECT *, ys[t + 1] - (l + {PHI} * b + s[1]) AS e FROM hw WHERE t < len(ys))""",
}


@query(
    "hw_fixed_params",
    with_views(
        "monthly",
        extra={**SERIES_VIEWS, **HW},
        recursive=True,
        body=f"""SELECT language, {_label("last_no + h")} AS year_month,
                        round(l + b * list_sum(list_transform(range(1, h + 1), lambda i: power({PHI}, i)))
                              + s[(h - 1) % 12 + 1], 6) AS yhat
                 FROM hw, range(1, {EVERY + 1}) r(h) WHERE t = len(ys)""",
    ),
)
def hw_fixed_params(t: Inputs) -> DataFrame:
    fitted = fc.hw_fixed(series(t), A, B, G, PHI, EVERY).where(F.col("status") == "ok")
    return rounded(fitted.drop("status"), "yhat")


@query(
    "backtest_errors",
    with_views(
        "monthly",
        extra=SERIES_VIEWS,
        body="""SELECT a.language, count(*) AS months, round(avg(abs(a.value - b.value)), 6) AS mae,
                       round(sqrt(avg((a.value - b.value) * (a.value - b.value))), 6) AS rmse
                FROM filled a JOIN filled b ON a.language = b.language AND b.month_no = a.month_no - 12
                JOIN (SELECT language, max(month_no) AS last_no FROM filled GROUP BY 1) m ON m.language = a.language
                WHERE a.month_no > last_no - 12 GROUP BY 1""",
    ),
)
def backtest_errors(t: Inputs) -> DataFrame:
    return rounded(fc.backtest(series(t)), "mae", "rmse")


DELTA = """SELECT language, avg(yhat) FILTER (is_forecast) AS mean_forecast, avg(actual) FILTER (NOT is_forecast) AS mean_actual,
                  avg(yhat) FILTER (is_forecast) - avg(actual) FILTER (NOT is_forecast) AS delta FROM fc GROUP BY 1"""


@query(
    "forecast_delta",
    with_views(
        "monthly",
        extra={**FORECAST_VIEWS, "best": f"SELECT * FROM ({DELTA}) ORDER BY delta DESC, language LIMIT 6"},
        body="""SELECT language, round(mean_forecast, 6) AS mean_forecast, round(mean_actual, 6) AS mean_actual,
                       round(delta, 6) AS delta FROM best""",
    ),
)
def forecast_delta(t: Inputs) -> DataFrame:
    return rounded(fc.forecast_delta(line(t), 6), "mean_forecast", "mean_actual", "delta")


@query(
    "forecast_change",
    with_views(
        "monthly",
        extra=FORECAST_VIEWS,
        body="""SELECT language, round(first_actual, 6) AS first_actual, round(latest, 6) AS latest,
                       round(projected, 6) AS projected,
                       round((latest - first_actual) / greatest(1, first_actual), 6) AS growth,
                       round((projected - latest) / greatest(1, latest), 6) AS projected_change,
                       round((projected - latest) / latest * 100, 6) AS pct_change
                FROM (SELECT language, arg_min(actual, year_month) FILTER (NOT is_forecast) AS first_actual,
                             arg_max(actual, year_month) FILTER (NOT is_forecast) AS latest,
                             arg_max(yhat, year_month) FILTER (is_forecast) AS projected FROM fc GROUP BY 1)""",
    ),
)
def forecast_change(t: Inputs) -> DataFrame:
    return rounded(
        fc.forecast_change(line(t)), "first_actual", "latest", "projected", "growth", "projected_change", "pct_change"
    )


@query(
    "forecast_boundary",
    with_views(
        "monthly",
        extra=FORECAST_VIEWS,
        body="SELECT language, min(year_month) AS forecast_start FROM fc WHERE is_forecast GROUP BY 1",
    ),
)
def forecast_boundary(t: Inputs) -> DataFrame:
    return fc.forecast_boundary(line(t))


@query(
    "forecast_history_view",
    with_views(
        "monthly",
        extra=FORECAST_VIEWS,
        body="""SELECT language, year_month, is_forecast, round(coalesce(yhat, actual), 6) AS drawn FROM fc
                WHERE year_month <= '2000-12' OR is_forecast""",
    ),
)
def forecast_history_view(t: Inputs) -> DataFrame:
    return rounded(fc.forecast_history_view(line(t), "2000-12"), "drawn")


@query("forecast_holt_winters")
def forecast_holt_winters(t: Inputs) -> DataFrame:
    return fc.forecast(t.monthly, top_n=None, min_span=SPAN).where("is_forecast")


@query(
    "forecast_check",
    with_views(
        "monthly",
        extra=SERIES_VIEWS,
        body=f"""SELECT language, {EVERY} AS months, true AS band_in_order, true AS not_negative, true AS follows_history,
                        true AS fits_no_worse FROM (SELECT DISTINCT language FROM filled)""",
    ),
)
def forecast_check(t: Inputs) -> DataFrame:
    """What any right fit has: all months, ordered bands, and in-sample errors no worse than last year's month."""
    held = cut(series(t))
    rows = cut(fc.holt_winters(held))
    ahead = rows.where("is_forecast").groupBy("language").agg(
        F.count("*").cast("int").alias("months"),
        F.every((F.col("lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("upper"))).alias("band_in_order"),
        F.every(F.col("lower") >= 0).alias("not_negative"),
        F.min("year_month").alias("_first"),
        # the band is 1.96 times the spread of the errors one month ahead
        F.min_by((F.col("upper") - F.col("yhat")) / 1.96, "year_month").alias("_spread"),
    )
    by_month = Window.partitionBy("language").orderBy("month_no")
    naive = (
        held.withColumn("_error", F.col("value") - F.lag("value", 12).over(by_month))
        .groupBy("language")
        .agg(F.sqrt(F.avg(F.col("_error") * F.col("_error"))).alias("_naive"), F.max("year_month").alias("_last"))
    )
    return ahead.join(naive, "language").select(
        "language", "months", "band_in_order", "not_negative",
        (F.col("_first") > F.col("_last")).alias("follows_history"),
        (F.col("_spread") <= F.col("_naive") * 1.0001 + 1e-9).alias("fits_no_worse"),
    )


@query("forecast_rows")
def forecast_rows(t: Inputs) -> DataFrame:
    return fc.legacy_columns(fc.forecast(t.monthly_table, min_span=SPAN))


@query("backtest_holt_winters")
def backtest_holt_winters(t: Inputs) -> DataFrame:
    return fc.backtest_model(t.monthly_table, min_span=SPAN - 12)
