"""Monthly series per category: gaps, spans, forecasts and backtests.

A series is one category's months, a few hundred rows at most; every operator below works on
all series at once and one series never leaves its task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adoptrend.functions.calendar import month_ordinal, ordinal_label
from adoptrend.functions.fixed import HORIZON, MIN_SPAN, TOP_SERIES
from adoptrend.functions.smoothing import SEASON, fit_and_forecast
from adoptrend.operators.trends import top_categories

ROWS = (
    "language string, year_month string, actual double, yhat double, lower double, upper double, "
    "model string, is_forecast boolean, status string"
)

TOO_SHORT = "span too short"


def series_span(monthly: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """Calendar months from the first to the last observation, and whether a model may be fitted."""
    ends = monthly.groupBy("language").agg(
        F.min("year_month").alias("first_month"), F.max("year_month").alias("last_month"), F.count("*").alias("observed")
    )
    span = month_ordinal(F.col("last_month")) - month_ordinal(F.col("first_month")) + 1
    return (
        ends.withColumn("span", span)
        .withColumn("gaps", F.col("span") - F.col("observed"))
        .withColumn("status", F.when(F.col("span") >= min_span, "eligible").otherwise(TOO_SHORT))
    )


def gapfill(monthly: DataFrame, value: str = "repo_count", floor: float = 1.0) -> DataFrame:
    """Every month from first to last, gaps on a straight line, values at least ``floor``.

    Each observed month produces itself and the gap behind it, so no calendar is joined.
    """
    at = month_ordinal(F.col("year_month"))
    ahead = Window.partitionBy("language").orderBy("_at")
    known = (
        monthly.select("language", at.alias("_at"), F.col(value).cast("double").alias("_y"))
        .withColumn("_next_at", F.coalesce(F.lead("_at").over(ahead), F.col("_at") + 1))
        .withColumn("_next_y", F.coalesce(F.lead("_y").over(ahead), F.col("_y")))
    )
    every = known.withColumn("month_no", F.explode(F.sequence("_at", F.col("_next_at") - 1)))
    away = (F.col("month_no") - F.col("_at")) / (F.col("_next_at") - F.col("_at"))
    line = F.coalesce(F.col("_y"), F.lit(0.0)) + (F.col("_next_y") - F.col("_y")) * away
    return every.select(
        "language",
        "month_no",
        ordinal_label(F.col("month_no")).alias("year_month"),
        F.greatest(F.lit(floor), line).alias("value"),
        (F.col("month_no") != F.col("_at")).alias("filled"),
    )


def eligible(monthly: DataFrame, min_span: int = MIN_SPAN) -> DataFrame:
    """Rows of the categories whose span suffices; a window instead of a join back."""
    whole = Window.partitionBy("language")
    at = month_ordinal(F.col("year_month"))
    span = F.max(at).over(whole) - F.min(at).over(whole) + 1
    return monthly.withColumn("_span", span).where(F.col("_span") >= min_span).drop("_span")


def _history(series: DataFrame) -> DataFrame:
    null = F.lit(None).cast("double")
    return series.select(
        "language",
        "year_month",
        F.col("value").alias("actual"),
        null.alias("yhat"),
        F.lit(False).alias("is_forecast"),
    )


def _future(fitted: DataFrame, horizon: int) -> DataFrame:
    """(language, last_no, ...) repeated for the months after ``last_no``, with the step ``h``."""
    return fitted.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(
        "year_month", ordinal_label(F.col("last_no") + F.col("h"))
    )


def linear(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Straight-line forecast, with the history it continues: the baseline model."""
    fitted = series.groupBy("language").agg(
        F.regr_slope("value", "month_no").alias("_slope"),
        F.regr_intercept("value", "month_no").alias("_intercept"),
        F.max("month_no").alias("last_no"),
    )
    yhat = F.greatest(F.lit(0.0), F.col("_intercept") + F.col("_slope") * (F.col("last_no") + F.col("h")))
    ahead = _future(fitted, horizon).select(
        "language",
        "year_month",
        F.lit(None).cast("double").alias("actual"),
        yhat.alias("yhat"),
        F.lit(True).alias("is_forecast"),
    )
    return _history(series).unionByName(ahead)


def hw_fixed(
    series: DataFrame, alpha: float, beta: float, gamma: float, phi: float, horizon: int = HORIZON
) -> DataFrame:
    """Damped additive Holt-Winters at given parameters; the start state comes from two first years.

    ``(language, year_month, yhat, status)``. A series under two years has one row that says so.
    """
    values = F.transform("_sorted", lambda p: p["value"])
    every = (
        series.groupBy("language")
        .agg(F.sort_array(F.collect_list(F.struct("month_no", "value"))).alias("_sorted"), F.max("month_no").alias("last_no"))
        .select("language", "last_no", values.alias("_y"))
    )
    packed = every.where(F.size("_y") >= 2 * SEASON)
    short = every.where(F.size("_y") < 2 * SEASON).select(
        "language", F.lit(None).cast("string").alias("year_month"), F.lit(None).cast("double").alias("yhat"),
        F.lit(TOO_SHORT).alias("status"),
    )

    def mean(first: int):
        year = F.slice("_y", first, SEASON)
        return F.aggregate(year, F.lit(0.0), lambda a, x: a + x) / SEASON

    started = packed.withColumn("_l0", mean(1)).withColumn("_b0", (mean(SEASON + 1) - F.col("_l0")) / SEASON)
    start = F.struct(
        F.col("_l0").alias("l"),
        F.col("_b0").alias("b"),
        F.transform(F.slice("_y", 1, SEASON), lambda x: x - F.col("_l0")).alias("s"),
    )

    def step(state, y):
        error = y - (state["l"] + F.lit(phi) * state["b"] + F.element_at(state["s"], 1))
        return F.struct(
            (state["l"] + F.lit(phi) * state["b"] + F.lit(alpha) * error).alias("l"),
            (F.lit(phi) * state["b"] + F.lit(alpha * beta) * error).alias("b"),
            F.concat(
                F.slice(state["s"], 2, SEASON - 1), F.array(F.element_at(state["s"], 1) + F.lit(gamma) * error)
            ).alias("s"),
        )

    rest = F.slice(F.col("_y"), F.lit(SEASON + 1), F.size("_y") - SEASON)
    run = started.withColumn("_end", F.aggregate(rest, start, step))
    damped = F.aggregate(F.sequence(F.lit(1), F.col("h")), F.lit(0.0), lambda a, i: a + F.pow(F.lit(phi), i))
    season = F.element_at(F.col("_end.s"), (F.col("h") - 1) % SEASON + 1)
    ahead = _future(run, horizon).select(
        "language", "year_month", (F.col("_end.l") + damped * F.col("_end.b") + season).alias("yhat"), F.lit("ok").alias("status")
    )
    return ahead.unionByName(short)


def _fit_one(horizon: int):
    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("month_no")
        language, y, last = frame["language"].iloc[0], frame["value"].to_numpy(float), int(frame["month_no"].iloc[-1])
        past = pd.DataFrame({"language": language, "year_month": frame["year_month"], "actual": y, "is_forecast": False})
        ordinals = last + np.arange(1, horizon + 1)
        ahead = pd.DataFrame(
            {
                "language": language,
                "year_month": [f"{o // 12:04d}-{o % 12 + 1:02d}" for o in ordinals],
                "is_forecast": True,
            }
        )
        try:
            mean, spread, _ = fit_and_forecast(y, horizon)
            if not np.isfinite(mean).all():
                raise ValueError("no finite forecast")
            ahead["yhat"] = np.clip(mean, 0.0, None)
            ahead["lower"] = np.clip(mean - 1.96 * spread, 0.0, None)
            ahead["upper"] = np.clip(mean + 1.96 * spread, 0.0, None)
            status = "ok"
        except (ValueError, FloatingPointError, np.linalg.LinAlgError) as error:
            status = f"failed: {error}"
        rows = pd.concat([past, ahead], ignore_index=True).reindex(
            columns=["language", "year_month", "actual", "yhat", "lower", "upper", "is_forecast"]
        )
        for column in ("actual", "yhat", "lower", "upper"):
            # absent values are NULL, never NaN
            rows[column] = rows[column].astype("Float64")
        return rows.assign(model="holt-winters", status=status)[
            ["language", "year_month", "actual", "yhat", "lower", "upper", "model", "is_forecast", "status"]
        ]

    return fit


def holt_winters(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """History and forecast rows of every series; a failed fit keeps its rows.

    The rows are few and the fits are long: the series are dealt over as many tasks as any other
    exchange has, where run-time merging by size would leave all fits to one task.
    """
    columns = ["language", "month_no", "year_month", "value"]
    tasks = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = series.select(*columns).repartition(tasks, "language")
    return spread.groupBy("language").applyInPandas(_fit_one(horizon), ROWS)


def forecast(
    monthly: DataFrame,
    value: str = "repo_count",
    top_n: int | None = TOP_SERIES,
    min_span: int = MIN_SPAN,
    horizon: int = HORIZON,
    model: str = "hw",
) -> DataFrame:
    """History and forecast rows (``ROWS``) of the leading categories.

    A category with too short a span has one row, without month and values, whose status says so.
    """
    chosen = monthly
    if top_n is not None:
        chosen = monthly.join(top_categories(monthly, top_n, value).select("language"), "language", "left_semi")
    series = gapfill(eligible(chosen, min_span), value)
    if model == "hw":
        rows = holt_winters(series, horizon)
    elif model == "linear":
        rows = _as_rows(linear(series, horizon), "linear", "ok")
    else:
        raise ValueError(f"unknown model {model!r}")
    left_out = series_span(chosen, min_span).where(F.col("status") != "eligible").select("language", "status")
    silent = _as_rows(left_out.withColumn("is_forecast", F.lit(False)), {"hw": "holt-winters"}.get(model, model))
    return rows.unionByName(silent)


def _as_rows(df: DataFrame, model: str, status: str | None = None) -> DataFrame:
    """``df`` with the columns of ``ROWS``; those it lacks are NULL."""
    given = {"model": F.lit(model)} | ({"status": F.lit(status)} if status else {})
    columns = [c.strip().split(" ") for c in ROWS.split(",")]
    return df.select(
        *[
            given.get(name, F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns
        ]
    )


def legacy_columns(rows: DataFrame) -> DataFrame:
    """Forecast rows under the column names existing readers expect."""
    null = F.lit(None).cast("double")
    return rows.where(F.col("year_month").isNotNull()).select(
        "language",
        "year_month",
        "actual",
        null.alias("prophet_yhat"),
        null.alias("prophet_lower"),
        null.alias("prophet_upper"),
        F.col("yhat").alias("arima_yhat"),
        "is_forecast",
    )


def backtest(series: DataFrame, holdout: int = SEASON) -> DataFrame:
    """Errors of the seasonal-naive forecast (same month a year before) over the last ``holdout`` months."""
    by_month = Window.partitionBy("language").orderBy("month_no")
    error = F.col("value") - F.col("_year_ago")
    return (
        series.withColumn("_year_ago", F.lag("value", SEASON).over(by_month))
        .withColumn("_last", F.max("month_no").over(Window.partitionBy("language")))
        .where((F.col("month_no") > F.col("_last") - holdout) & F.col("_year_ago").isNotNull())
        .groupBy("language")
        .agg(
            F.count("*").alias("months"),
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
        )
    )


def backtest_model(monthly: DataFrame, value: str = "repo_count", holdout: int = SEASON, model: str = "hw", **options) -> DataFrame:
    """Errors of a model fitted without the last ``holdout`` months."""
    at, whole = month_ordinal(F.col("year_month")), Window.partitionBy("language")
    marked = monthly.withColumn("_held", at > F.max(at).over(whole) - holdout)
    fitted = forecast(marked.where(~F.col("_held")).drop("_held"), value, horizon=holdout, model=model, **options)
    truth = marked.where("_held").select("language", "year_month", F.col(value).cast("double").alias("truth"))
    error = F.col("truth") - F.col("yhat")
    return (
        fitted.where("is_forecast")
        .join(truth, ["language", "year_month"])
        .groupBy("language")
        .agg(F.count("*").alias("months"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"))
    )


def forecast_delta(rows: DataFrame, n: int | None = None) -> DataFrame:
    """Mean forecast less mean history per category, largest first."""
    delta = (
        rows.groupBy("language")
        .agg(
            F.avg(F.when(F.col("is_forecast"), F.col("yhat"))).alias("mean_forecast"),
            F.avg(F.when(~F.col("is_forecast"), F.col("actual"))).alias("mean_actual"),
        )
        .withColumn("delta", F.col("mean_forecast") - F.col("mean_actual"))
        .where(F.col("delta").isNotNull())
    )
    return delta if n is None else delta.orderBy(F.desc("delta"), "language").limit(n)


def forecast_change(rows: DataFrame) -> DataFrame:
    """Forecast card per category: first, latest and projected value, and the changes between them."""
    past, ahead = ~F.col("is_forecast") & F.col("actual").isNotNull(), F.col("is_forecast") & F.col("yhat").isNotNull()
    when = lambda condition: F.when(condition, F.col("year_month"))
    ends = (
        rows.groupBy("language")
        .agg(
            F.min_by("actual", when(past)).alias("first_actual"),
            F.max_by("actual", when(past)).alias("latest"),
            F.max_by("yhat", when(ahead)).alias("projected"),
        )
        .dropna()
    )
    change = F.col("projected") - F.col("latest")
    return (
        ends.withColumn("growth", (F.col("latest") - F.col("first_actual")) / F.greatest(F.lit(1.0), F.col("first_actual")))
        .withColumn("projected_change", change / F.greatest(F.lit(1.0), F.col("latest")))
        .withColumn("pct_change", F.try_divide(change, F.col("latest")) * 100)
    )


def forecast_boundary(rows: DataFrame) -> DataFrame:
    """First forecast month of each category."""
    return rows.where("is_forecast").groupBy("language").agg(F.min("year_month").alias("forecast_start"))


def forecast_history_view(rows: DataFrame, cutoff: str) -> DataFrame:
    """History up to ``cutoff`` and all forecasts, with the value a chart draws."""
    return rows.where((F.col("year_month") <= cutoff) | F.col("is_forecast")).select(
        "language", "year_month", "is_forecast", F.coalesce("yhat", "actual").alias("drawn")
    )
