from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from adoptrend.functions.smoothing import fit_and_forecast
from adoptrend.operators import forecast as fc
from adoptrend.operators import trends


def monthly(spark, series):
    data = [(lang, ym, float(v), v, v) for lang, points in series.items() for ym, v in points]
    return spark.createDataFrame(
        [(a, b, int(d), int(d), int(e)) for a, b, _, d, e in data],
        "language string, year_month string, total_bytes long, repo_count long, commit_count long",
    )


def months(start, n):
    y, m = start
    return [f"{y + (m - 1 + i) // 12}-{(m - 1 + i) % 12 + 1:02d}" for i in range(n)]


def test_gapfill(spark):
    df = monthly(
        spark,
        {
            "gap": [("2020-01", 10), ("2020-04", 40)],
            "wrap": [("2020-11", 5), ("2021-02", 8)],
            "clip": [("2020-01", 0), ("2020-02", 3)],
        },
    )
    got = {}
    for r in fc.gapfill(df).orderBy("language", "month_no").collect():
        got.setdefault(r.language, []).append((r.year_month, r.value, r.filled))
    assert [(v, f) for _, v, f in got["gap"]] == [(10, False), (20, True), (30, True), (40, False)]
    assert [(m, v) for m, v, _ in got["wrap"]] == [("2020-11", 5), ("2020-12", 6), ("2021-01", 7), ("2021-02", 8)]
    assert [v for _, v, _ in got["clip"]] == [1, 3]


def test_span(spark):
    df = monthly(spark, {"long": [("2018-01", 1), ("2020-12", 1)], "short": [("2018-01", 1), ("2020-11", 1)]})
    spans = {r.language: (r.span, r.status) for r in fc.series_span(df).collect()}
    assert spans == {"long": (36, "eligible"), "short": (35, "span too short")}
    assert {r.language for r in fc.eligible(df).collect()} == {"long"}


def test_constant_series_stays_constant(spark):
    df = monthly(spark, {"flat": [(m, 100) for m in months((2018, 1), 48)], "short": [(m, 5) for m in months((2018, 1), 35)]})
    out = fc.forecast(df)
    ahead = out.where("is_forecast").orderBy("year_month").collect()
    assert len(ahead) == 24 and {r.language for r in ahead} == {"flat"}
    assert [r.year_month for r in ahead] == months((2022, 1), 24)
    assert [r.yhat for r in ahead] == pytest.approx([100] * 24)
    told = out.where("language = 'short'").collect()
    assert [(r.year_month, r.actual, r.is_forecast, r.status) for r in told] == [(None, None, False, fc.TOO_SHORT)]
    assert fc.legacy_columns(out).where("language = 'short'").isEmpty()
    past = out.where("not is_forecast and language = 'flat'")
    assert past.count() == 48 and past.where("yhat is not null or actual is null").count() == 0
    assert out.where("actual = double('NaN') or yhat = double('NaN')").count() == 0


def test_smoothing_beats_seasonal_naive_and_follows_season():
    t = np.arange(84)
    rng = np.random.default_rng(0)
    y = 200 + 1.5 * t + 30 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 4, 84)
    mean, spread, sse = fit_and_forecast(y, 24)
    assert sse <= ((y[12:] - y[:-12]) ** 2).sum()
    future = np.arange(84, 108)
    truth = 200 + 1.5 * future + 30 * np.sin(2 * np.pi * future / 12)
    assert np.abs(mean - truth).mean() < 12
    assert (np.diff(spread) >= -1e-9).all() and spread[0] > 0


def test_noise_forecast_is_not_negative(spark):
    rng = np.random.default_rng(1)
    df = monthly(spark, {"down": [(m, max(0, 60 - i * 2 + int(rng.integers(0, 6)))) for i, m in enumerate(months((2019, 1), 40))]})
    ahead = fc.forecast(df).where("is_forecast")
    assert ahead.where("yhat < 0 or lower > yhat or upper < yhat").count() == 0 and ahead.count() == 24


def test_failed_fit_keeps_rows(spark, monkeypatch):
    frame = __import__("pandas").DataFrame(
        {"language": "x", "month_no": range(24000, 24040), "year_month": months((2000, 1), 40), "value": 1.0}
    )

    def broken(y, horizon):
        raise ValueError("no")

    monkeypatch.setattr(fc, "fit_and_forecast", broken)
    out = fc._fit_one(24)(frame)
    assert len(out) == 64 and out["yhat"].isna().all() and set(out["status"]) == {"failed: no"}


def test_backtest(spark):
    df = monthly(spark, {"x": [(m, 10 + i // 12) for i, m in enumerate(months((2018, 1), 48))]})
    row = fc.backtest(fc.gapfill(df)).first()
    assert (row.months, row.mae, row.rmse) == (12, 1.0, 1.0)
    model = fc.backtest_model(df, min_span=36).first()
    assert model.months == 12 and model.mae < 2


def test_forecast_views(spark):
    df = monthly(spark, {"up": [(m, 10 + i) for i, m in enumerate(months((2018, 1), 36))]})
    rows = fc.forecast(df, model="linear")
    card = fc.forecast_change(rows).first()
    assert (card.first_actual, card.latest) == (10, 45) and card.projected == pytest.approx(69)
    assert fc.forecast_boundary(rows).first().forecast_start == "2021-01"
    legacy = fc.legacy_columns(rows)
    assert legacy.columns[3:7] == ["prophet_yhat", "prophet_lower", "prophet_upper", "arima_yhat"]
    assert fc.forecast_delta(rows, 1).first().delta > 0


def test_growth(spark, rows):
    df = monthly(spark, {"x": [("2020-01", 2), ("2020-03", 3), ("2020-04", 0), ("2020-05", 4)]})
    growth = {r.year_month: r.growth for r in trends.mom_growth(df).collect()}
    assert growth == {"2020-01": None, "2020-03": 0.5, "2020-04": -1.0, "2020-05": None}
    share = trends.market_share(df.unionByName(df.withColumn("language", F.lit("y"))))
    assert {r.share for r in share.collect()} == {0.5, None}
    assert trends.trajectory_class(df).first().trajectory == "stable"
    assert trends.top_categories(df, 1).first().mean_value == 2.25


def test_coverage_and_pivot(spark):
    df = spark.createDataFrame(
        [("r1", "go", 1, "2020-01", 2), ("r2", "go", 1, "2020-01", 3), ("r1", "go", 1, "2020-02", 1), ("r3", "c", 1, "2020-01", 1)],
        "repo_name string, language string, bytes long, year_month string, commit_count long",
    )
    got = trends.monthly_metrics(df, 2).orderBy("year_month").collect()
    assert [(r.language, r.repo_count, r.commit_count) for r in got] == [("go", 2, 5), ("go", 1, 1)]
    wide = trends.highlight_pivot(trends.monthly_metrics(df, 1), ["go", "c"]).orderBy("year_month").collect()
    assert [tuple(r) for r in wide] == [("2020-01", 2, 1), ("2020-02", 1, 0)]
    assert trends.monthly_metrics(df, 1, approx=True).count() == 3
