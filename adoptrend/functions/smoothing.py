"""Damped additive Holt-Winters for one short series, run inside a grouped task."""

from __future__ import annotations

import numpy as np

SEASON = 12
# smoothing of level, of trend (relative to level), of season (relative to 1 - level), and damping
LOWEST = np.array([0.01, 0.001, 0.001, 0.80])
HIGHEST = np.array([0.99, 0.99, 0.99, 0.995])
GRID = ([0.05, 0.2, 0.4, 0.6, 0.8, 0.95], [0.01, 0.1, 0.3, 0.6], [0.01, 0.2, 0.5], [0.8, 0.9, 0.98])
REFINEMENTS = 6


def _mesh(axes) -> np.ndarray:
    return np.stack([m.ravel() for m in np.meshgrid(*axes, indexing="ij")], axis=1)


def _errors(y: np.ndarray, params: np.ndarray):
    """One-step errors of every parameter row, each as an affine function of the start state.

    Columns: the constant, the start level, the start trend, eleven start seasons (the twelfth
    makes them sum to zero). Being affine, the best start state is a least-squares solution.
    """
    alpha, beta, gamma, phi = (params[:, i : i + 1] for i in range(4))
    beta, gamma = alpha * beta, (1 - alpha) * gamma
    rows, width = len(params), 2 + SEASON
    level, trend = np.zeros((rows, width)), np.zeros((rows, width))
    level[:, 1], trend[:, 2] = 1.0, 1.0
    seasons = np.zeros((SEASON, rows, width))
    for s in range(SEASON - 1):
        seasons[s, :, 3 + s] = 1.0
        seasons[SEASON - 1, :, 3 + s] = -1.0
    errors = np.empty((rows, len(y), width))
    for t, value in enumerate(y):
        onward = level + phi * trend
        error = -(onward + seasons[t % SEASON])
        error[:, 0] += value
        errors[:, t] = error
        level = onward + alpha * error
        trend = phi * trend + beta * error
        seasons[t % SEASON] += gamma * error
    return errors, level, trend, seasons


def _best_starts(errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    design, target = errors[:, :, 1:], -errors[:, :, :1]
    turned = design.transpose(0, 2, 1)
    gram = turned @ design
    gram += 1e-9 * np.eye(gram.shape[1]) * (1 + np.trace(gram, axis1=1, axis2=2))[:, None, None]
    starts = np.linalg.solve(gram, turned @ target)
    residuals = design @ starts - target
    return starts[:, :, 0], (residuals**2).sum(axis=(1, 2))


def fit_and_forecast(y: np.ndarray, horizon: int):
    """Forecast, its standard errors, and the in-sample sum of squared errors."""
    scale = max(float(np.abs(y).mean()), 1e-12)
    z = np.asarray(y, dtype=float) / scale
    candidates, step = _mesh(GRID), (HIGHEST - LOWEST) / 8
    best, best_sse = None, np.inf
    for _ in range(REFINEMENTS + 1):
        _, sse = _best_starts(_errors(z, candidates)[0])
        winner = int(np.argmin(sse))
        if sse[winner] < best_sse:
            best, best_sse = candidates[winner], sse[winner]
        around = [np.unique(np.clip([b - s, b, b + s], lo, hi)) for b, s, lo, hi in zip(best, step, LOWEST, HIGHEST)]
        candidates, step = _mesh(around), step / 2
    errors, level, trend, seasons = _errors(z, best[None, :])
    start, sse = _best_starts(errors)
    state = np.concatenate([[1.0], start[0]])
    residuals = errors[0] @ state
    level, trend, seasons = level[0] @ state, trend[0] @ state, seasons[:, 0, :] @ state
    alpha, beta, gamma, phi = best
    beta, gamma = alpha * beta, (1 - alpha) * gamma
    steps = np.arange(1, horizon + 1)
    damped = np.cumsum(phi**steps)
    # the mean residual is added back, so that the fit is unbiased in sample
    mean = level + damped * trend + seasons[(len(z) + steps - 1) % SEASON] + residuals.mean()
    reach = alpha + beta * damped + gamma * (steps % SEASON == 0)
    spread = np.sqrt(residuals.var() * (1 + np.concatenate([[0.0], np.cumsum(reach[:-1] ** 2)])))
    return mean * scale, spread * scale, float(sse[0]) * scale**2
