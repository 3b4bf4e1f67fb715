"""Augmented Dickey-Fuller statistic with lag choice by AIC: for one window, and for all windows of a chunk at once."""

from __future__ import annotations

import numpy as np


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rss = float(np.sum((y - x @ beta) ** 2))
    return beta, rss, np.linalg.pinv(x.T @ x)


#: a regression that leaves less than this share of the squares of its target unexplained is a perfect fit
PERFECT = 1e-13


def most_lags(n: int, constant: bool) -> int:
    """The largest lag for n values: ceil(12 (n/100)^(1/4)), at most n//2 - 1 less the constant; negative if n is too small."""
    return min(n // 2 - int(constant) - 1, int(np.ceil(12.0 * (n / 100.0) ** 0.25)))


def adf_aic(y: np.ndarray, constant: bool) -> float:
    """t statistic of the level term; the lag count minimises AIC on a common sample.

    The chosen regression is fitted again on all rows it can use. No statistic if it fits perfectly.
    """
    top = most_lags(len(y), constant)
    if top < 0 or not np.all(np.isfinite(y)):
        return np.nan
    y = y - y.mean() if constant else y  # changes nothing but precision
    d = np.diff(y)

    def design(lags: int, first: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(first, len(d))
        cols = [y[rows]] + [d[rows - i] for i in range(1, lags + 1)] + ([np.ones(len(rows))] if constant else [])
        return np.column_stack(cols), d[rows]

    best, best_aic = 0, np.inf
    for lags in range(top + 1):
        x, target = design(lags, top)
        _, rss, _ = _fit(x, target)
        if rss <= PERFECT * float(target @ target):
            return np.nan
        m = len(target)
        aic = m * (np.log(2 * np.pi) + np.log(rss / m) + 1) + 2 * x.shape[1]
        if aic < best_aic:
            best, best_aic = lags, aic
    x, target = design(best, best)
    beta, rss, inv = _fit(x, target)
    se = np.sqrt(rss / (len(target) - x.shape[1]) * inv[0, 0])
    return float(beta[0] / se) if se > 0 else np.nan


def engle_granger_aic(y: np.ndarray, x: np.ndarray) -> float:
    """Residual statistic of y on x, both steps without constant."""
    sxx = float(x @ x)
    return adf_aic(y - x * (float(x @ y) / sxx), constant=False) if sxx > 0 else np.nan


#: windows that are factorised at a time
BLOCK = 1024


def _r_factors(windows: np.ndarray, columns: list, first: int) -> np.ndarray:
    """R of the QR factorisation of each window's regression from row ``first`` of its differences on.

    A column is a lag of the difference (0 the target, which comes last), "level" or "one". What the first k columns leave of the target is
    the sum of squares of its entries of R from row k on, so one factorisation holds the fits of all leading sets of columns.
    """
    d = np.diff(windows, axis=1)
    rows = d.shape[1] - first
    parts = {"level": lambda: windows[:, first:first + rows], "one": lambda: np.ones((len(windows), rows))}
    x = np.stack([parts[c]() if c in parts else d[:, first - c:first - c + rows] for c in columns], axis=2)
    return np.linalg.qr(x, mode="r")


def adf_windows(windows: np.ndarray, constant: bool) -> np.ndarray:
    """``adf_aic`` of each row of ``windows`` (windows, values), without a loop over windows.

    One factorisation with the columns in the order constant, level, lags 1, 2, .. gives the criterion of every number of
    lags; a second one, of all windows that choose the same number, has the level last and gives the statistic. Windows with
    dependent columns go one by one.
    """
    n, c = windows.shape[1], int(constant)
    top = most_lags(n, constant)
    out = np.full(len(windows), np.nan)
    rows = n - 1 - top
    if top < 0 or not len(windows):
        return out
    if rows < top + c + 2 or len(windows) > BLOCK:  # no row to spare for the target: nothing to factorise
        if rows < top + c + 2:
            return np.array([adf_aic(w, constant) for w in windows])
        return np.concatenate([adf_windows(windows[k:k + BLOCK], constant) for k in range(0, len(windows), BLOCK)])
    if constant:
        windows = windows - windows.mean(1, keepdims=True)  # changes nothing but precision

    def dependent(r: np.ndarray) -> np.ndarray:
        size = np.sqrt((r * r).sum(1))
        return (np.abs(np.einsum("wii->wi", r))[:, :-1] <= 1e-9 * size[:, :-1]).any(1)

    with np.errstate(divide="ignore", invalid="ignore"):
        r = _r_factors(windows, [*["one"][:c], "level", *range(1, top + 1), 0], top)
        squares = r[:, :, -1] ** 2
        left = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]  # by the number of columns taken out
        whole, left = left[:, 0], left[:, c + 1:c + 2 + top]
        single = dependent(r)
        bad = (left <= PERFECT * whole[:, None]).any(1)
        aic = rows * (np.log(2 * np.pi) + np.log(left / rows) + 1) + 2 * (np.arange(top + 1) + 1 + c)
        best = aic.argmin(1)
        for lags in np.unique(best[~bad & ~single]):
            which = np.flatnonzero((best == lags) & ~bad & ~single)
            r = _r_factors(windows[which], [*["one"][:c], *range(1, lags + 1), "level", 0], lags)
            rss, level = r[:, -1, -1] ** 2, r[:, -2, -2]
            t = r[:, -2, -1] * np.sign(level) / np.sqrt(rss / (n - 1 - lags - (lags + 1 + c)))
            out[which] = np.where(rss > 0, t, np.nan)
            single[which[dependent(r)]] = True
    for k in np.flatnonzero(single):
        out[k] = adf_aic(windows[k], constant)
    return out


def _ending_at(values: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(values, n)[last - n + 1]


def adf_aic_rolling(y: np.ndarray, last: np.ndarray, n: int, constant: bool) -> np.ndarray:
    """``adf_aic`` of the windows of ``n`` values that end at rows ``last``."""
    return adf_windows(_ending_at(y, last, n), constant)


def engle_granger_aic_rolling(y: np.ndarray, x: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """``engle_granger_aic`` of every window."""
    ys, xs = _ending_at(y, last, n), _ending_at(x, last, n)
    sxx = (xs * xs).sum(1)
    beta = (xs * ys).sum(1) / np.where(sxx > 0, sxx, 1.0)
    return np.where(sxx > 0, adf_windows(ys - beta[:, None] * xs, False), np.nan)


def sadf_aic_rolling(y: np.ndarray, last: np.ndarray, shortest: int, n: int) -> np.ndarray:
    """The largest ``adf_aic`` over the suffixes of ``shortest`` to ``n`` values of every window; none if one of them has none."""
    return np.max([adf_aic_rolling(y, last, k, True) for k in range(shortest, n + 1)], axis=0)
