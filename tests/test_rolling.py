import numpy as np
import pandas as pd
import pytest
from helpers import SPEC, back, close, to_spark, walk
from pyspark.sql import functions as F

from pairloom.functions import rolling as R
from pairloom.functions import unit_root
from pairloom.functions.unit_root import adf_aic, engle_granger_aic
from pairloom.operators import stats
from pairloom.operators.series import ORD, sliding


def roll(spark, pdf, back_rows, *stats_, chunk=64):
    df = to_spark(spark, pdf)
    return back(sliding(df, SPEC.with_(chunk_rows=chunk), back_rows, lambda d, w: R.add(d, w, *stats_)))


def windows(pdf, n, fn):
    """fn on every full window without gaps, per key."""
    out = []
    for _, x in pdf.groupby("k").v:
        v = x.to_numpy()
        for i in range(len(v)):
            part = v[max(0, i - n + 1):i + 1]
            out.append(fn(part) if len(part) == n and not np.isnan(part).any() else np.nan)
    return out


@pytest.mark.parametrize("chunk", [16, 64, 4096])
def test_moments_and_average(spark, chunk):
    pdf = walk(nulls=(40, 41))
    out = roll(spark, pdf, 21, R.moments("v", "mu", "sd", 12), R.moving_avg(F.col("v"), "avg", 10),
               R.moving_avg(F.col("v"), "avg_full", 10, partial=False), chunk=chunk)
    close(out.mu, windows(pdf, 12, np.mean))
    close(out.sd, windows(pdf, 12, lambda x: np.std(x, ddof=1)), 1e-8)
    close(out.avg, pdf.groupby("k").v.transform(lambda x: x.rolling(10, min_periods=1).mean()))
    close(out.avg_full, windows(pdf, 10, np.mean))


def test_constant_window_has_no_deviation(spark):
    pdf = walk(n=60)
    pdf.loc[pdf.index % 60 >= 30, "v"] = 0.1
    out = roll(spark, pdf, 11, R.moments("v", "mu", "sd", 10))
    assert (out.sd[(out.index % 60) >= 39] == 0).all()


def test_entropy(spark):
    pdf = walk(nulls=(50,))
    pdf["v"] = np.sign(np.round(pdf.v.groupby(pdf.k).diff()))
    def h(x):
        p = np.unique(x, return_counts=True)[1] / len(x)
        return -(p * np.log2(p)).sum()
    out = back(sliding(to_spark(spark, pdf), SPEC, 16, lambda d, w: R.add(d, w, R.entropy(F.col("v"), "e", 15)).withColumn(
        "any", R.entropy_any(F.col("v"), w, 15))))
    close(out.e, windows(pdf, 15, h))
    close(out["any"], windows(pdf, 15, h))


def test_roll_spread(spark):
    pdf = walk()
    pdf["v"] = pdf.groupby("k").v.diff()
    def est(x):
        return np.sqrt(max(0.0, -np.cov(x, np.r_[0, x[:-1]])[0, 1]))
    close(roll(spark, pdf, 22, R.roll_spread("v", "r")).r, pd.Series(windows(pdf, 20, est)).fillna(0.0), 1e-7)


def test_trend_beta(spark):
    pdf = walk()
    out = back(sliding(to_spark(spark, pdf), SPEC, 25, lambda d, w: R.add(d, w, R.trend_beta("v", ORD, "b"))))
    close(out.b, windows(pdf, 24, lambda x: np.polyfit(np.arange(24), x, 1)[0]), 1e-8)


def df_t(y, constant):
    x, d = y[:-1], np.diff(y)
    m = np.column_stack([x, np.ones(len(x))]) if constant else x[:, None]
    b, *_ = np.linalg.lstsq(m, d, rcond=None)
    s2 = ((d - m @ b) ** 2).sum() / (len(d) - m.shape[1])
    return b[0] / np.sqrt(s2 * np.linalg.inv(m.T @ m)[0, 0])


@pytest.mark.parametrize("constant", [True, False])
def test_unit_root(spark, constant):
    pdf = walk(nulls=(70,))
    out = back(stats.unit_root(to_spark(spark, pdf), SPEC, "v", 30, constant))
    close(out.adf, windows(pdf, 30, lambda x: df_t(x, constant)), 1e-6)


def test_sadf(spark):
    pdf = walk(n=120, keys=("a",))
    out = back(stats.sadf(to_spark(spark, pdf), SPEC, "v", 12, 25))
    close(out.sadf, windows(pdf, 25, lambda x: max(df_t(x[i:], True) for i in range(14))), 1e-6)


def pair(n=160):
    pdf = walk(n=n, keys=("a",))
    pdf["u"] = 0.5 * pdf.v + walk(n=n, keys=("a",), seed=5, start=3.0).v / 10
    return pdf


def test_engle_granger(spark):
    pdf = pair()
    out = back(stats.engle_granger(to_spark(spark, pdf), SPEC, "u", "v", 40))
    want = []
    for i in range(len(pdf)):
        y, x = pdf.u.to_numpy()[max(0, i - 39):i + 1], pdf.v.to_numpy()[max(0, i - 39):i + 1]
        want.append(df_t(y - x * (x @ y) / (x @ x), False) if len(y) == 40 else np.nan)
    close(out.coint, want, 1e-5)


def test_aic_variants_run_on_chunks(spark):
    pdf = pair()
    out = back(stats.engle_granger(to_spark(spark, pdf), SPEC, "u", "v", 40, lags="aic"))
    y, x = pdf.u.to_numpy(), pdf.v.to_numpy()
    close(out.coint, [engle_granger_aic(y[i - 39:i + 1], x[i - 39:i + 1]) if i >= 39 else np.nan for i in range(len(y))])


@pytest.mark.parametrize("kind", range(4))
def test_all_windows_at_once_equal_single_ones(kind):
    rng = np.random.default_rng(kind)
    y = [rng.normal(size=150).cumsum() + 1500, 1500 + 300 * rng.normal(size=150), np.where(np.arange(150) % 40 < 25, 7.0, rng.normal(size=150)),
         np.arange(150.0)][kind]
    last = np.arange(60, 150)
    for n, constant in ((4, True), (20, True), (50, True), (50, False)):
        close(unit_root.adf_aic_rolling(y, last, n, constant), [adf_aic(y[e - n + 1:e + 1], constant) for e in last], 1e-7)
    x = rng.normal(size=150).cumsum()
    close(unit_root.engle_granger_aic_rolling(y, x, last, 40), [engle_granger_aic(y[e - 39:e + 1], x[e - 39:e + 1]) for e in last], 1e-7)
    close(unit_root.sadf_aic_rolling(y, last, 20, 30), [np.max([adf_aic(y[e - k + 1:e + 1], True) for k in range(20, 31)]) for e in last], 1e-7)


def test_sadf_with_lags_on_chunks(spark):
    pdf = walk(n=130, nulls=(40, 41))
    out = back(stats.sadf(to_spark(spark, pdf), SPEC, "v", 20, 30, lags="aic"))
    for k, part in out.groupby("k"):
        v = pdf[pdf.k == k].v.to_numpy()
        close(part.sadf, [np.max([adf_aic(v[e - n + 1:e + 1], True) for n in range(20, 31)]) if e >= 29 else np.nan for e in range(len(v))], 1e-8)


def test_lag_choice_minimises_aic():
    rng = np.random.default_rng(3)
    e = rng.normal(size=203)
    y = np.zeros(203)
    for t in range(3, 203):
        y[t] = y[t - 1] + 0.6 * (y[t - 1] - y[t - 2]) + e[t]
    y = y[3:]
    # a strongly autocorrelated difference needs a lag, so the plain statistic must not be returned
    assert abs(adf_aic(y, True) - df_t(y, True)) > 1e-3
    assert np.isnan(adf_aic(np.array([1.0, np.nan, 2.0, 3.0]), True))


def test_johansen(spark):
    pdf = pair()
    out = stats.johansen_trace(to_spark(spark, pdf), SPEC, "u", "v").first()
    z = pdf[["u", "v"]].to_numpy()
    d = np.diff(z, axis=0)
    r0, lag, lev = (m - m.mean(0) for m in (d[1:], d[:-1], z[1:-1]))
    res = lambda m: m - lag @ np.linalg.lstsq(lag, m, rcond=None)[0]
    r0, rk = res(r0), res(lev)
    n = len(r0)
    skk, sk0, s00 = rk.T @ rk / n, rk.T @ r0 / n, r0.T @ r0 / n
    eig = np.sort(np.linalg.eigvals(np.linalg.inv(skk) @ sk0 @ np.linalg.inv(s00) @ sk0.T).real)[::-1]
    close([out.trace_r0, out.trace_r1], [-n * np.log(1 - eig).sum(), -n * np.log(1 - eig[1])], 1e-6)
