"""Unit-root, cointegration and explosiveness statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions import rolling as R
from pairloom.functions.columns import ratio
from pairloom.functions.unit_root import adf_aic_rolling, engle_granger_aic_rolling, sadf_aic_rolling
from pairloom.operators.series import ORD, SeriesSpec, join_per_key, sliding, with_ordinal


def rolling_windows(df: DataFrame, spec: SeriesSpec, inputs: Sequence[str], window: int, out: str,
                    fn: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """``fn(values, ends)`` for all full windows of ``inputs`` that end in a chunk; chunks plus halo are the groups, never a series.

    Windows with a missing value have no statistic.
    """
    if ORD not in df.columns:
        df = with_ordinal(df, spec)
    size = spec.chunk_rows
    keys = list(spec.keys)
    chunked = df.select(*keys, spec.ts, ORD, *inputs).withColumn(
        "_chunk", F.explode(F.sequence(F.floor(F.col(ORD) / size), F.floor((F.col(ORD) + window - 1) / size))))

    def per_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ORD)
        values = pdf[list(inputs)].to_numpy(dtype=float)
        known = np.isfinite(values).all(1)
        seen = np.concatenate([[0], np.cumsum(known)])
        home = (pdf[ORD] // size == pdf["_chunk"]).to_numpy()
        last = np.arange(window - 1, len(pdf))
        last = last[home[last] & (seen[last + 1] - seen[last - window + 1] == window)]
        stat = np.full(len(pdf), np.nan)
        if len(last):
            stat[last] = fn(np.where(known[:, None], values, 0.0), last)
        return pdf.assign(**{out: stat})[[*keys, spec.ts, out]][home]

    schema = T.StructType([df.schema[c] for c in (*keys, spec.ts)] + [T.StructField(out, T.DoubleType())])
    result = chunked.groupBy(*keys, "_chunk").applyInPandas(per_chunk, schema)
    return result.withColumn(out, F.when(~F.isnan(out), F.col(out)))


def engle_granger(df: DataFrame, spec: SeriesSpec, y: str, x: str, window: int = 100, lags: str | int = 0,
                  out: str = "coint") -> DataFrame:
    """Rolling cointegration statistic; ``lags=0`` is native, ``"aic"`` picks lags per window."""
    if lags == 0:
        return sliding(df, spec, window + 1, lambda d, w: R.add(d, w, R.engle_granger(F.col(y), F.col(x), out, window)))
    return rolling_windows(df, spec, [y, x], window, out, lambda a, last: engle_granger_aic_rolling(a[:, 0], a[:, 1], last, window))


def unit_root(df: DataFrame, spec: SeriesSpec, y: str, window: int, constant: bool = True,
              lags: str | int = 0, out: str = "adf") -> DataFrame:
    """Rolling Dickey-Fuller statistic."""
    if lags == 0:
        return sliding(df, spec, window + 1, lambda d, w: R.add(d, w, R.unit_root(y, out, [window], constant)))
    return rolling_windows(df, spec, [y], window, out, lambda a, last: adf_aic_rolling(a[:, 0], last, window, constant))


def unit_root_full(df: DataFrame, spec: SeriesSpec, y: str, constant: bool = False) -> DataFrame:
    """Full-sample Dickey-Fuller statistic without lags: one mergeable aggregate per series."""
    steps = sliding(df, spec, 1, lambda d, w: d.withColumn("_y1", F.lag(y).over(w)).withColumn("_dy", F.col(y) - F.col("_y1")))
    steps = steps.where(F.col("_dy").isNotNull())
    n = F.col("n_obs")
    if constant:
        agg = steps.groupBy(*spec.keys).agg(
            F.count("_dy").alias("n_obs"), F.regr_sxx("_dy", "_y1").alias("_xx"),
            F.regr_sxy("_dy", "_y1").alias("_xy"), F.regr_syy("_dy", "_y1").alias("_yy"))
    else:
        agg = steps.groupBy(*spec.keys).agg(
            F.count("_dy").alias("n_obs"), F.sum(F.col("_y1") * F.col("_y1")).alias("_xx"),
            F.sum(F.col("_y1") * F.col("_dy")).alias("_xy"), F.sum(F.col("_dy") * F.col("_dy")).alias("_yy"))
    slope = ratio(F.col("_xy"), F.col("_xx"))
    rss = F.greatest(F.col("_yy") - slope * F.col("_xy"), F.lit(0.0))
    dof = n - (2 if constant else 1)
    return agg.select(*spec.keys, "n_obs", ratio(slope, F.sqrt(ratio(ratio(rss, dof), F.col("_xx")))).alias("adf"))


def engle_granger_full(df: DataFrame, spec: SeriesSpec, y: str, x: str) -> DataFrame:
    """Whole-sample cointegration statistic per series: ``y`` on ``x`` with a constant, then the residuals without one or lags."""
    keys = list(spec.keys)
    line = df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    rest = join_per_key(df, line, keys, spec.ts).withColumn("_u", F.col(y) - F.col("slope") * F.col(x) - F.col("intercept"))
    tested = unit_root_full(rest.select(*keys, spec.ts, "_u"), spec, "_u").withColumnRenamed("adf", "coint")
    return tested.join(line, keys)


def sadf(df: DataFrame, spec: SeriesSpec, y: str, min_window: int = 20, window: int = 50, lags: str | int = 0,
         out: str = "sadf") -> DataFrame:
    """Sup ADF: largest statistic over the suffixes of each window.

    Every suffix regression is a difference of two cumulative sums of its chunk. ``lags="aic"`` picks the lags of each.
    """
    if lags == 0:
        lengths = range(min_window, window + 1)
        return sliding(df, spec, window + 1, lambda d, w: R.add(d, w, R.unit_root(y, out, lengths)))

    return rolling_windows(df, spec, [y], window, out, lambda a, last: sadf_aic_rolling(a[:, 0], last, min_window, window))


def _inv(m: tuple[Column, ...]) -> tuple[Column, ...]:
    a, b, c, d = m
    det = a * d - b * c
    return ratio(d, det), ratio(-b, det), ratio(-c, det), ratio(a, det)


def _mul(m: tuple[Column, ...], n: tuple[Column, ...]) -> tuple[Column, ...]:
    return (m[0] * n[0] + m[1] * n[2], m[0] * n[1] + m[1] * n[3],
            m[2] * n[0] + m[3] * n[2], m[2] * n[1] + m[3] * n[3])


def johansen_trace(df: DataFrame, spec: SeriesSpec, x: str, y: str) -> DataFrame:
    """Johansen trace statistics of two series, constant removed, one lagged difference.

    One mergeable aggregate gives the covariances; the 2x2 eigenvalues are closed-form columns.
    """
    def lags(d: DataFrame, w) -> DataFrame:
        cols = {}
        for v, c in (("x", F.col(x)), ("y", F.col(y))):
            cols[f"d{v}"] = c - F.lag(c).over(w)
            cols[f"z{v}"] = F.lag(c).over(w) - F.lag(c, 2).over(w)
            cols[f"l{v}"] = F.lag(c).over(w)
        return d.withColumns(cols)

    names = ["dx", "dy", "zx", "zy", "lx", "ly"]
    rows = sliding(df, spec, 2, lags).dropna(subset=names)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    agg = rows.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n_obs"), *[F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in pairs])

    def block(p: str, q: str) -> tuple[Column, ...]:
        def c(a: str, b: str) -> Column:
            return F.col(f"c_{a}_{b}") if names.index(a) <= names.index(b) else F.col(f"c_{b}_{a}")
        return c(p + "x", q + "x"), c(p + "x", q + "y"), c(p + "y", q + "x"), c(p + "y", q + "y")

    def partial(p: str, q: str) -> list[Column]:
        """Covariances of p and q after removing the lagged differences."""
        proj = _mul(_mul(block(p, "z"), _inv(block("z", "z"))), block("z", q))
        return [(u - v).alias(f"s_{p}{q}{i}") for i, (u, v) in enumerate(zip(block(p, q), proj))]

    part = agg.select(*spec.keys, "n_obs", *partial("d", "d"), *partial("d", "l"), *partial("l", "d"), *partial("l", "l"))

    def s(pq: str) -> tuple[Column, ...]:
        return tuple(F.col(f"s_{pq}{i}") for i in range(4))

    m = part.select(*spec.keys, "n_obs", *[
        c.alias(f"m{i}") for i, c in enumerate(_mul(_mul(_inv(s("ll")), s("ld")), _mul(_inv(s("dd")), s("dl"))))])
    tr, det = F.col("m0") + F.col("m3"), F.col("m0") * F.col("m3") - F.col("m1") * F.col("m2")
    root = F.sqrt(F.greatest(tr * tr - 4 * det, F.lit(0.0)))
    eig = m.select(*spec.keys, "n_obs", ((tr + root) / 2).alias("eig_1"), ((tr - root) / 2).alias("eig_2"))
    l1, l2 = F.log(1 - F.col("eig_1")), F.log(1 - F.col("eig_2"))
    return eig.select("*", (-F.col("n_obs") * (l1 + l2)).alias("trace_r0"), (-F.col("n_obs") * l2).alias("trace_r1"))
