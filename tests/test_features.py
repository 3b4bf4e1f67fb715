import datetime as dt

import numpy as np
import pandas as pd
from helpers import SPEC, back, close, to_spark, walk

from pairloom.operators import features as f

SCAN = dict(rows=16, fan=4, levels=3)


def test_golden_spread(spark):
    days = [dt.date(2019, 12, 20 + i) for i in range(6)]
    pdf = pd.DataFrame({"k": "p", "date": days, "e": [32., 5, 1, 6, 4, 7], "b": [5., 4, 8, 43, 9, 2]})
    out = back(f.standardized_spread(spark.createDataFrame(pdf), SPEC, "b", "e", 5))
    last = out.iloc[-1]
    close([last.spread, last.mu, last["std"], last.standardized_spread], [-1.527778, -0.033278, 1.282847, -1.164986], 1e-5)
    assert out["mu"].isna().sum() == 5 and out.standardized_spread.isna().sum() == 5


def test_spread_leaves_window_nulls(spark):
    pdf = walk(n=151, keys=("p",))
    pdf["u"] = walk(n=151, keys=("p",), seed=4).v
    out = back(f.standardized_spread(to_spark(spark, pdf), SPEC, "v", "u", 55))
    assert out.standardized_spread.isna().sum() == 55


def test_ema_with_gaps(spark):
    pdf = walk(n=400, nulls=(*range(5), *range(100, 140), 250))
    out = back(f.ema(to_spark(spark, pdf), SPEC, {"e5": ("v", 5), "e20": ("v", 20)}, **SCAN))
    for n in (5, 20):
        close(out[f"e{n}"], pdf.groupby("k").v.transform(lambda x: x.ewm(span=n, min_periods=n, adjust=False).mean()))


def test_ema_after_a_gap_longer_than_its_reach(spark):
    pdf = walk(n=400, nulls=range(30, 200))
    out = back(f.ema(to_spark(spark, pdf), SPEC, {"e": ("v", 2)}, **SCAN))
    close(out.e, pdf.groupby("k").v.transform(lambda x: x.ewm(span=2, min_periods=2, adjust=False).mean()))


def test_ema_of_short_spans_over_long_series_and_gaps(spark):
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(size=3000), np.full(10_000, np.nan), rng.normal(size=2000)])
    pdf = pd.DataFrame({"k": "a", "date": pd.date_range("1980-01-01", periods=len(v)).date, "v": v})
    out = back(f.ema(to_spark(spark, pdf), SPEC.with_(chunk_rows=4096), {"e1": ("v", 1), "e2": ("v", 2), "e20": ("v", 20)}))
    for n in (1, 2, 20):
        close(out[f"e{n}"], pdf.v.ewm(span=n, min_periods=n, adjust=False).mean(), 1e-8)


def test_rsi(spark):
    pdf = walk()
    d = pdf.groupby("k").v.diff()
    w = lambda x: x.groupby(pdf.k).transform(lambda s: s.ewm(alpha=1 / 14, min_periods=14, adjust=False).mean())
    up, dn = w(d.where(d > 0, 0.0)), w((-d).where(d < 0, 0.0))
    out = back(f.rsi(to_spark(spark, pdf), SPEC, "v"))
    close(out.rsi, np.where(dn == 0, 100, 100 - 100 / (1 + up / dn)))


def test_rsi_without_losses_is_100(spark):
    pdf = walk(n=40)
    pdf["v"] = np.arange(len(pdf), dtype=float)
    assert (back(f.rsi(to_spark(spark, pdf), SPEC, "v")).rsi.dropna() == 100).all()


def test_atr(spark):
    pdf = walk()
    pdf["h"], pdf["l"] = pdf.v + 2, pdf.v - 3
    want = []
    for _, x in pdf.groupby("k"):
        prev = x.v.shift()
        tr = pd.concat([x.h - x.l, (x.h - prev).abs(), (x.l - prev).abs()], axis=1).max(axis=1).to_numpy()
        a = np.zeros(len(tr))
        a[13] = tr[:14].mean()
        for i in range(14, len(tr)):
            a[i] = (a[i - 1] * 13 + tr[i]) / 14
        want += list(a)
    close(back(f.atr(to_spark(spark, pdf), SPEC, "h", "l", "v")).atr, want)


def test_ewm_std_and_daily_volatility(spark):
    pdf = walk(nulls=(80, 81))
    close(back(f.ewm_std(to_spark(spark, pdf), SPEC, "v", "s", 30)).s,
          pdf.groupby("k").v.transform(lambda x: x.ewm(span=30).std()), 1e-6)
    dates = pd.to_datetime(pdf.date)
    step = dates.groupby(pdf.k).diff().dt.days
    ret = pdf.groupby("k").v.pct_change(fill_method=None).where(step == 1)
    close(back(f.daily_volatility(to_spark(spark, pdf), SPEC, "v")).volatility,
          ret.groupby(pdf.k).transform(lambda x: x.ewm(span=100).std()), 1e-6)


def test_directions_returns_and_vwap(spark):
    pdf = walk()
    pdf["v"] = pdf.v.round()
    d = pdf.groupby("k").v.diff().replace({0: np.nan}).groupby(pdf.k).ffill()
    close(back(f.nonzero_direction(to_spark(spark, pdf), SPEC, "v")).direction, np.sign(d))
    ret = pdf.groupby("k").v.pct_change()
    close(back(f.cumulative_return(to_spark(spark, pdf), SPEC, "v")).cumulative_return, (ret + 1).groupby(pdf.k).cumprod())
    pdf["high"], pdf["low"], pdf["close"], pdf["volume"] = pdf.v + 1, pdf.v - 1, pdf.v, 10.0 + pdf.index
    typical = (pdf.high + pdf.low + pdf.close) / 3
    out = back(f.vwap(to_spark(spark, pdf), SPEC))
    close(out.vwap, (typical * pdf.volume).groupby(pdf.k).cumsum() / pdf.volume.groupby(pdf.k).cumsum())
    dom = [pdf.k, pd.to_datetime(pdf.date).dt.day]
    out = back(f.vwap_day_of_month(to_spark(spark, pdf), SPEC, {"x": ""}).select("k", "date", "x"))
    close(out.x, (typical * pdf.volume).groupby(dom).cumsum() / typical.groupby(dom).cumsum())


def test_cumulative_return_survives_total_loss_and_sign_change(spark):
    days = [dt.date(2020, 1, 1 + i) for i in range(6)]
    pdf = pd.DataFrame({"k": "a", "date": days, "v": [1.0, 2.0, -1.0, 4.0, 0.0, 3.0]})
    out = back(f.cumulative_return(to_spark(spark, pdf), SPEC, "v")).cumulative_return
    close(out[:5], [np.nan, 2.0, -1.0, 4.0, 0.0])


def test_asof_fill(spark):
    pdf = walk(n=50)
    known = pdf.iloc[::9].rename(columns={"v": "t"})
    out = back(f.asof_fill(to_spark(spark, pdf), to_spark(spark, known), SPEC, "t"))
    close(out.t, pdf.merge(known, how="left", on=["k", "date"]).groupby("k").t.ffill())


def test_technical_features_do_not_depend_on_chunks(spark):
    legs = {}
    for i, c in enumerate(f"{v}_{s}" for s in ("eth", "btc") for v in ("open", "high", "low", "close", "volume")):
        legs[c] = walk(n=330, keys=("p",), seed=i, start=500).v
    pdf = pd.DataFrame({"k": "p", "date": walk(n=330, keys=("p",)).date, **legs})
    df = to_spark(spark, pdf)
    small = back(f.technical_features(df, SPEC.with_(chunk_rows=50)), "date")
    large = back(f.technical_features(df, SPEC.with_(chunk_rows=5000, bucket_days=10000)), "date")
    for c in small.columns.drop(["k", "date"]):
        close(small[c], large[c], 1e-6)
