"""Frame-level feature operators on long bar frames and on pair frames."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pairloom.functions import columns as C
from pairloom.functions import rolling as R
from pairloom.operators.series import NOTHING, ORD, SeriesSpec, affine_scan, running, sliding, with_ordinal

# daily series have some thousand rows; small chunks spread even a few of them over many tasks
BARS = SeriesSpec(("symbol",), "date", chunk_rows=1024)
PAIR = SeriesSpec(("pair",), "date", chunk_rows=1024)


def wide_by_symbol(bars: DataFrame, legs: Mapping[str, str], values: Sequence[str]) -> DataFrame:
    """Long to wide, one column set per symbol, rows matched on the date."""
    long = bars.where(F.col("symbol").isin(list(legs)))
    return long.groupBy("date").agg(*[
        F.max(F.when(F.col("symbol") == s, F.col(v))).alias(f"{v}_{name}") for s, name in legs.items() for v in values])


def pair_frame(bars: DataFrame, legs: Mapping[str, str],
               values: Sequence[str] = ("open", "high", "low", "close", "volume")) -> DataFrame:
    """Dates on which both legs have a bar, with a ``pair`` key."""
    first, second = legs.values()
    wide = wide_by_symbol(bars, legs, values)
    return wide.where(F.col(f"close_{first}").isNotNull() & F.col(f"close_{second}").isNotNull()).select(
        F.lit(f"{second}-{first}").alias("pair"), "*")


def standardized_spread(df: DataFrame, spec: SeriesSpec, minuend: str, subtrahend: str,
                        window: int = 55, keep_ordinal: bool = False) -> DataFrame:
    """Difference of returns with rolling mean, deviation and z score."""
    return sliding(df, spec, window + 1, lambda d, w: add_spread(d, w, minuend, subtrahend, window),
                   keep_ordinal=keep_ordinal)


def add_spread(d: DataFrame, w: WindowSpec, minuend: str, subtrahend: str, window: int = 55) -> DataFrame:
    """Reaches ``window + 1`` rows back."""
    d = d.withColumn("spread", C.pct_change(F.col(minuend), w) - C.pct_change(F.col(subtrahend), w))
    return with_score(R.add(d, w, R.moments("spread", "mu", "std", window)))


def with_score(d: DataFrame) -> DataFrame:
    return d.withColumn("standardized_spread", C.ratio(F.col("spread") - F.col("mu"), F.col("std")))


def nonzero_direction(df: DataFrame, spec: SeriesSpec, value: str, out: str = "direction") -> DataFrame:
    """Sign of the latest non-zero change (tick rule)."""
    changed = sliding(df, spec, 1, lambda d, w: d.withColumn("_d", R.change(F.col(value), w)))
    filled = running(changed, spec, lasts={out: F.nullif("_d", F.lit(0.0))})
    return filled.withColumn(out, F.signum(out)).drop("_d")


def vwap(df: DataFrame, spec: SeriesSpec, out: str = "vwap") -> DataFrame:
    """Cumulative volume-weighted typical price."""
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    summed = running(df, spec, sums={"_pv": typical * F.col("volume"), "_v": F.col("volume")})
    return summed.withColumn(out, C.ratio(F.col("_pv"), F.col("_v"))).drop("_pv", "_v")


def vwap_day_of_month(df: DataFrame, spec: SeriesSpec, legs: Mapping[str, str]) -> DataFrame:
    """Sums cumulated per calendar day of the month and divided by the cumulated typical price.

    ``legs`` maps an output column to the suffix of its high, low, close and volume columns.
    """
    per_day = spec.with_(keys=(*spec.keys, "_dom"))
    sums: dict[str, Column] = {}
    for out, suffix in legs.items():
        typical = (F.col(f"close{suffix}") + F.col(f"high{suffix}") + F.col(f"low{suffix}")) / 3
        sums[f"_n_{out}"] = typical * F.col(f"volume{suffix}")
        sums[f"_d_{out}"] = typical
    summed = running(df.withColumn("_dom", F.dayofmonth(spec.ts)), per_day, sums=sums)
    return summed.withColumns({o: C.ratio(F.col(f"_n_{o}"), F.col(f"_d_{o}")) for o in legs}).drop("_dom", *sums)


def _smoothing(x: Column, gap: Column, alpha: float) -> tuple[Column, Column]:
    """Coefficients of an exponential mean that starts at its first value.

    A missing row keeps the mean but ages its weight by one step. Without a previous value in
    reach the weight of the past is below ``NOTHING``: the mean starts anew.
    """
    aged = F.pow(F.lit(1 - alpha), gap)
    a = F.when(x.isNull(), 1.0).when(gap.isNull(), 0.0).otherwise(aged / (aged + alpha))
    b = F.when(x.isNull(), 0.0).when(gap.isNull(), x).otherwise(x * alpha / (aged + alpha))
    return a, b


def smoothing_reach(span: int) -> int:
    """Rows after which a weight of an exponential mean is below ``NOTHING``."""
    return math.ceil(math.log(NOTHING) / math.log(1 - 2 / (span + 1))) if span > 1 else 1


def gap_to_previous(x: Column, w: WindowSpec) -> Column:
    """Rows back to the previous value, null if the chunk and its halo hold none.

    With a halo of ``smoothing_reach`` rows an older value has no measurable weight left, so
    the mean may start anew.
    """
    seen = F.last(F.when(x.isNotNull(), F.col(ORD)), ignorenulls=True)
    return F.col(ORD) - seen.over(w.rowsBetween(Window.unboundedPreceding, -1))


def _count(x: Column) -> tuple[Column, Column]:
    return F.lit(1.0), F.when(x.isNotNull(), 1.0).otherwise(0.0)


def ema(df: DataFrame, spec: SeriesSpec, outs: Mapping[str, tuple[str, int]], keep_ordinal: bool = False,
        **scan) -> DataFrame:
    """Exponential means, ``{name: (column, span)}``; null until ``span`` values were seen."""
    inputs = sorted({c for c, _ in outs.values()})
    reach = max(smoothing_reach(n) for _, n in outs.values())
    df = sliding(df, spec, reach, lambda d, w: d.withColumns(
        {f"_g_{c}": gap_to_previous(F.col(c), w) for c in inputs}), keep_ordinal=True)
    scans = {o: _smoothing(F.col(c), F.col(f"_g_{c}"), 2 / (n + 1)) for o, (c, n) in outs.items()}
    df = affine_scan(df, spec, {**scans, **{f"_n_{c}": _count(F.col(c)) for c in inputs}}, **scan)
    df = df.withColumns({o: F.when(F.col(f"_n_{c}") >= n, F.col(o)) for o, (c, n) in outs.items()})
    df = df.drop(*[f"_{k}_{c}" for c in inputs for k in "ng"])
    return df if keep_ordinal else df.drop(ORD)


def _wilder(x: Column, n: int) -> tuple[Column, Column]:
    """Wilder smoothing of a complete column that starts at its first value."""
    return F.lit((n - 1) / n), F.when(F.col(ORD) == 0, x).otherwise(x / n)


def rsi_inputs(x: Column, w: WindowSpec) -> dict[str, Column]:
    """Gains and losses, 0 where there is no change to measure (1 row back)."""
    d = R.change(x, w)
    return {"_up": F.when(d > 0, d).otherwise(0.0), "_dn": F.when(d < 0, -d).otherwise(0.0)}


def rsi_from(up: Column, dn: Column, n: int = 14) -> Column:
    """100 without losses; null before ``n`` rows."""
    value = F.when(dn == 0, 100.0).otherwise(100 - F.lit(100.0) / (1 + C.ratio(up, dn)))
    return F.when(F.col(ORD) >= n - 1, value)


def rsi(df: DataFrame, spec: SeriesSpec, value: str, out: str = "rsi", n: int = 14) -> DataFrame:
    """Wilder's relative strength index."""
    df = sliding(df, spec, 1, lambda d, w: d.withColumns(rsi_inputs(F.col(value), w)), keep_ordinal=True)
    df = affine_scan(df, spec, {"_up": _wilder(F.col("_up"), n), "_dn": _wilder(F.col("_dn"), n)})
    return df.withColumn(out, rsi_from(F.col("_up"), F.col("_dn"), n)).drop("_up", "_dn", ORD)


def true_range_of(w: WindowSpec, high: str, low: str, close: str) -> Column:
    """True range whose first value is the range of the bar (1 row back)."""
    return C.true_range(F.col(high), F.col(low), F.lag(close).over(w), first_is_range=True)


def atr_scan(name: str, n: int = 14) -> tuple[Column, Column]:
    """0 before row ``n - 1``, the mean of the first ``n`` ranges there, then the recursion.

    ``_seed`` is the mean of the ranges so far, right in the first chunk, where it is needed.
    """
    o = F.col(ORD)
    a = F.lit((n - 1) / n)
    b = F.when(o < n - 1, 0.0).when(o == n - 1, F.col(f"_seed_{name}")).otherwise(F.col(f"_tr_{name}") / n)
    return a, b


def atr(df: DataFrame, spec: SeriesSpec, high: str, low: str, close: str, out: str = "atr", n: int = 14) -> DataFrame:
    """Wilder's average true range."""
    spec = spec.with_(chunk_rows=max(spec.chunk_rows, n))
    df = sliding(df, spec, 1, lambda d, w: d.withColumn(f"_tr_{out}", true_range_of(w, high, low, close)).withColumn(
        f"_seed_{out}", F.avg(f"_tr_{out}").over(R.so_far(w))), keep_ordinal=True)
    return affine_scan(df, spec, {out: atr_scan(out, n)}).drop(f"_tr_{out}", f"_seed_{out}", ORD)


def ewm_std(df: DataFrame, spec: SeriesSpec, value: str, out: str, span: int = 100) -> DataFrame:
    """Unbiased exponentially weighted standard deviation with adjusted weights."""
    if ORD not in df.columns:
        df = with_ordinal(df, spec)
    q = 1 - 2 / (span + 1)
    x = F.col(value)
    some = x.isNotNull()
    keep, keep2 = F.lit(q), F.lit(q * q)
    df = affine_scan(df, spec, {
        "_w": (keep, F.when(some, 1.0).otherwise(0.0)),
        "_w2": (keep2, F.when(some, 1.0).otherwise(0.0)),
        "_wx": (keep, F.coalesce(x, F.lit(0.0))),
        "_wxx": (keep, F.coalesce(x * x, F.lit(0.0))),
    })
    w, w2 = F.col("_w"), F.col("_w2")
    mean = C.ratio(F.col("_wx"), w)
    biased = F.greatest(C.ratio(F.col("_wxx"), w) - mean * mean, F.lit(0.0))
    spread = w * w - w2
    var = F.when(spread > w * w * 1e-12, biased * w * w / spread)
    return df.withColumn(out, F.sqrt(var)).drop("_w", "_w2", "_wx", "_wxx", ORD)


def daily_volatility(df: DataFrame, spec: SeriesSpec, value: str, span: int = 100) -> DataFrame:
    """Exponentially weighted deviation of returns over exactly one calendar day."""
    def returns(d: DataFrame, w: WindowSpec) -> DataFrame:
        one_day = F.datediff(F.col(spec.ts), F.lag(spec.ts).over(w)) == 1
        return d.withColumn("_ret", F.when(one_day, C.pct_change(F.col(value), w)))

    df = sliding(df, spec, 1, returns, keep_ordinal=True)
    return ewm_std(df, spec, "_ret", "volatility", span).drop("_ret")


def cumulative_return(df: DataFrame, spec: SeriesSpec, value: str, out: str = "cumulative_return") -> DataFrame:
    """Compounded return since the first row, null on that row."""
    df = sliding(df, spec, 1, lambda d, w: d.withColumn("_ret", C.pct_change(F.col(value), w)))
    growth = F.col("_ret") + 1
    df = running(df, spec, sums={
        "_log": F.log(F.when(growth != 0, F.abs(growth))),
        "_neg": F.when(growth < 0, 1).otherwise(0), "_zero": F.when(growth == 0, 1).otherwise(0)})
    sign = F.when(F.col("_zero") > 0, 0.0).when(F.col("_neg") % 2 == 1, -1.0).otherwise(1.0)
    size = F.coalesce(F.exp("_log"), F.when(F.col("_zero") > 0, 0.0))
    return df.withColumn(out, F.when(F.col("_ret").isNotNull(), sign * size)).drop("_ret", "_log", "_neg", "_zero")


def padded_pct_change(df: DataFrame, spec: SeriesSpec, value: str, out: str = "pct_change") -> DataFrame:
    """Return to the previous row after filling gaps with the last known value."""
    df = running(df, spec, lasts={"_f": F.col(value)})
    return sliding(df, spec, 1, lambda d, w: d.withColumn(out, C.pct_change(F.col("_f"), w))).drop("_f")


def asof_fill(left: DataFrame, right: DataFrame, spec: SeriesSpec, value: str) -> DataFrame:
    """Latest known ``value`` of ``right`` at or before each row of ``left``."""
    keys = list(spec.keys)
    probe = left.withColumn("_side", F.lit(1)).withColumn(value, F.lit(None).cast(right.schema[value].dataType))
    known = right.select(*keys, spec.ts, value).withColumn("_side", F.lit(0))
    both = known.unionByName(probe, allowMissingColumns=True)
    ordered = spec.with_(ties=("_side", *spec.ties))
    return running(both, ordered, lasts={value: F.col(value)}).where("_side = 1").drop("_side")


def technical_features(df: DataFrame, spec: SeriesSpec = PAIR, eth: str = "eth", btc: str = "btc",
                       window: int = 55, atr_eth_as_called: bool = False) -> DataFrame:
    """All spread, microstructure and technical columns of a pair frame.

    Everything bounded in rows shares one chunked exchange; all recurrences share one scan.
    Fact columns already in the frame are kept. ``atr_eth_as_called`` feeds (close, high, close)
    as (high, low, close) for the first leg.
    """
    stored = set(df.columns)
    eth_hlc = (f"close_{eth}", f"high_{eth}", f"close_{eth}") if atr_eth_as_called else (
        f"high_{eth}", f"low_{eth}", f"close_{eth}")

    def bounded(d: DataFrame, w: WindowSpec) -> DataFrame:
        first = {"spread": C.pct_change(F.col(f"close_{btc}"), w) - C.pct_change(F.col(f"close_{eth}"), w)}
        stats = [R.moments("spread", "mu", "std", window),
                 R.engle_granger(F.col(f"close_{btc}"), F.col(f"close_{eth}"), f"close_{eth}_coint")]
        for leg, hlc in ((btc, (f"high_{btc}", f"low_{btc}", f"close_{btc}")), (eth, eth_hlc)):
            close, direction = F.col(f"close_{leg}"), f"close_direction_{leg}"
            first[f"_tr_{leg}"] = true_range_of(w, *hlc)
            if f"close_change_{leg}" not in stored:
                first[f"close_change_{leg}"] = R.change(close, w)
                first[direction] = F.signum(R.change(close, w))
                first[f"dollar_volume_{leg}"] = close * F.col(f"volume_{leg}")
                stats.append(R.moving_avg(close, f"dollar_volume1m_{leg}"))
            stats += [R.entropy(F.col(direction), f"{direction}_entropy"),
                      R.roll_spread(f"close_change_{leg}", f"bid_ask_spread_close_change_{leg}")]
        d = with_score(R.add(d.withColumns(first), w, *stats))
        return d.withColumns({
            **rsi_inputs(F.col(z), w), "_gap": gap_to_previous(F.col(z), w), f"close_{btc}_coint": F.col(f"close_{eth}_coint"),
            **{f"_seed_{leg}": F.avg(f"_tr_{leg}").over(R.so_far(w)) for leg in (eth, btc)}})

    z, reach = "standardized_spread", smoothing_reach(20)
    df = vwap_day_of_month(df, spec, {f"vwap_{btc}": f"_{btc}", f"vwap_{eth}": f"_{eth}"})
    df = sliding(df, spec, max(101, reach + window + 2), bounded, keep_ordinal=True)
    df = affine_scan(df, spec, {
        "ma_5": _smoothing(F.col(z), F.col("_gap"), 2 / 6),
        "ma_20": _smoothing(F.col(z), F.col("_gap"), 2 / 21), "_seen": _count(F.col(z)),
        "_up": _wilder(F.col("_up"), 14), "_dn": _wilder(F.col("_dn"), 14),
        f"atr_{btc}": atr_scan(btc), f"atr_{eth}": atr_scan(eth),
    })
    df = df.withColumns({f"ma_{n}": F.when(F.col("_seen") >= n, F.col(f"ma_{n}")) for n in (5, 20)})
    df = df.withColumn("rsi", rsi_from(F.col("_up"), F.col("_dn")))
    ma5, ma20 = F.col("ma_5"), F.col("ma_20")
    df = sliding(df, spec, 1, lambda d, w: d.withColumns({
        "ma_upper_co": C.crossed_up(ma5, ma20, w), "ma_lower_co": C.crossed_down(ma5, ma20, w)}))
    return df.drop("_up", "_dn", *[f"_{k}_{n}" for k in ("tr", "seed") for n in (eth, btc)], "_seen", "_gap")
