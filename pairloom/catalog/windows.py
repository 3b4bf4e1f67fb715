"""Section F: window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom.catalog import base as b
from pairloom.catalog.base import BARS, BAR_SERIES, DATES, PAIR, POSITIONS, RUN_TS, SPREAD_SQL, query
from pairloom.functions import columns as C
from pairloom.functions import rolling as R
from pairloom.operators import features as f
from pairloom.operators.series import ORD, sliding
from pairloom.plans import marts

W = "WINDOW w AS (PARTITION BY symbol ORDER BY date)"

# bars with position, change and last non-zero direction
NUMBERED = BARS + """,
nb AS (SELECT *, row_number() OVER w - 1 AS o, close - lag(close) OVER w AS cc FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date))
"""


def on_bars(spark, d, back, fn):
    return sliding(b.bars(spark, d), BAR_SERIES, back, fn)


@query("f1_close_change", f"WITH {BARS} SELECT symbol, date, close - lag(close) OVER w AS close_change FROM bars {W}")
def f1(spark, d):
    return on_bars(spark, d, 1, lambda x, w: x.select("*", R.change(F.col("close"), w).alias("close_change"))).select(
        "symbol", "date", "close_change")


@query("f2_close_direction", f"WITH {BARS} SELECT symbol, date, CAST(sign(close - lag(close) OVER w) AS DOUBLE) AS close_direction FROM bars {W}")
def f2(spark, d):
    return on_bars(spark, d, 1, lambda x, w: x.withColumn("close_direction", F.signum(R.change(F.col("close"), w)))).select(
        "symbol", "date", "close_direction")


@query("f3_dollar_volume", f"WITH {BARS} SELECT symbol, date, close * volume AS dollar_volume FROM bars")
def f3(spark, d):
    return b.bars(spark, d).select("symbol", "date", (F.col("close") * F.col("volume")).alias("dollar_volume"))


@query("f4_dollar_volume_1m", f"""WITH {BARS}
SELECT symbol, date, round(avg(close) OVER w, 6) AS dollar_volume1m,
       round(CASE WHEN count(*) OVER w = 21 THEN avg(close * volume) OVER w END, 3) AS dollar_vol_1m_full
FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)""")
def f4(spark, d):
    value = F.col("close") * F.col("volume")
    out = on_bars(spark, d, 21, lambda x, w: R.add(
        x, w, R.moving_avg(F.col("close"), "dollar_volume1m"), R.moving_avg(value, "dollar_vol_1m_full", partial=False)))
    return out.select("symbol", "date", b.r("dollar_volume1m"), b.r("dollar_vol_1m_full", 3))


@query("f5_true_range", f"""WITH {BARS}
SELECT symbol, date, high - low AS range, CASE WHEN lag(close) OVER w IS NOT NULL THEN
       greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) END AS true_range FROM bars {W}""")
def f5(spark, d):
    tr = lambda w: C.true_range(F.col("high"), F.col("low"), F.lag("close").over(w))
    return on_bars(spark, d, 1, lambda x, w: x.withColumns({"range": F.col("high") - F.col("low"), "true_range": tr(w)})).select(
        "symbol", "date", "range", "true_range")


@query("f6_vwap_cumulative", f"""WITH {BARS}
SELECT symbol, date, round(sum((high + low + close) / 3 * volume) OVER w / sum(volume) OVER w, 4) AS vwap FROM bars {W}""")
def f6(spark, d):
    return f.vwap(b.bars(spark, d), BAR_SERIES).select("symbol", "date", b.r("vwap", 4))


@query("f7_vwap_day_of_month", f"""WITH {BARS}
SELECT symbol, date, round(sum((high + low + close) / 3 * volume) OVER w / sum((high + low + close) / 3) OVER w, 6) AS vwap_dom
FROM bars WINDOW w AS (PARTITION BY symbol, day(date) ORDER BY date)""")
def f7(spark, d):
    return f.vwap_day_of_month(b.bars(spark, d), BAR_SERIES, {"vwap_dom": ""}).select("symbol", "date", b.r("vwap_dom"))


@query("f8_position_pnl", f"""WITH {BARS}, {DATES}, {POSITIONS},
v AS (SELECT account_id, positions.symbol, positions.date, time, position_size * close AS value
      FROM positions JOIN dates ON positions.date = dates.date
      LEFT JOIN bars ON bars.symbol = positions.symbol AND bars.date = positions.date),
p AS (SELECT *, lag(value) OVER (PARTITION BY account_id, symbol ORDER BY date, time) AS prev FROM v)
SELECT account_id, symbol AS symbol_code, time, value AS position_value, prev AS previous_position_val,
       value / NULLIF(prev, 0) - 1 AS position_value_daily_pct_change FROM p""")
def f8(spark, d):
    return fact_position(spark, d).select("account_id", "symbol_code", "time", "position_value", "previous_position_val",
                                          "position_value_daily_pct_change")


def fact_position(spark, d):
    dim = b.dates(spark, d)
    closes = marts.to_date_code(b.bars(spark, d), dim).select(F.col("symbol").alias("symbol_code"), "date_code", "close")
    return marts.fact_position(marts.stage_positions(b.positions(spark, d), RUN_TS), dim, closes)


@query("f9_pct_change", f"""WITH {BARS},
g AS (SELECT symbol, date, CASE WHEN close > 800 THEN close END AS c FROM bars),
p AS (SELECT symbol, date, last_value(c IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS c FROM g)
SELECT symbol, date, c / NULLIF(lag(c) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS pct_change FROM p""")
def f9(spark, d):
    holes = b.bars(spark, d).withColumn("close", F.when(F.col("close") > 800, F.col("close")))
    return f.padded_pct_change(holes, BAR_SERIES, "close").select("symbol", "date", "pct_change")


@query("f10_standardized_spread", f"""WITH {SPREAD_SQL}
SELECT pair, date, spread, round(mu, 6) AS mu, round(std, 6) AS std, round(z, 6) AS standardized_spread FROM zs""")
def f10(spark, d):
    return b.spread(spark, d).select("pair", "date", "spread", b.r("mu"), b.r("std"), b.r("standardized_spread"))


@query("f11_nonzero_direction", f"""WITH {BARS},
g AS (SELECT symbol, date, round(close, -2) AS c FROM bars),
x AS (SELECT symbol, date, NULLIF(c - lag(c) OVER (PARTITION BY symbol ORDER BY date), 0) AS d FROM g)
SELECT symbol, date, CAST(sign(last_value(d IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)) AS DOUBLE)
       AS direction FROM x""")
def f11(spark, d):
    # closes in steps of a hundred, so that unchanged closes occur
    coarse = b.bars(spark, d).withColumn("close", F.round("close", -2))
    return f.nonzero_direction(coarse, BAR_SERIES, "close").select("symbol", "date", "direction")


@query("f12_rolling_entropy", f"""WITH {NUMBERED},
s AS (SELECT symbol, date, o, sign(cc) AS x FROM nb),
k AS (SELECT t.symbol, t.date, i.x, count(i.x) AS n FROM s t JOIN s i ON i.symbol = t.symbol AND i.o BETWEEN t.o - 29 AND t.o
      WHERE i.x IS NOT NULL GROUP BY ALL),
e AS (SELECT symbol, date, sum(n) AS n, -sum(n / 30 * log2(n / 30)) AS e FROM k GROUP BY symbol, date)
SELECT s.symbol, s.date, round(CASE WHEN n = 30 THEN e END, 6) AS entropy FROM s LEFT JOIN e USING (symbol, date)""")
def f12(spark, d):
    def fn(x, w):
        x = x.withColumn("_x", F.signum(R.change(F.col("close"), w)))
        return R.add(x, w, R.entropy(F.col("_x"), "entropy"))
    return on_bars(spark, d, 31, fn).select("symbol", "date", b.r("entropy"))


@query("f12_rolling_entropy_any_values", f"""WITH {NUMBERED},
s AS (SELECT symbol, date, o, floor(close / 250) AS x FROM nb),
k AS (SELECT t.symbol, t.date, i.x, count(i.x) AS n FROM s t JOIN s i ON i.symbol = t.symbol AND i.o BETWEEN t.o - 29 AND t.o GROUP BY ALL),
e AS (SELECT symbol, date, sum(n) AS n, -sum(n / 30 * log2(n / 30)) AS e FROM k GROUP BY symbol, date)
SELECT symbol, date, round(CASE WHEN n = 30 THEN e END, 6) AS entropy FROM e""")
def f12_any(spark, d):
    level = F.floor(F.col("close") / 250)
    out = on_bars(spark, d, 29, lambda x, w: x.withColumn("entropy", R.entropy_any(level, w)))
    return out.select("symbol", "date", b.r("entropy"))


ROLL = NUMBERED + """,
win AS (SELECT t.symbol, t.date, i.cc, CASE WHEN i.o = t.o - 19 THEN 0 ELSE lag(i.cc) OVER (PARTITION BY t.symbol, t.date ORDER BY i.o) END AS lg
        FROM nb t JOIN nb i ON i.symbol = t.symbol AND i.o BETWEEN t.o - 19 AND t.o),
rs AS (SELECT symbol, date, CASE WHEN count(cc) = 20 THEN sqrt(greatest(0, -covar_samp(cc, lg))) ELSE 0 END AS roll FROM win GROUP BY symbol, date)
"""


@query("f13_roll_spread", f"WITH {ROLL} SELECT symbol, date, round(roll, 6) AS roll_spread FROM rs")
def f13(spark, d):
    def fn(x, w):
        x = x.withColumn("_x", R.change(F.col("close"), w))
        return R.add(x, w, R.roll_spread("_x", "roll_spread"))
    return on_bars(spark, d, 22, fn).select("symbol", "date", b.r("roll_spread"))


@query("f14_crossover", f"""WITH {BARS}
SELECT symbol, date, CASE WHEN close >= lag(open) OVER w AND lag(close) OVER w < lag(open) OVER w THEN 1 ELSE 0 END AS up,
       CASE WHEN close <= lag(open) OVER w AND lag(close) OVER w > lag(open) OVER w THEN 1 ELSE 0 END AS down FROM bars {W}""")
def f14(spark, d):
    x, y = F.col("close"), F.col("open")
    return on_bars(spark, d, 1, lambda t, w: t.withColumns({"up": C.crossed_up(x, y, w), "down": C.crossed_down(x, y, w)})).select(
        "symbol", "date", "up", "down")


EMA = """
v AS (SELECT o, date, z, min(o) FILTER (WHERE z IS NOT NULL) OVER () AS o0 FROM zs),
ema AS (SELECT t.o, t.date,
    sum(CASE WHEN i.o = i.o0 THEN 1 ELSE 2.0 / 6 END * power(1 - 2.0 / 6, t.o - i.o) * i.z) AS e5,
    sum(CASE WHEN i.o = i.o0 THEN 1 ELSE 2.0 / 21 END * power(1 - 2.0 / 21, t.o - i.o) * i.z) AS e20, count(i.z) AS n
    FROM v t LEFT JOIN v i ON i.o <= t.o AND i.z IS NOT NULL GROUP BY t.o, t.date),
ma AS (SELECT o, date, CASE WHEN n >= 5 THEN e5 END AS ma_5, CASE WHEN n >= 20 THEN e20 END AS ma_20 FROM ema)
"""


@query("f15_ema", f"WITH {SPREAD_SQL}, {EMA} SELECT date, round(ma_5, 6) AS ma_5, round(ma_20, 6) AS ma_20 FROM ma")
def f15(spark, d):
    z = b.spread(spark, d, keep_ordinal=True)
    out = f.ema(z, PAIR, {"ma_5": ("standardized_spread", 5), "ma_20": ("standardized_spread", 20)})
    return out.select("date", b.r("ma_5"), b.r("ma_20"))


RSI = """
ud AS (SELECT o, date, CASE WHEN z - lag(z) OVER (ORDER BY o) > 0 THEN z - lag(z) OVER (ORDER BY o) ELSE 0 END AS up,
              CASE WHEN z - lag(z) OVER (ORDER BY o) < 0 THEN lag(z) OVER (ORDER BY o) - z ELSE 0 END AS dn FROM zs),
us AS (SELECT t.o, t.date, sum(CASE WHEN i.o = 0 THEN 1 ELSE 1.0 / 14 END * power(13.0 / 14, t.o - i.o) * i.up) AS u,
              sum(CASE WHEN i.o = 0 THEN 1 ELSE 1.0 / 14 END * power(13.0 / 14, t.o - i.o) * i.dn) AS n
       FROM ud t JOIN ud i ON i.o <= t.o GROUP BY t.o, t.date),
rs14 AS (SELECT o, date, CASE WHEN o >= 13 THEN CASE WHEN n = 0 THEN 100 ELSE 100 - 100 / (1 + u / n) END END AS rsi FROM us)
"""


@query("f16_rsi", f"WITH {SPREAD_SQL}, {RSI} SELECT date, round(rsi, 6) AS rsi FROM rs14")
def f16(spark, d):
    return f.rsi(b.spread(spark, d, keep_ordinal=True), PAIR, "standardized_spread").select("date", b.r("rsi"))


def atr_sql(src: str, key: str, high: str, low: str, close: str, name: str) -> str:
    """ATR in closed form over a numbered source."""
    return f"""
tr_{name} AS (SELECT {key} AS k, date, o, greatest({high} - {low}, abs({high} - lag({close}) OVER w), abs({low} - lag({close}) OVER w)) AS tr
              FROM {src} WINDOW w AS (PARTITION BY {key} ORDER BY o)),
seed_{name} AS (SELECT k, avg(tr) AS s FROM tr_{name} WHERE o < 14 GROUP BY k),
atr_{name} AS (SELECT t.k, t.date, t.o, CASE WHEN t.o < 13 THEN 0 ELSE any_value(s) * power(13.0 / 14, t.o - 13)
                    + coalesce(sum(i.tr * power(13.0 / 14, t.o - i.o) / 14), 0) END AS atr
               FROM tr_{name} t JOIN seed_{name} q ON q.k = t.k
               LEFT JOIN tr_{name} i ON i.k = t.k AND i.o <= t.o AND i.o >= 14 GROUP BY t.k, t.date, t.o)
"""


@query("f17_atr", f"WITH {NUMBERED}, {atr_sql('nb', 'symbol', 'high', 'low', 'close', 'b')} SELECT k AS symbol, date, round(atr, 3) AS atr FROM atr_b")
def f17(spark, d):
    return f.atr(b.bars(spark, d), BAR_SERIES, "high", "low", "close").select("symbol", "date", b.r("atr", 3))


@query("f18_daily_volatility", f"""WITH {NUMBERED},
r AS (SELECT symbol, date, o, CASE WHEN date - lag(date) OVER w = 1 THEN close / NULLIF(lag(close) OVER w, 0) - 1 END AS x FROM nb {W}),
m AS (SELECT t.symbol, t.date, sum(power(99.0 / 101, t.o - i.o)) AS sw, sum(power(99.0 / 101, 2 * (t.o - i.o))) AS sw2,
             sum(power(99.0 / 101, t.o - i.o) * i.x) / sum(power(99.0 / 101, t.o - i.o)) AS mu, count(i.x) AS n
      FROM r t LEFT JOIN r i ON i.symbol = t.symbol AND i.o <= t.o AND i.x IS NOT NULL GROUP BY t.symbol, t.date),
s AS (SELECT t.symbol, t.date, sum(power(99.0 / 101, t.o - i.o) * power(i.x - mu, 2)) AS ss
      FROM r t JOIN r i ON i.symbol = t.symbol AND i.o <= t.o AND i.x IS NOT NULL JOIN m ON m.symbol = t.symbol AND m.date = t.date
      GROUP BY t.symbol, t.date)
SELECT m.symbol, m.date, round(CASE WHEN n > 1 THEN sqrt(ss / sw * sw * sw / (sw * sw - sw2)) END, 6) AS volatility
FROM m LEFT JOIN s USING (symbol, date)""")
def f18(spark, d):
    return f.daily_volatility(b.bars(spark, d), BAR_SERIES, "close").select("symbol", "date", b.r("volatility"))


@query("f19_rolling_trend_beta", f"""WITH {NUMBERED}
SELECT symbol, date, round(CASE WHEN count(*) OVER w = 24 THEN regr_slope(close, o) OVER w END, 5) AS beta FROM nb
WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""")
def f19(spark, d):
    return on_bars(spark, d, 24, lambda x, w: R.add(x, w, R.trend_beta("close", ORD, "beta"))).select(
        "symbol", "date", b.r("beta", 5))


@query("f20_cumulative_return", f"""WITH {BARS}
SELECT symbol, date, round(CASE WHEN row_number() OVER w > 1 THEN close / first_value(close) OVER w END, 6) AS cumulative_return FROM bars {W}""")
def f20(spark, d):
    return f.cumulative_return(b.bars(spark, d), BAR_SERIES, "close").select("symbol", "date", b.r("cumulative_return"))
