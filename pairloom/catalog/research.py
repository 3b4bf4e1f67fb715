"""Section H: labels, validation, statistics, regimes, model data."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom import schemas
from pairloom.catalog import base as b
from pairloom.catalog.base import BARS, BAR_SERIES, PAIR, PAIR_SQL, PREDICTIONS, SPREAD_SQL, query
from pairloom.catalog.lag_choice import prefix_moments, row_moments, statistic
from pairloom.catalog.relational import BARRIER, MINUTE, SPANS, event_spans
from pairloom.catalog.windows import EMA, RSI, atr_sql
from pairloom.operators import labels, regimes, stats
from pairloom.operators.features import technical_features
from pairloom.operators.series import SeriesSpec
from pairloom.plans import training
from pairloom.session import work_dir

EVENTS = SeriesSpec(("event_type",), "t0", ties=("event_id",), bucket_days=MINUTE)
Z = "standardized_spread"


@query("h1_triple_barrier", f"WITH {BARRIER} SELECT date, round(z, 6) AS z, label, t1 FROM labelled")
def h1(spark, d):
    out = labels.triple_barrier(b.spread(spark, d), PAIR, Z, 0.662016, 0.220194, 2)
    return out.select("date", F.round(Z, 6).alias("z"), "label", "t1")


# Barrier settings (take profit, stop loss, holding days).
GRID = [(0.1, 0.1, 2), (0.25, 0.25, 2), (0.662016, 0.220194, 2), (0.173043, 0.117092, 3), (1.0, 0.5, 4)]


@query("h2_barrier_sweep", f"""WITH {SPREAD_SQL},
grid AS (SELECT * FROM (VALUES {', '.join(str(g) for g in GRID)}) g(tp, sl, h)),
c AS (SELECT g.*, a.date, a.z, f.date AS ts, abs(f.z) AS v FROM zs a CROSS JOIN grid g LEFT JOIN zs f ON f.date > a.date AND f.date <= a.date + h
      AND (abs(f.z) >= abs(a.z) * (1 + tp) OR abs(f.z) <= abs(a.z) * (1 - sl))),
x AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY tp, sl, h, date ORDER BY ts) = 1),
l AS (SELECT *, CASE WHEN ts IS NULL THEN 0 WHEN v >= abs(z) * (1 + tp) THEN 1 ELSE -1 END AS label FROM x)
SELECT CAST(tp AS DOUBLE) AS take_profit, CAST(sl AS DOUBLE) AS stop_loss, CAST(h AS BIGINT) AS holding_days,
       CAST(sum(CAST(label = 1 AS INT)) AS BIGINT) AS n_profit, CAST(sum(CAST(label = -1 AS INT)) AS BIGINT) AS n_stop,
       CAST(sum(CAST(label = 0 AS INT)) AS BIGINT) AS n_timeout,
       CAST(sum(CASE WHEN ts IS NULL THEN h ELSE ts - date END) AS DOUBLE) AS days_held FROM l GROUP BY tp, sl, h""")
def h2(spark, d):
    return labels.barrier_sweep(b.spread(spark, d), PAIR, Z, GRID).drop("pair")


@query("h3_label_concurrency", f"""WITH {SPANS}
SELECT e.event_type, e.t0 AS ts, CAST(count(*) AS BIGINT) AS concurrency FROM spans e JOIN spans s
ON s.event_type = e.event_type AND s.t0 <= e.t0 AND s.t1 >= e.t0 GROUP BY e.event_type, e.event_id, e.t0""")
def h3(spark, d):
    spans = event_spans(spark, d)
    times = spans.select("event_type", F.col("t0").alias("ts"))
    spec = SeriesSpec(("event_type",), "ts", bucket_days=MINUTE)
    return labels.label_concurrency(times, spans, spec)


@query("h3_average_uniqueness", f"""WITH {SPANS},
c AS (SELECT e.event_type, e.t0 AS ts, count(*) AS n FROM (SELECT DISTINCT event_type, t0 FROM spans) e JOIN spans s
      ON s.event_type = e.event_type AND s.t0 <= e.t0 AND s.t1 >= e.t0 GROUP BY ALL)
SELECT s.event_type, s.event_id, round(avg(1.0 / n), 6) AS weight FROM spans s JOIN c ON c.event_type = s.event_type AND c.ts BETWEEN s.t0 AND s.t1
GROUP BY s.event_type, s.event_id""")
def h3_average(spark, d):
    spans = event_spans(spark, d)
    spec = SeriesSpec(("event_type",), "ts", bucket_days=MINUTE)
    out = labels.average_uniqueness(spans.select("event_type", F.col("t0").alias("ts")), spans, spec)
    return out.select("event_type", "event_id", b.r("weight"))


@query("h4_purge_train", f"""WITH {BARRIER},
te AS (SELECT date, t1 FROM labelled WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'),
tr AS (SELECT date, t1 FROM labelled WHERE date NOT BETWEEN DATE '1998-01-01' AND DATE '1998-12-31')
SELECT date AS t0, t1 FROM tr WHERE NOT EXISTS (SELECT 1 FROM te WHERE tr.date <= te.t1 AND tr.t1 >= te.date)""")
def h4(spark, d):
    lab = labels.triple_barrier(b.spread(spark, d), PAIR, Z, 0.662016, 0.220194, 2).select("pair", F.col("date").alias("t0"), "t1")
    inside = F.col("t0").between("1998-01-01", "1998-12-31")
    return labels.purge_train(lab.where(~inside), lab.where(inside), PAIR.with_(ts="t0")).select("t0", "t1")


@query("h5_embargo_times", f"""WITH {BARS},
n AS (SELECT symbol, date, count(*) OVER (PARTITION BY symbol) AS n, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS o,
             max(date) OVER (PARTITION BY symbol) AS last FROM bars)
SELECT a.symbol, a.date, coalesce(e.date, a.last) AS embargo FROM n a
LEFT JOIN n e ON e.symbol = a.symbol AND e.o = a.o + CAST(floor(a.n * 0.01) AS BIGINT)""")
def h5(spark, d):
    return labels.embargo_times(b.bars(spark, d), BAR_SERIES, 0.01)


@query("h6_purged_kfold", f"""WITH {SPANS},
e AS (SELECT *, row_number() OVER w - 1 AS o, count(*) OVER (PARTITION BY event_type) AS n FROM spans
      WINDOW w AS (PARTITION BY event_type ORDER BY t0, event_id)),
f AS (SELECT *, CASE WHEN o < (n % 4) * (n // 4 + 1) THEN o // (n // 4 + 1) ELSE n % 4 + (o - (n % 4) * (n // 4 + 1)) // (n // 4) END AS own FROM e),
bounds AS (SELECT event_type, own AS fold, min(t0) AS start, max(t1) AS stop FROM f GROUP BY ALL),
resume AS (SELECT bounds.*, count(f.t0) AS pos FROM bounds LEFT JOIN f ON f.event_type = bounds.event_type AND f.t0 < stop GROUP BY ALL)
SELECT f.event_type, f.event_id, CAST(r.fold AS INTEGER) AS fold,
       CASE WHEN own = r.fold THEN 'test' WHEN t1 <= start OR (pos < n AND o >= pos + floor(n * 0.01)) THEN 'train'
            WHEN pos < n AND o >= pos THEN 'embargo' ELSE 'purged' END AS role
FROM f JOIN resume r USING (event_type)""")
def h6(spark, d):
    return labels.purged_kfold(event_spans(spark, d), EVENTS, "t1", 4, 0.01).select("event_type", "event_id", "fold", "role")


COINT = """
b100 AS (SELECT t.o, t.date, sum(i.close_btc * i.close_eth) / sum(i.close_eth * i.close_eth) AS beta, count(*) AS n
         FROM zs t JOIN zs i ON i.o BETWEEN t.o - 99 AND t.o GROUP BY t.o, t.date),
u100 AS (SELECT t.o, t.date, n, i.o AS io, i.close_btc - beta * i.close_eth AS u FROM b100 t JOIN zs i ON i.o BETWEEN t.o - 99 AND t.o),
d100 AS (SELECT o, date, n, u - lag(u) OVER w AS du, lag(u) OVER w AS ul FROM u100 WINDOW w AS (PARTITION BY o ORDER BY io)),
g100 AS (SELECT o, date, any_value(n) AS n, sum(du * ul) / sum(ul * ul) AS g, sum(ul * ul) AS ll FROM d100 WHERE ul IS NOT NULL GROUP BY o, date),
s100 AS (SELECT g100.o, g100.date, any_value(g100.n) AS n, any_value(g) / sqrt(sum(power(du - g * ul, 2)) / 98 / any_value(ll)) AS t
         FROM g100 JOIN d100 ON d100.o = g100.o AND ul IS NOT NULL GROUP BY g100.o, g100.date),
coint AS (SELECT zs.o, zs.date, CASE WHEN n = 100 THEN t END AS coint FROM zs LEFT JOIN s100 ON s100.o = zs.o)
"""


@query("h7_engle_granger_rolling", f"WITH {SPREAD_SQL}, {COINT} SELECT date, round(coint, 6) AS coint FROM coint")
def h7(spark, d):
    return stats.engle_granger(b.pair(spark, d), PAIR, "close_btc", "close_eth").select("date", b.r("coint"))


# residuals of each window of 100 rows, numbered 0..99; the criterion's moments start at difference 1 + the number of lags
_U = row_moments("u_aic", 100)
COINT_AIC = f"""
u_aic AS (SELECT 'btc-eth' AS symbol, u100.date, io - o + 99 AS i, u FROM u100 WHERE n = 100),
{_U[0]}, {statistic(_U[1], "n", 100, False, "ct")}"""


@query("h7_engle_granger_rolling_aic", f"WITH {SPREAD_SQL}, {COINT}, {COINT_AIC} SELECT zs.date, round(t, 6) AS coint FROM zs LEFT JOIN ct USING (date)")
def h7_aic(spark, d):
    out = stats.engle_granger(b.pair(spark, d), PAIR, "close_btc", "close_eth", lags="aic")
    return out.select("date", b.r("coint"))


# whole sample: y on x with a constant, then the residuals without one
FULL_COINT = PAIR_SQL + """,
f AS (SELECT regr_slope(close_btc, close_eth) AS s, regr_intercept(close_btc, close_eth) AS i FROM pair),
u AS (SELECT date, close_btc - s * close_eth - i AS u FROM pair, f),
d AS (SELECT u - lag(u) OVER w AS du, lag(u) OVER w AS ul FROM u WINDOW w AS (ORDER BY date)),
g AS (SELECT sum(du * ul) / sum(ul * ul) AS g, sum(ul * ul) AS ll, count(du) AS n FROM d WHERE ul IS NOT NULL)
"""


@query("h7_engle_granger_full", f"""WITH {FULL_COINT}
SELECT 'btc-eth' AS pair, any_value(n) AS n_obs, round(any_value(s), 6) AS slope, round(any_value(i), 4) AS intercept,
       round(any_value(g) / sqrt(sum(power(du - g * ul, 2)) / (any_value(n) - 1) / any_value(ll)), 6) AS coint FROM d, g, f WHERE ul IS NOT NULL""")
def h7_full(spark, d):
    out = stats.engle_granger_full(b.pair(spark, d), PAIR, "close_btc", "close_eth")
    return out.select("pair", "n_obs", b.r("slope"), b.r("intercept", 4), b.r("coint"))


NB = BARS + ", nb AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS o FROM bars)"


@query("h8_adf_stat", f"""WITH {BARS},
x AS (SELECT symbol, close - lag(close) OVER w AS dy, lag(close) OVER w AS y1 FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)),
g AS (SELECT symbol, count(dy) AS n, sum(dy * y1) / sum(y1 * y1) AS g, sum(y1 * y1) AS ll,
             regr_slope(dy, y1) AS gc, regr_sxx(dy, y1) AS sxx, regr_intercept(dy, y1) AS ic FROM x GROUP BY symbol)
SELECT symbol, n AS n_obs, round(any_value(g) / sqrt(sum(power(dy - g * y1, 2)) / (n - 1) / any_value(ll)), 6) AS adf_n,
       round(any_value(gc) / sqrt(sum(power(dy - gc * y1 - ic, 2)) / (n - 2) / any_value(sxx)), 6) AS adf_c
FROM x JOIN g USING (symbol) GROUP BY symbol, n""")
def h8(spark, d):
    bars = b.bars(spark, d)
    plain = stats.unit_root_full(bars, BAR_SERIES, "close", constant=False).withColumnRenamed("adf", "adf_n")
    with_c = stats.unit_root_full(bars, BAR_SERIES, "close", constant=True).select("symbol", F.col("adf").alias("adf_c"))
    return plain.join(with_c, "symbol").select("symbol", "n_obs", b.r("adf_n"), b.r("adf_c"))


@query("h8_adf_stat_rolling", f"""WITH {NB},
x AS (SELECT symbol, date, o, close, close - lag(close) OVER w AS dy, lag(close) OVER w AS y1 FROM nb WINDOW w AS (PARTITION BY symbol ORDER BY o)),
m AS (SELECT t.symbol, t.date, count(*) AS n, regr_slope(i.dy, i.y1) AS g, regr_sxx(i.dy, i.y1) AS sxx, regr_syy(i.dy, i.y1) AS syy,
             regr_sxy(i.dy, i.y1) AS sxy FROM x t JOIN x i ON i.symbol = t.symbol AND i.o BETWEEN t.o - 58 AND t.o WHERE t.o >= 59 GROUP BY t.symbol, t.date)
SELECT x.symbol, x.date, round(g / sqrt((syy - g * sxy) / 57 / sxx), 6) AS adf FROM x LEFT JOIN m USING (symbol, date)""")
def h8_rolling(spark, d):
    return stats.unit_root(b.bars(spark, d), BAR_SERIES, "close", 60).select("symbol", "date", b.r("adf"))


_Y = prefix_moments("cl", "w60", 60, True)


@query("h8_adf_stat_rolling_aic", f"""WITH {NB}, cl AS (SELECT symbol, o, close AS y FROM nb), w60 AS (SELECT symbol, date, o, 60 AS n FROM nb WHERE o >= 59),
{_Y[0]}, {statistic(_Y[1], "n", 60, True, "df")} SELECT nb.symbol, nb.date, round(t, 6) AS adf FROM nb LEFT JOIN df USING (symbol, date)""")
def h8_aic(spark, d):
    return stats.unit_root(b.bars(spark, d), BAR_SERIES, "close", 60, lags="aic").select("symbol", "date", b.r("adf"))


@query("h9_sadf", f"""WITH {NB},
x AS (SELECT symbol, date, o, ln(close) - lag(ln(close)) OVER w AS dy, lag(ln(close)) OVER w AS y1 FROM nb WINDOW w AS (PARTITION BY symbol ORDER BY o)),
m AS (SELECT t.symbol, t.date, len.m, regr_slope(i.dy, i.y1) AS g, regr_sxx(i.dy, i.y1) AS sxx, regr_syy(i.dy, i.y1) AS syy,
             regr_sxy(i.dy, i.y1) AS sxy FROM x t CROSS JOIN range(20, 51) len(m)
      JOIN x i ON i.symbol = t.symbol AND i.o BETWEEN t.o - len.m + 2 AND t.o WHERE t.o >= 49 GROUP BY t.symbol, t.date, len.m),
s AS (SELECT symbol, date, max(g / sqrt((syy - g * sxy) / (m - 3) / sxx)) AS sadf FROM m GROUP BY symbol, date)
SELECT x.symbol, x.date, round(sadf, 5) AS sadf FROM x LEFT JOIN s USING (symbol, date)""")
def h9(spark, d):
    logs = b.bars(spark, d).select("symbol", "date", F.log("close").alias("y"))
    return stats.sadf(logs, BAR_SERIES, "y").select("symbol", "date", b.r("sadf", 5))


_L = prefix_moments("lg", "w50", 50, True)


@query("h9_sadf_aic", f"""WITH {PAIR_SQL}, np AS (SELECT 'btc-eth' AS symbol, date, ln(close_btc / close_eth) AS y, row_number() OVER (ORDER BY date) - 1 AS o FROM pair),
lg AS (SELECT symbol, o, y FROM np), w50 AS (SELECT symbol, date, o, CAST(len.m AS INTEGER) AS n FROM np CROSS JOIN range(30, 51) len(m) WHERE o >= 49),
{_L[0]}, {statistic(_L[1], "n", 50, True, "sx")}, best AS (SELECT date, max(t) AS sadf FROM sx GROUP BY date)
SELECT np.symbol AS pair, np.date, round(sadf, 5) AS sadf FROM np LEFT JOIN best USING (date)""")
def h9_aic(spark, d):
    ratio = b.pair(spark, d).select("pair", "date", F.log(F.col("close_btc") / F.col("close_eth")).alias("y"))
    return stats.sadf(ratio, PAIR, "y", min_window=30, lags="aic").select("pair", "date", b.r("sadf", 5))


@query("h10_johansen_trace", f"""WITH {PAIR_SQL},
l AS (SELECT close_btc - lag(close_btc) OVER w AS dx, close_eth - lag(close_eth) OVER w AS dy, lag(close_btc) OVER w AS lx, lag(close_eth) OVER w AS ly,
             lag(close_btc) OVER w - lag(close_btc, 2) OVER w AS zx, lag(close_eth) OVER w - lag(close_eth, 2) OVER w AS zy
      FROM pair WINDOW w AS (ORDER BY date)),
c AS (SELECT count(*) AS n, avg(dx) AS mdx, avg(dy) AS mdy, avg(lx) AS mlx, avg(ly) AS mly, var_pop(zx) AS a, covar_pop(zx, zy) AS b, var_pop(zy) AS e,
             covar_pop(dx, zx) AS dxzx, covar_pop(dx, zy) AS dxzy, covar_pop(dy, zx) AS dyzx, covar_pop(dy, zy) AS dyzy,
             covar_pop(lx, zx) AS lxzx, covar_pop(lx, zy) AS lxzy, covar_pop(ly, zx) AS lyzx, covar_pop(ly, zy) AS lyzy,
             avg(zx) AS mzx, avg(zy) AS mzy FROM l WHERE zx IS NOT NULL),
r AS (SELECT n, dx - mdx - ((dxzx * e - dxzy * b) * (zx - mzx) + (dxzy * a - dxzx * b) * (zy - mzy)) / (a * e - b * b) AS d1,
             dy - mdy - ((dyzx * e - dyzy * b) * (zx - mzx) + (dyzy * a - dyzx * b) * (zy - mzy)) / (a * e - b * b) AS d2,
             lx - mlx - ((lxzx * e - lxzy * b) * (zx - mzx) + (lxzy * a - lxzx * b) * (zy - mzy)) / (a * e - b * b) AS k1,
             ly - mly - ((lyzx * e - lyzy * b) * (zx - mzx) + (lyzy * a - lyzx * b) * (zy - mzy)) / (a * e - b * b) AS k2
      FROM l, c WHERE zx IS NOT NULL),
s AS (SELECT any_value(n) AS n, avg(d1 * d1) AS d11, avg(d1 * d2) AS d12, avg(d2 * d2) AS d22, avg(k1 * k1) AS k11, avg(k1 * k2) AS k12,
             avg(k2 * k2) AS k22, avg(k1 * d1) AS q11, avg(k1 * d2) AS q12, avg(k2 * d1) AS q21, avg(k2 * d2) AS q22 FROM r),
g AS (SELECT *, (q11 * d22 - q12 * d12) / (d11 * d22 - d12 * d12) AS p11, (q12 * d11 - q11 * d12) / (d11 * d22 - d12 * d12) AS p12,
             (q21 * d22 - q22 * d12) / (d11 * d22 - d12 * d12) AS p21, (q22 * d11 - q21 * d12) / (d11 * d22 - d12 * d12) AS p22 FROM s),
h AS (SELECT *, p11 * q11 + p12 * q12 AS s11, p11 * q21 + p12 * q22 AS s12, p21 * q11 + p22 * q12 AS s21, p21 * q21 + p22 * q22 AS s22 FROM g),
m AS (SELECT n, (k22 * s11 - k12 * s21) / (k11 * k22 - k12 * k12) AS a, (k22 * s12 - k12 * s22) / (k11 * k22 - k12 * k12) AS b,
             (k11 * s21 - k12 * s11) / (k11 * k22 - k12 * k12) AS c, (k11 * s22 - k12 * s12) / (k11 * k22 - k12 * k12) AS e FROM h),
v AS (SELECT n, (a + e + sqrt(power(a + e, 2) - 4 * (a * e - b * c))) / 2 AS l1, (a + e - sqrt(power(a + e, 2) - 4 * (a * e - b * c))) / 2 AS l2 FROM m)
SELECT 'btc-eth' AS pair, n AS n_obs, round(l1, 6) AS eig_1, round(l2, 6) AS eig_2, round(-n * (ln(1 - l1) + ln(1 - l2)), 4) AS trace_r0,
       round(-n * ln(1 - l2), 4) AS trace_r1 FROM v""")
def h10(spark, d):
    out = stats.johansen_trace(b.pair(spark, d), PAIR, "close_btc", "close_eth")
    return out.select("pair", "n_obs", b.r("eig_1"), b.r("eig_2"), b.r("trace_r0", 4), b.r("trace_r1", 4))


MODEL = regimes.Regimes((0.5, 0.5), ((0.9, 0.1), (0.2, 0.8)), (-0.5, 0.5), (0.5, 1.5))

# forward recursion of the filtered probabilities, one row after the other
FILTER = """
e AS (SELECT date, z, row_number() OVER (ORDER BY date) AS k, exp(-power(z + 0.5, 2) / (2 * 0.5)) / sqrt(0.5) AS e0,
             exp(-power(z - 0.5, 2) / (2 * 1.5)) / sqrt(1.5) AS e1 FROM zs WHERE z IS NOT NULL),
f AS (SELECT k, e0 / (e0 + e1) AS p0, e1 / (e0 + e1) AS p1 FROM e WHERE k = 1
      UNION ALL
      SELECT e.k, (p0 * 0.9 + p1 * 0.2) * e0 / ((p0 * 0.9 + p1 * 0.2) * e0 + (p0 * 0.1 + p1 * 0.8) * e1),
             (p0 * 0.1 + p1 * 0.8) * e1 / ((p0 * 0.9 + p1 * 0.2) * e0 + (p0 * 0.1 + p1 * 0.8) * e1)
      FROM f JOIN e ON e.k = f.k + 1)
"""


@query("h11_hmm_decode")
def h11(spark, d):
    return regimes.decode(b.spread(spark, d), PAIR, Z, MODEL)


# best path: scores forward with the chosen predecessors, then back from the better end
VITERBI = """
le AS (SELECT date, row_number() OVER (ORDER BY date) AS k, -0.5 * (ln(2 * pi() * 0.5) + power(z + 0.5, 2) / 0.5) AS e0,
              -0.5 * (ln(2 * pi() * 1.5) + power(z - 0.5, 2) / 1.5) AS e1 FROM zs WHERE z IS NOT NULL),
vf AS (SELECT k, ln(0.5) + e0 AS v0, ln(0.5) + e1 AS v1, 0 AS b0, 0 AS b1 FROM le WHERE k = 1
       UNION ALL
       SELECT le.k, greatest(v0 + ln(0.9), v1 + ln(0.2)) + e0, greatest(v0 + ln(0.1), v1 + ln(0.8)) + e1,
              CASE WHEN v0 + ln(0.9) >= v1 + ln(0.2) THEN 0 ELSE 1 END, CASE WHEN v0 + ln(0.1) >= v1 + ln(0.8) THEN 0 ELSE 1 END
       FROM vf JOIN le ON le.k = vf.k + 1),
vb AS (SELECT k, CASE WHEN v0 >= v1 THEN 0 ELSE 1 END AS state FROM vf WHERE k = (SELECT max(k) FROM le)
       UNION ALL
       SELECT vf.k - 1, CASE WHEN state = 0 THEN b0 ELSE b1 END FROM vb JOIN vf ON vf.k = vb.k WHERE vf.k > 1)
"""


@query("h11_hmm_path", f"WITH RECURSIVE {SPREAD_SQL}, {VITERBI} SELECT date, state FROM vb JOIN le USING (k)")
def h11_path(spark, d):
    return regimes.decode(b.spread(spark, d), PAIR, Z, MODEL).select("date", "state")


@query("h11_hmm_filter", f"WITH RECURSIVE {SPREAD_SQL}, {FILTER} SELECT date, round(p0, 6) AS p0, round(p1, 6) AS p1 FROM f JOIN e USING (k)")
def h11_filter(spark, d):
    out = regimes.decode(b.spread(spark, d), PAIR, Z, MODEL, mode="filter")
    return out.select("date", b.r("p0"), b.r("p1"))


def returns(spark, d):
    from pairloom.functions.columns import pct_change
    from pairloom.operators.series import sliding
    return sliding(b.bars(spark, d), BAR_SERIES, 1, lambda x, w: x.withColumn("ret", pct_change(F.col("close"), w)))


@query("h12_hmm_fit")
def h12(spark, d):
    # one model per symbol on its last returns
    return regimes.fit(returns(spark, d), BAR_SERIES, "ret")


def _em_step(k: int) -> str:
    """One step of expectation-maximisation on all returns, from the models ``m{k}`` to ``m{k + 1}``, row after row."""
    logs = [f"-0.5 * (ln(2 * pi() * v{j}) + power(x - u{j}, 2) / v{j})" for j in (0, 1)]
    ahead = [f"(p0 * a0{j} + p1 * a1{j})" for j in (0, 1)]
    behind = [f"(a{i}0 * n.d0 * q0 + a{i}1 * n.d1 * q1)" for i in (0, 1)]
    xi = {f"{i}{j}": f"f.p{i} * a{i}{j} * n.d{j} * b.q{j}" for i in (0, 1) for j in (0, 1)}
    return f"""
l{k} AS MATERIALIZED (SELECT symbol, k, n, x, {logs[0]} AS l0, {logs[1]} AS l1 FROM rk JOIN m{k} USING (symbol)),
e{k} AS MATERIALIZED (SELECT symbol, k, n, x, greatest(l0, l1) AS top, exp(l0 - greatest(l0, l1)) AS d0, exp(l1 - greatest(l0, l1)) AS d1 FROM l{k}),
f{k} AS (SELECT symbol, k, s0 * d0 / (s0 * d0 + s1 * d1) AS p0, s1 * d1 / (s0 * d0 + s1 * d1) AS p1, ln(s0 * d0 + s1 * d1) + top AS ll
         FROM e{k} JOIN m{k} USING (symbol) WHERE k = 1
         UNION ALL
         SELECT e.symbol, e.k, {ahead[0]} * d0 / ({ahead[0]} * d0 + {ahead[1]} * d1), {ahead[1]} * d1 / ({ahead[0]} * d0 + {ahead[1]} * d1),
                ln({ahead[0]} * d0 + {ahead[1]} * d1) + top
         FROM f{k} f JOIN e{k} e ON e.symbol = f.symbol AND e.k = f.k + 1 JOIN m{k} m ON m.symbol = f.symbol),
b{k} AS (SELECT symbol, k, 5e-1 AS q0, 5e-1 AS q1 FROM e{k} WHERE k = n
         UNION ALL
         SELECT n.symbol, n.k - 1, {behind[0]} / ({behind[0]} + {behind[1]}), {behind[1]} / ({behind[0]} + {behind[1]})
         FROM b{k} b JOIN e{k} n ON n.symbol = b.symbol AND n.k = b.k JOIN m{k} m ON m.symbol = b.symbol WHERE n.k > 1),
g{k} AS (SELECT symbol, k, x, p0 * q0 / (p0 * q0 + p1 * q1) AS g0, p1 * q1 / (p0 * q0 + p1 * q1) AS g1, ll FROM f{k} JOIN b{k} USING (symbol, k) JOIN e{k} USING (symbol, k)),
x{k} AS (SELECT f.symbol, {', '.join(f"sum({e} / ({' + '.join(xi.values())})) AS t{ij}" for ij, e in xi.items())}
         FROM f{k} f JOIN e{k} n ON n.symbol = f.symbol AND n.k = f.k + 1 JOIN b{k} b ON b.symbol = f.symbol AND b.k = f.k + 1
         JOIN m{k} m ON m.symbol = f.symbol GROUP BY f.symbol),
w{k} AS (SELECT symbol, sum(g0) AS w0, sum(g1) AS w1, sum(g0 * x) / sum(g0) AS u0, sum(g1 * x) / sum(g1) AS u1, sum(ll) AS ll,
                sum(CASE WHEN k = 1 THEN g0 END) AS s0, sum(CASE WHEN k = 1 THEN g1 END) AS s1 FROM g{k} GROUP BY symbol),
m{k + 1} AS MATERIALIZED (SELECT symbol, any_value(s0) AS s0, any_value(s1) AS s1, {', '.join(f"any_value(t{i}{j} / (t{i}0 + t{i}1)) AS a{i}{j}" for i in (0, 1) for j in (0, 1))},
         any_value(u0) AS u0, any_value(u1) AS u1, (0.01 + sum(g0 * power(x - u0, 2))) / any_value(w0) AS v0, (0.01 + sum(g1 * power(x - u1, 2))) / any_value(w1) AS v1,
         any_value(w{k}.ll) AS ll FROM g{k} JOIN w{k} USING (symbol) JOIN x{k} USING (symbol) GROUP BY symbol)"""


FIT_STEPS = 3
# returns numbered along each series, the best split of their values, then a fixed number of steps
WHOLE_FIT = BARS + """,
rt AS (SELECT symbol, date, close / NULLIF(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS x FROM bars),
rk AS MATERIALIZED (SELECT symbol, x, row_number() OVER (PARTITION BY symbol ORDER BY date) AS k, count(*) OVER (PARTITION BY symbol) AS n FROM rt WHERE x IS NOT NULL),
cs AS (SELECT symbol, n, row_number() OVER w AS c, sum(x) OVER w AS s, sum(x) OVER (PARTITION BY symbol) AS t, var_samp(x) OVER (PARTITION BY symbol) AS v
       FROM rk WINDOW w AS (PARTITION BY symbol ORDER BY x ROWS UNBOUNDED PRECEDING)),
m0 AS MATERIALIZED (SELECT symbol, 5e-1 AS s0, 5e-1 AS s1, 5e-1 AS a00, 5e-1 AS a01, 5e-1 AS a10, 5e-1 AS a11, s / c AS u0, (t - s) / (n - c) AS u1, v + 0.001 AS v0,
              v + 0.001 AS v1, 0.0 AS ll FROM cs WHERE c < n QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY s * s / c + (t - s) * (t - s) / (n - c) DESC) = 1),
""" + ",".join(_em_step(k) for k in range(FIT_STEPS))
FITTED = dict(start0="s0", start1="s1", p00="a00", p01="a01", p10="a10", p11="a11", mean0="u0", mean1="u1", var0="v0", var1="v1")


@query("h12_hmm_fit_series", f"""WITH RECURSIVE {WHOLE_FIT}
SELECT symbol, {', '.join(f"round({c}, 6) AS {n}" for n, c in FITTED.items())}, round(ll, 4) AS log_likelihood, {FIT_STEPS} AS steps FROM m{FIT_STEPS}""")
def h12_series(spark, d):
    # one model per symbol on all its returns
    out = regimes.fit(returns(spark, d), BAR_SERIES, "ret", roll=None, n_iter=FIT_STEPS)
    return out.select("symbol", *[b.r(c) for c in FITTED], b.r("log_likelihood", 4), "steps")


P = MODEL.transition


@query("h13_next_state", f"""WITH {PREDICTIONS},
p AS (SELECT date, confidence AS p1, 1 - confidence AS p0 FROM predictions WHERE confidence IS NOT NULL)
SELECT date, CASE WHEN p0 * 0.9 + p1 * 0.2 >= p0 * 0.1 + p1 * 0.8 THEN 0 ELSE 1 END AS next_state_1,
       CASE WHEN p0 * 0.83 + p1 * 0.34 >= p0 * 0.17 + p1 * 0.66 THEN 0 ELSE 1 END AS next_state_2 FROM p""")
def h13(spark, d):
    p = b.predictions(spark, d).where("confidence IS NOT NULL").select(
        "date", F.col("confidence").alias("p1"), (1 - F.col("confidence")).alias("p0"))
    return regimes.next_state(p, P, 2).drop("p0", "p1")


@query("h14_transition_probs", f"""WITH {PREDICTIONS},
p AS (SELECT date, confidence AS p1, 1 - confidence AS p0 FROM predictions WHERE confidence IS NOT NULL)
SELECT date, round(p0 * 0.9 + p1 * 0.2, 6) AS transition_1_0, round(p0 * 0.83 + p1 * 0.34, 6) AS transition_2_0,
       round(p0 * 0.81 + p1 * 0.04, 6) AS elementwise_2_0 FROM p""")
def h14(spark, d):
    p = b.predictions(spark, d).where("confidence IS NOT NULL").select(
        "date", F.col("confidence").alias("p1"), (1 - F.col("confidence")).alias("p0"))
    matrix = regimes.transition_probs(p, P, 2)
    both = regimes.transition_probs(matrix.withColumnsRenamed({"transition_1_0": "m1", "transition_2_0": "m2"}), P, 2, power="elementwise")
    return both.select("date", F.round("m1", 6).alias("transition_1_0"), F.round("m2", 6).alias("transition_2_0"),
                       F.round("transition_2_0", 6).alias("elementwise_2_0"))


def labelled_rows(spark, d):
    """Stored feature rows with all model inputs, label, label end and weight."""
    from pairloom.catalog.compositions import feature_rows
    rows = training.labelled_features(feature_rows(spark, d))
    return training.materialise(labels.start_uniqueness(labels.relabel(rows), PAIR), "labelled")


@query("h15_score_batch")
def h15(spark, d):
    # trained on the rows up to a split date, scored on the later ones
    rows = labelled_rows(spark, d)
    model = training.classifier(schemas.MODEL_FEATURES).fit(rows.where("date <= '2000-06-30'"))
    return training.score(model, rows.where("date > '2000-06-30'")).select("pair", "date", "label", "direction", "confidence")


@query("h16_train_classifier")
def h16(spark, d):
    # importances of a boosted model with regime features
    rows = labelled_rows(spark, d)
    columns = [*schemas.MODEL_FEATURES, "state", "next_state_1", "next_state_2"]
    model = training.classifier(columns).fit(training.materialise(training.with_regimes(rows, rows, PAIR), "train"))
    weights = model.stages[-1].featureImportances.toArray()
    literal = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(float(w)).alias("importance")) for c, w in zip(columns, weights)])
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.explode(literal).alias("f")).select("f.*", "n_rows")


@query("k6_column_pass", f"WITH {BARS} SELECT symbol, date, close, volume FROM bars")
def k6(spark, d):
    # the identity step of a model pipeline, saved and loaded again
    path = work_dir(spark, "stage")
    training.ColumnPass(["close", "volume"]).save(path)
    return training.ColumnPass.load(path).transform(b.bars(spark, d)).select("symbol", "date", "close", "volume")


@query("h17_align_test_columns", f"WITH {BARS} SELECT close, 0 AS missing, date, symbol FROM bars")
def h17(spark, d):
    return training.align_columns(b.bars(spark, d), ["close", "missing", "date", "symbol"])


PAIR_CHANGES = "chg AS (SELECT date, o, close_eth - lag(close_eth) OVER (ORDER BY o) AS ce, close_btc - lag(close_btc) OVER (ORDER BY o) AS cb FROM zs),"

NUMBERED_PAIR = SPREAD_SQL + f""", {EMA}, {RSI}, {COINT},
{atr_sql('zs', 'pair', 'high_btc', 'low_btc', 'close_btc', 'btc')},
{atr_sql('zs', 'pair', 'high_eth', 'low_eth', 'close_eth', 'eth')},
{PAIR_CHANGES}
w20 AS (SELECT t.date, i.ce, i.cb, CASE WHEN i.o = t.o - 19 THEN 0 ELSE lag(i.ce) OVER w END AS le,
               CASE WHEN i.o = t.o - 19 THEN 0 ELSE lag(i.cb) OVER w END AS lb
        FROM chg t JOIN chg i ON i.o BETWEEN t.o - 19 AND t.o WINDOW w AS (PARTITION BY t.date ORDER BY i.o)),
roll AS (SELECT date, CASE WHEN count(ce) = 20 THEN sqrt(greatest(0, -covar_samp(ce, le))) ELSE 0 END AS roll_eth,
                CASE WHEN count(cb) = 20 THEN sqrt(greatest(0, -covar_samp(cb, lb))) ELSE 0 END AS roll_btc FROM w20 GROUP BY date),
k30 AS (SELECT t.date, leg, sign(CASE WHEN leg = 'e' THEN i.ce ELSE i.cb END) AS x, count(*) AS n
        FROM chg t CROSS JOIN (VALUES ('e'), ('b')) l(leg) JOIN chg i ON i.o BETWEEN t.o - 29 AND t.o WHERE i.ce IS NOT NULL GROUP BY ALL),
ent AS (SELECT date, sum(CASE WHEN leg = 'e' THEN n END) AS n, -sum(CASE WHEN leg = 'e' THEN n / 30 * log2(n / 30) END) AS ent_eth,
               -sum(CASE WHEN leg = 'b' THEN n / 30 * log2(n / 30) END) AS ent_btc FROM k30 GROUP BY date),
vw AS (SELECT date, sum((high_btc + low_btc + close_btc) / 3 * volume_btc) OVER w / sum((high_btc + low_btc + close_btc) / 3) OVER w AS vwap_btc,
              sum((high_eth + low_eth + close_eth) / 3 * volume_eth) OVER w / sum((high_eth + low_eth + close_eth) / 3) OVER w AS vwap_eth
       FROM zs WINDOW w AS (PARTITION BY day(date) ORDER BY date)),
feats AS (SELECT zs.date, zs.o, z, mu, std, ma_5, ma_20, rsi, coint, ab.atr AS atr_btc, ae.atr AS atr_eth, roll_eth, roll_btc,
                 CASE WHEN ent.n = 30 THEN ent_eth END AS ent_eth, CASE WHEN ent.n = 30 THEN ent_btc END AS ent_btc, vwap_btc, vwap_eth,
                 CASE WHEN ma_5 >= lag(ma_20) OVER w AND lag(ma_5) OVER w < lag(ma_20) OVER w THEN 1 ELSE 0 END AS ma_upper_co,
                 CASE WHEN ma_5 <= lag(ma_20) OVER w AND lag(ma_5) OVER w > lag(ma_20) OVER w THEN 1 ELSE 0 END AS ma_lower_co
          FROM zs JOIN ma USING (date) JOIN rs14 USING (date) JOIN coint USING (date) JOIN atr_btc ab USING (date) JOIN atr_eth ae USING (date)
          JOIN roll USING (date) LEFT JOIN ent USING (date) JOIN vw USING (date) WINDOW w AS (ORDER BY zs.o))
"""

FEATURE_SELECT = """date, round(z, 6) AS standardized_spread, round(mu, 6) AS mu, round(std, 6) AS std, round(ma_5, 6) AS ma_5, round(ma_20, 6) AS ma_20,
       round(rsi, 5) AS rsi, round(coint, 5) AS coint, round(atr_btc, 4) AS atr_btc, round(atr_eth, 4) AS atr_eth,
       round(roll_eth, 4) AS roll_eth, round(roll_btc, 4) AS roll_btc, round(ent_eth, 6) AS ent_eth, round(ent_btc, 6) AS ent_btc,
       round(vwap_btc, 5) AS vwap_btc, round(vwap_eth, 5) AS vwap_eth, ma_upper_co, ma_lower_co"""


def feature_select(df, *more):
    short = {"roll": "bid_ask_spread_close_change_{0}", "ent": "close_direction_{0}_entropy"}
    return df.select(
        "date", *[b.r(c) for c in (Z, "mu", "std", "ma_5", "ma_20")], b.r("rsi", 5), F.round("close_btc_coint", 5).alias("coint"),
        b.r("atr_btc", 4), b.r("atr_eth", 4), *[F.round(short["roll"].format(leg), 4).alias(f"roll_{leg}") for leg in ("eth", "btc")],
        *[F.round(short["ent"].format(leg), 6).alias(f"ent_{leg}") for leg in ("eth", "btc")],
        b.r("vwap_btc", 5), b.r("vwap_eth", 5), "ma_upper_co", "ma_lower_co", *more)


@query("h18_technical_features", f"WITH {NUMBERED_PAIR} SELECT {FEATURE_SELECT} FROM feats")
def h18(spark, d):
    return feature_select(technical_features(b.pair(spark, d), PAIR))
