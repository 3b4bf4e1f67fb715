"""Sections C, D, E: projections, joins, aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom.catalog import base as b
from pairloom.catalog.base import BARS, BAR_SERIES, DATES, LEGS, PAIR, PAIR_SQL, POSITIONS, PREDICTIONS, RUN_TS, SPREAD_SQL, query
from pairloom.functions import columns as C
from pairloom.operators import features as f
from pairloom.operators import labels, metrics, quality
from pairloom.operators.series import join_per_key, SeriesSpec
from pairloom.operators.tables import normalise_names
from pairloom.plans import marts
from pairloom.plans.features import latest_vector
from pairloom.sources import bars as src

COLS = ["symbol", "date", "open", "high", "low", "close", "volume"]
SQL_COLS = ", ".join(COLS)
E4 = "CAST(CAST(floor({0} * 10000 + 0.5) AS BIGINT) AS VARCHAR)"


def key_sql(*texts: str) -> str:
    null = C.KEY_NULL
    return "md5(" + " || '-' || ".join(f"coalesce(CAST({x} AS VARCHAR), '{null}')" for x in texts) + ")"


@query("c1_rename_project", f"""WITH {BARS}
SELECT date, open, close AS adjusted_close, symbol AS symbol_code, 'CCC' AS exchange_code,
       'SOURCE_DATA.ASSET_SOURCE' AS source FROM bars""")
def c1(spark, d):
    names = {"date": "date", "open": "open", "adj_close": "adjusted_close", "symbol": "symbol_code", "exchange": "exchange_code"}
    return marts.staged(b.assets(spark, d), names, "SOURCE_DATA.ASSET_SOURCE")


@query("c2_star_exclude", f"WITH {BARS} SELECT * EXCLUDE (open, high) FROM bars")
def c2(spark, d):
    return spark.sql("SELECT * EXCEPT (open, high) FROM {t}", t=b.bars(spark, d))


@query("c3_surrogate_key", f"""WITH {BARS}
SELECT {key_sql('date', 'symbol')} AS asset_hkey,
       {key_sql('date', 'symbol', *[E4.format(c) for c in ('open', 'high', 'low', 'close', 'close', 'volume')],
                "'CCC'", "'USD'", 'NULL', 'NULL', 'NULL')} AS asset_hdiff, symbol AS symbol_code, date FROM bars""")
def c3(spark, d):
    return marts.stage_bars(b.assets(spark, d), RUN_TS).select("asset_hkey", "asset_hdiff", "symbol_code", "date")


@query("c4_run_timestamp", f"WITH {BARS} SELECT symbol AS symbol_code, date, '{RUN_TS}' AS load_ts_utc FROM bars")
def c4(spark, d):
    return marts.stage_bars(b.assets(spark, d), RUN_TS).select("symbol_code", "date", "load_ts_utc")


@query("c5_default_record", f"""WITH {PREDICTIONS}
SELECT date, prediction, round(confidence, 6) AS confidence, model_id FROM predictions
UNION ALL SELECT DATE '2000-01-01', 0, 0.0, 'Missing'""")
def c5(spark, d):
    p = b.predictions(spark, d).select("date", "prediction", "confidence", "model_id")
    out = marts.with_missing_member(p, {"date": "2000-01-01", "prediction": 0, "confidence": 0.0, "model_id": "Missing"})
    return out.withColumn("confidence", F.round("confidence", 6))


@query("c6_not_null_filter", f"WITH {PREDICTIONS} SELECT date, prediction FROM predictions WHERE prediction IS NOT NULL")
def c6(spark, d):
    return b.predictions(spark, d).where(F.col("prediction").isNotNull()).select("date", "prediction")


@query("c7_cast_columns", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(value AS BIGINT) AS v FROM events")
def c7(spark, d):
    e = b.table(spark, d, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").try_cast("double").alias("k"), F.rint("value").cast("long").alias("v"))


@query("c8_names_normalise", f"""WITH {BARS}
SELECT symbol AS "SYMBOL", CAST(date AS VARCHAR) AS "DATE", close AS "ADJ_CLOSE_ETH" FROM bars""")
def c8(spark, d):
    return normalise_names(b.bars(spark, d).select("symbol", "date", F.col("close").alias("adj close_eth")))


@query("c9_select_by_pattern", f"WITH {PAIR_SQL} SELECT close_eth, close_btc FROM pair")
def c9(spark, d):
    df = b.pair(spark, d)
    return df.select(*[c for c in df.columns if "close" in c.lower()])


@query("c11_date_from_parts", f"""WITH {DATES}
SELECT date_code, make_date(year, month, day) AS date, CAST(make_date(year, month, day) AS TIMESTAMP) AS ts FROM dates""")
def c11(spark, d):
    zero = F.lit(0)
    return b.dates(spark, d).select(
        "date_code", F.make_date("year", "month", "day").alias("date"),
        F.make_timestamp_ntz(F.col("year"), F.col("month"), F.col("day"), zero, zero, zero).alias("ts"))


@query("c12_time_slice", f"""WITH {BARS}
SELECT {SQL_COLS}, CASE WHEN date <= DATE '2000-07-31' THEN 'train' ELSE 'test' END AS part FROM bars
WHERE date BETWEEN DATE '1996-01-01' AND DATE '2001-06-30'""")
def c12(spark, d):
    df = b.bars(spark, d).where(F.col("date").between("1996-01-01", "2001-06-30"))
    return df.select(*COLS, F.when(F.col("date") <= "2000-07-31", "train").otherwise("test").alias("part"))


@query("c13_drop_nulls", f"WITH {SPREAD_SQL} SELECT date, round(z, 6) AS z FROM zs WHERE z IS NOT NULL AND spread IS NOT NULL")
def c13(spark, d):
    return b.spread(spark, d).dropna("any").select("date", F.round("standardized_spread", 6).alias("z"))


BARRIER = SPREAD_SQL + """,
pairs AS (SELECT a.date, a.z, f.date AS ts, abs(f.z) AS v FROM zs a LEFT JOIN zs f
          ON f.date > a.date AND f.date <= a.date + 2 AND (abs(f.z) >= abs(a.z) * (1 + 0.662016) OR abs(f.z) <= abs(a.z) * (1 - 0.220194))),
hits AS (SELECT date, z, ts, v FROM pairs QUALIFY row_number() OVER (PARTITION BY date ORDER BY ts) = 1),
labelled AS (SELECT date, z, CASE WHEN ts IS NULL THEN 0 WHEN v >= abs(z) * (1 + 0.662016) THEN 1 ELSE -1 END AS label,
                    coalesce(ts, CAST(date + 2 AS DATE)) AS t1 FROM hits)
"""


def labelled(spark, d, keep=False):
    return labels.triple_barrier(b.spread(spark, d), PAIR, "standardized_spread", 0.662016, 0.220194, 2)


@query("c14_label_relabel", f"WITH {BARRIER} SELECT date, CASE WHEN label = -1 THEN 0 ELSE label END AS label FROM labelled WHERE label <> 0")
def c14(spark, d):
    return labels.relabel(labelled(spark, d)).select("date", "label")


@query("c16_fix_last_date", f"""WITH {BARS},
l AS (SELECT symbol, close, date, max(date) OVER (PARTITION BY symbol) AS top FROM bars),
h AS (SELECT symbol, close, CASE WHEN date = top THEN CAST(date + 1 AS DATE) ELSE date END AS date FROM l),
m AS (SELECT *, max(date) OVER (PARTITION BY symbol) AS last, lag(date) OVER (PARTITION BY symbol ORDER BY date) AS prev FROM h)
SELECT symbol, CASE WHEN date = last AND date - prev <> 1 THEN CAST(date - 1 AS DATE) ELSE date END AS gap_fixed,
       CASE WHEN date = last AND last <> DATE '2001-11-05' THEN CAST(date - 1 AS DATE) ELSE date END AS today_fixed,
       close FROM m""")
def c16(spark, d):
    # the last bar of each symbol comes with the date of the day after, which leaves a gap before it
    df = b.bars(spark, d).select("symbol", "date", "close")
    last = df.groupBy("symbol").agg(F.max("date").alias("_top"))
    late = join_per_key(df, last, ["symbol"], "date").withColumn("date", F.when(F.col("date") == F.col("_top"), F.date_add("date", 1)).otherwise(F.col("date")))
    late = late.drop("_top").withColumn("_d", F.col("date"))
    gap = src.shift_last_on_gap(late).withColumnRenamed("date", "gap_fixed").withColumn("date", F.col("_d"))
    return src.shift_last_if_missing(gap, "2001-11-05").select("symbol", "gap_fixed", F.col("date").alias("today_fixed"), "close")


@query("c17_barrier_levels", f"WITH {SPREAD_SQL} SELECT date, round(z * (1 + 0.662016), 6) AS upper, round(z * (1 - 0.220194), 6) AS lower FROM zs")
def c17(spark, d):
    up, low = C.barrier_levels(F.col("standardized_spread"), 0.662016, 0.220194)
    return b.spread(spark, d).select("date", F.round(up, 6).alias("upper"), F.round(low, 6).alias("lower"))


# --- D: joins ---------------------------------------------------------------------------------


@query("d1_date_to_date_code", f"""WITH {BARS}, {DATES}
SELECT bars.*, date_code FROM bars JOIN dates ON year(bars.date) = year AND month(bars.date) = month AND day(bars.date) = day""")
def d1(spark, d):
    return marts.to_date_code(b.bars(spark, d), b.dates(spark, d))


@query("d2_fact_dim_join", f"""WITH {BARS}, {DATES}
SELECT symbol, close, date_code, year, month, day FROM bars JOIN dates USING (date)""")
def d2(spark, d):
    dim = b.dates(spark, d)
    facts = marts.to_date_code(b.bars(spark, d), dim).select("symbol", "close", "date_code")
    return src.lookback(facts, dim, 0)


@query("d3_position_close_left_join", f"""WITH {BARS}, {POSITIONS}
SELECT account_id, positions.symbol, positions.date, time, position_size, close FROM positions
LEFT JOIN bars ON bars.symbol = positions.symbol AND bars.date = positions.date""")
def d3(spark, d):
    closes = b.bars(spark, d).select("symbol", "date", "close")
    return b.positions(spark, d).join(closes, ["symbol", "date"], "left").select(
        "account_id", "symbol", "date", "time", "position_size", "close")


@query("d4_symbol_pivot", f"""WITH {BARS}
SELECT date, max(CASE WHEN symbol = 'A' THEN close END) AS close_eth, max(CASE WHEN symbol = 'A' THEN volume END) AS volume_eth,
       max(CASE WHEN symbol = 'N' THEN close END) AS close_btc, max(CASE WHEN symbol = 'N' THEN volume END) AS volume_btc
FROM bars WHERE symbol IN ('A', 'N') GROUP BY date""")
def d4(spark, d):
    return f.wide_by_symbol(b.bars(spark, d), LEGS, ["close", "volume"])


@query("d5_index_left_join", f"""WITH {BARS}
SELECT l.date, l.close, e.close AS close_eth FROM (SELECT * FROM bars WHERE symbol = 'N') l
LEFT JOIN (SELECT * FROM bars WHERE symbol = 'A') e ON l.date = e.date""")
def d5(spark, d):
    df = b.bars(spark, d)
    left = df.where("symbol = 'N'").select("date", "close")
    right = df.where("symbol = 'A'").select("date", F.col("close").alias("close_eth"))
    return left.join(right, "date", "left")


@query("d6_asof_fill_join", f"""WITH {BARS},
trend AS (SELECT l_returnflag AS symbol, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, sum(l_quantity) AS trend
          FROM lineitem GROUP BY ALL)
SELECT bars.symbol, bars.date, bars.close, trend.trend FROM bars ASOF LEFT JOIN trend
ON bars.symbol = trend.symbol AND bars.date >= trend.date""")
def d6(spark, d):
    items = b.table(spark, d, "lineitem")
    trend = items.groupBy(F.col("l_returnflag").alias("symbol"), F.trunc("l_shipdate", "month").alias("date")).agg(
        F.sum("l_quantity").alias("trend"))
    return f.asof_fill(b.bars(spark, d).select("symbol", "date", "close"), trend, BAR_SERIES, "trend")


@query("d7_forward_interval_join", f"""WITH {SPREAD_SQL}
SELECT a.pair, a.date AS t0, CAST(count(f.date) AS BIGINT) AS n_candidates, min(f.date) AS first_ts,
       round(max(abs(f.z)), 6) AS max_abs, round(min(abs(f.z)), 6) AS min_abs
FROM zs a LEFT JOIN zs f ON f.date > a.date AND f.date <= a.date + 5 GROUP BY a.pair, a.date""")
def d7(spark, d):
    out = labels.forward_candidates(b.spread(spark, d), PAIR, "standardized_spread", 5)
    return out.select("pair", "t0", "n_candidates", "first_ts", b.r("max_abs"), b.r("min_abs"))


SPANS = """
spans AS (SELECT event_type, ts AS t0, ts + to_minutes(CAST(30 + value AS INTEGER)) AS t1, event_id,
                 ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15' AND event_id % 50 = 0 AS is_test FROM events)
"""


# slices for events: their number is bounded by the minutes covered, a busy minute still fits a task
MINUTE = 1 / 1440


def event_spans(spark, d):
    """Spans of half an hour and more from every event; some early-January ones are test spans."""
    e = b.table(spark, d, "events")
    minutes = (30 + F.rint("value")).cast("int")
    t0 = F.col("ts").cast("timestamp_ntz")
    test = (F.col("ts") >= "2024-01-10") & (F.col("ts") < "2024-01-15") & (F.col("event_id") % 50 == 0)
    return e.select("event_type", t0.alias("t0"), (t0 + F.make_dt_interval(mins=minutes)).alias("t1"), "event_id", test.alias("is_test"))


@query("d8_overlap_anti_join", f"""WITH {SPANS}
SELECT event_type, event_id, t0, t1 FROM spans tr WHERE NOT is_test AND NOT EXISTS (
  SELECT 1 FROM spans te WHERE te.is_test AND te.event_type = tr.event_type AND tr.t0 <= te.t1 AND tr.t1 >= te.t0)""")
def d8(spark, d):
    spans = event_spans(spark, d)
    spec = SeriesSpec(("event_type",), "t0", ties=("event_id",), bucket_days=MINUTE)
    return labels.purge_train(spans.where(~F.col("is_test")).drop("is_test"), spans.where("is_test").drop("is_test"), spec)


@query("d9_membership_semi", f"""WITH {BARS}
SELECT symbol, date FROM bars WHERE date IN (SELECT date FROM bars WHERE close > 1500)""")
def d9(spark, d):
    df = b.bars(spark, d)
    known = df.where("close > 1500").select("date")
    return df.select("symbol", "date").join(known, "date", "left_semi")


@query("d10_scalar_subquery", f"""WITH {BARS}, {DATES}
SELECT symbol, date_code, close FROM bars JOIN dates USING (date) WHERE date_code >= (SELECT max(date_code) FROM dates) - 365""")
def d10(spark, d):
    dim = b.dates(spark, d)
    newest = dim.agg(F.max("date_code")).scalar()
    return marts.to_date_code(b.bars(spark, d), dim).where(F.col("date_code") >= newest - 365).select("symbol", "date_code", "close")


# --- E: aggregations --------------------------------------------------------------------------


@query("e1_max_date", f"WITH {BARS} SELECT max(date) AS latest FROM bars")
def e1(spark, d):
    return src.high_water(b.bars(spark, d), by=())


@query("e2_distinct", "SELECT DISTINCT l_returnflag AS symbol, l_linestatus AS status FROM lineitem")
def e2(spark, d):
    return b.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("symbol"), F.col("l_linestatus").alias("status")).distinct()


@query("e3_label_counts", f"WITH {BARRIER} SELECT label, CAST(count(*) AS BIGINT) AS n FROM labelled GROUP BY label")
def e3(spark, d):
    return labelled(spark, d).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("e4_correlation", f"""WITH {PAIR_SQL},
p AS (SELECT *, close_btc / lag(close_btc) OVER (ORDER BY date) - 1 AS rb, close_eth / lag(close_eth) OVER (ORDER BY date) - 1 AS re FROM pair)
SELECT pair, round(corr(close_btc, close_eth), 6) AS close_corr, round(corr(rb, re), 6) AS return_corr FROM p GROUP BY pair""")
def e4(spark, d):
    from pairloom.operators.series import join_per_key, sliding
    df = sliding(b.pair(spark, d), PAIR, 1, lambda p, w: p.withColumns({
        "rb": C.pct_change(F.col("close_btc"), w), "re": C.pct_change(F.col("close_eth"), w)}))
    out = metrics.correlation(df, ["pair"], {"close_corr": ("close_btc", "close_eth"), "return_corr": ("rb", "re")})
    return out.select("pair", b.r("close_corr"), b.r("return_corr"))


@query("e5_standardize_global", f"""WITH {BARS},
m AS (SELECT symbol, avg(close) AS mean, stddev_samp(close) AS dev FROM bars GROUP BY symbol)
SELECT symbol, date, round((close - mean) / NULLIF(dev, 0), 6) AS z FROM bars JOIN m USING (symbol)""")
def e5(spark, d):
    df = b.bars(spark, d)
    moments = df.groupBy("symbol").agg(F.avg("close").alias("mean"), F.stddev_samp("close").alias("dev"))
    z = C.ratio(F.col("close") - F.col("mean"), F.col("dev"))
    return join_per_key(df, moments, ["symbol"], "date").select("symbol", "date", F.round(z, 6).alias("z"))


@query("e6_portfolio_metrics", f"""WITH {BARS},
e AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1 AS ret,
             max(close) OVER (PARTITION BY symbol ORDER BY date) AS peak FROM bars),
a AS (SELECT symbol, first(close ORDER BY date) AS f, last(close ORDER BY date) AS final_value, sum(ret) AS cr,
             avg(ret) / stddev_samp(ret) * sqrt(252) AS sharpe, max(1 - close / peak) AS dd, max(peak - close) AS dc FROM e GROUP BY symbol)
SELECT symbol, final_value, round(final_value / f, 6) AS profit_ratio, round(cr, 6) AS cumulative_return,
       round(sharpe, 6) AS sharpe, round(dd, 6) AS drawdown, round(dc, 6) AS drawdown_cash, round(0.3 * cr - 0.7 * dd, 6) AS weighted FROM a""")
def e6(spark, d):
    out = metrics.portfolio_metrics(b.bars(spark, d), BAR_SERIES, "close")
    return out.select("symbol", "final_value", *[b.r(c) for c in (
        "profit_ratio", "cumulative_return", "sharpe", "drawdown", "drawdown_cash", "weighted")])


@query("e7_weighted_scores", """
WITH s AS (SELECT doc_id % 5 AS fold, quality AS y, 1 + toxic AS w, (doc_id * 37 % 101 + 0.5) / 102 AS p FROM labels),
l AS (SELECT fold, sum(w * -ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)) / sum(w) AS log_loss,
             sum(CASE WHEN (p > 0.5) = (y = 1) THEN w ELSE 0 END) / sum(w) AS accuracy, sum(w) AS tw,
             sum(CASE WHEN y = 1 AND p > 0.5 THEN w ELSE 0 END) AS c11, sum(CASE WHEN y = 1 AND p <= 0.5 THEN w ELSE 0 END) AS c10,
             sum(CASE WHEN y = 0 AND p > 0.5 THEN w ELSE 0 END) AS c01, sum(CASE WHEN y = 0 AND p <= 0.5 THEN w ELSE 0 END) AS c00
      FROM s GROUP BY fold),
r AS (SELECT fold, y, rank() OVER (PARTITION BY fold ORDER BY p) + (count(*) OVER (PARTITION BY fold, p) - 1) / 2 AS rk FROM s),
u AS (SELECT fold, (sum(CASE WHEN y = 1 THEN rk END) - sum(y) * (sum(y) + 1) / 2) / NULLIF(sum(y) * sum(1 - y), 0) AS auc FROM r GROUP BY fold)
SELECT fold, round(log_loss, 6) AS log_loss, round(accuracy, 6) AS accuracy,
       round((2 * c11 / (2 * c11 + c10 + c01) * (c11 + c10) + coalesce(2 * c00 / NULLIF(2 * c00 + c10 + c01, 0), 0) * (c00 + c01)) / tw, 6) AS f1,
       round(auc, 6) AS roc_auc FROM l JOIN u USING (fold)""")
def e7(spark, d):
    x = b.table(spark, d, "labels").select(
        (F.col("doc_id") % 5).alias("fold"), F.col("quality").alias("y"), (1 + F.col("toxic")).alias("w"),
        ((F.col("doc_id") * 37 % 101 + 0.5) / 102).cast("double").alias("p"))
    out = metrics.weighted_scores(x, "fold", "y", "p", "w")
    return out.select("fold", *[b.r(c) for c in ("log_loss", "accuracy", "f1", "roc_auc")])


@query("e8_backfill_gap_report", f"""WITH {BARS}, {DATES},
spans AS (SELECT symbol, min(date) AS lo, max(date) AS hi FROM bars GROUP BY symbol)
SELECT symbol, dates.date FROM spans JOIN dates ON dates.date BETWEEN lo AND hi
ANTI JOIN bars ON bars.symbol = spans.symbol AND bars.date = dates.date""")
def e8(spark, d):
    return quality.calendar_gaps(b.bars(spark, d), b.dates(spark, d))
