"""Section I: streaming and state; section L: end-to-end queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom import schemas
from pairloom.catalog import base as b
from pairloom.catalog.base import BARS, BAR_SERIES, DATES, LEGS, PAIR, POSITIONS, PREDICTIONS, RUN_TS, SPREAD_SQL, query
from pairloom.catalog.maintenance import SNAPSHOT, two_snapshots
from pairloom.catalog.relational import key_sql
from pairloom.catalog.research import FEATURE_SELECT, NUMBERED_PAIR, PAIR_CHANGES, feature_select
from pairloom.catalog.sources import write_messages
from pairloom.catalog.windows import atr_sql, fact_position
from pairloom.functions import rolling as R
from pairloom.operators.series import sliding
from pairloom.plans import features as feats
from pairloom.plans import marts, training
from pairloom.session import work_dir
from pairloom.streaming import carried, incremental, ledger, published, scoring
from pairloom.streaming import predictions as msgs

Z = "standardized_spread"


@query("i1_prediction_ingest", f"""WITH {PREDICTIONS}
SELECT 'm-' || CAST(date AS VARCHAR) AS msg_id, CAST(date AS VARCHAR) AS date, prediction, round(confidence, 6) AS confidence
FROM predictions WHERE prediction IS NOT NULL""")
def i1(spark, d):
    # messages with copies and broken bodies, delivered in three periods; each readable message once out. A period is one batch: the
    # watermark must not move inside it, whose files are in no time order
    path = work_dir(spark, "ingest")
    write_messages(spark, d, f"{path}/all")
    every = spark.read.schema(msgs.RAW).json(f"{path}/all")
    for lo, hi in zip(EDGES, EDGES[1:]):
        every.where((F.col("sent_at") >= lo) & (F.col("sent_at") < hi)).write.mode("append").json(f"{path}/in")
        msgs.run_once(msgs.accepted(msgs.message_stream(spark, f"{path}/in", files_per_batch=None)), f"{path}/out", f"{path}/ckpt")
    return spark.read.parquet(f"{path}/out").select("msg_id", "date", "prediction", F.round("confidence", 6).alias("confidence"))


EDGES = ("1900-01-01", "1998-01-01", "2000-01-01", "2100-01-01")


def signals(spark, d):
    """One signal per scored date: direction, spread and, as prices, both 21-row mean closes."""
    z = sliding(b.spread(spark, d, keep_ordinal=True), PAIR, 21, lambda x, w: R.add(
        x, w, *[R.moving_avg(F.col(f"close_{leg}"), f"mean_{leg}") for leg in ("eth", "btc")])).where(F.col(Z).isNotNull())
    return z.select(
        F.lit("main").alias("account"), F.col("date").cast("timestamp").alias("ts"), F.concat(F.lit("m-"), F.col("date").cast("string")).alias("msg_id"),
        F.when(F.col(Z) > 0, 1).otherwise(0).alias("prediction"), F.col(Z).alias("message_spread"), F.col(Z).alias("spread"),
        F.col("mean_eth").alias("price_eth"), F.col("mean_btc").alias("price_btc"))


def priced_dates(spark, d):
    """What a message is traded on: the closes and the score of its date, next to the score before, which the message carries."""
    def before(x, w):
        return x.withColumn("message_spread", F.lag(Z).over(w))
    z = sliding(b.spread(spark, d, keep_ordinal=True), PAIR, 1, before).where(F.col("message_spread").isNotNull())
    return z.select("date", "message_spread", F.col(Z).alias("spread"), F.col("close_eth").alias("price_eth"), F.col("close_btc").alias("price_btc"))


def order_messages(spark, d, priced):
    """One message per order of a customer, each third one sent twice."""
    from pairloom.operators.tables import prediction_messages
    o = b.table(spark, d, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"), F.col("o_custkey").cast("string").alias("account"), "o_orderkey")
    sent = o.join(priced, "date").withColumns({
        "direction": F.when(F.col("message_spread") > 0, 1).otherwise(0), "confidence": F.abs("message_spread") / (1 + F.abs("message_spread")),
        "mu": F.lit(0.0), "std": F.lit(1.0)})
    bodies = prediction_messages(sent.select("date", "direction", "confidence", "mu", "std", F.col("message_spread").alias("spread"))).distinct()
    seconds = F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    return sent.select("date", "account", "o_orderkey").join(bodies, "date").select(
        F.concat(F.lit("o-"), F.col("o_orderkey").cast("string")).alias("msg_id"), (F.col("date").cast("timestamp") + seconds).alias("sent_at"),
        "account", "body", F.explode(F.sequence(F.lit(1), F.when(F.col("o_orderkey") % 3 == 0, 2).otherwise(1))).alias("_c")).drop("_c")


#: how late a message can be: longer than a period, whose files are in no time order
DELAY = "1300 days"


def play_messages(spark, d, path, out="", foreach=None):
    """Messages to positions: read, parse, drop copies, add prices, play each account in event time. They come in three periods; after
    each one the stream goes on from its checkpoint. At the end a message of another account, long after, moves the watermark."""
    priced = training.materialise(priced_dates(spark, d), "priced")
    sent = training.materialise(order_messages(spark, d, priced), "messages")
    known = priced.select(F.col("date").cast("string").alias("date"), "spread", "price_eth", "price_btc")
    clock = sent.limit(1).select(
        F.lit("clock").alias("msg_id"), F.lit("2200-01-01").cast("timestamp").alias("sent_at"), F.lit("clock").alias("account"), "body")
    parts = [sent.where((F.col("sent_at") >= lo) & (F.col("sent_at") < hi)) for lo, hi in zip(EDGES, EDGES[1:])]
    for part in [*parts, clock]:
        part.write.mode("append").json(f"{path}/in")
        clean = msgs.accepted(msgs.message_stream(spark, f"{path}/in"), DELAY)
        signal = clean.join(known, "date").select(
            "account", F.col("sent_at").alias("ts"), "msg_id", "prediction", "message_spread", "spread", "price_eth", "price_btc")
        msgs.run_once(ledger.ledger_in_event_time(signal), out, f"{path}/ckpt", foreach=foreach)


# one recursion step plays the next message of every account
ORDER_LEDGER = f"""WITH RECURSIVE {SPREAD_SQL},
px AS (SELECT date, lag(z) OVER (ORDER BY date) AS ms, z AS sp, close_eth AS pe, close_btc AS pb FROM zs),
sig AS (SELECT CAST(o_custkey AS VARCHAR) AS account, 'o-' || CAST(o_orderkey AS VARCHAR) AS msg_id, px.date,
               CAST(px.date AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS ts, CASE WHEN ms > 0 THEN 'ETH-USD' ELSE 'BTC-USD' END AS leg, ms, sp, pe, pb
        FROM orders JOIN px ON px.date = CAST(o_orderdate AS DATE) WHERE ms IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY ts, msg_id) AS k FROM sig),
led AS (SELECT DISTINCT account, CAST(0 AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS sym, CAST(0 AS DOUBLE) AS amount, CAST(10000 AS DOUBLE) AS bal,
               0 AS days, CAST(0 AS DOUBLE) AS os, '' AS action FROM s
  UNION ALL
  SELECT account, k, CASE WHEN enters THEN leg ELSE sym END,
         CASE WHEN enters THEN bal1 * CAST(0.1 AS DOUBLE) / CASE WHEN leg = 'ETH-USD' THEN pe ELSE pb END ELSE amount END,
         CASE WHEN enters THEN bal1 - bal1 * CAST(0.1 AS DOUBLE) ELSE bal END, CASE WHEN enters THEN 0 ELSE days + 1 END,
         CASE WHEN enters THEN sp ELSE os END, CASE WHEN closed THEN 'reopen' WHEN enters THEN 'open' ELSE 'hold' END
  FROM (SELECT *, sym IS NULL OR closed AS enters, CASE WHEN closed THEN bal + amount * CASE WHEN sym = 'ETH-USD' THEN pe ELSE pb END ELSE bal END AS bal1 FROM (
        SELECT s.*, l.sym, l.amount, l.bal, l.days, l.os,
               l.sym IS NOT NULL AND (l.days + 1 >= 2 OR s.sp >= s.ms * (1 + 0.662016) OR s.sp <= s.ms * (1 - 0.220194)) AS closed
        FROM led l JOIN s ON s.account = l.account AND s.k = l.k + 1)))
"""


def ledger_sql(basis: str, upper: float, lower: float, reenter: bool, account: str = "main") -> str:
    """The ledger as a row-after-row recursion."""
    level = "s.z" if basis == "message" else "l.os"
    price = "CASE WHEN sym = 'ETH-USD' THEN pe ELSE pb END"
    new_price = "CASE WHEN leg = 'ETH-USD' THEN pe ELSE pb END"
    enters = "flat" if reenter else "(flat AND NOT closed)"
    return f"""
sig_{account} AS (SELECT row_number() OVER (ORDER BY date) AS k, date, z, CASE WHEN z > 0 THEN 'ETH-USD' ELSE 'BTC-USD' END AS leg,
         pe, pb FROM (SELECT *, avg(close_eth) OVER w AS pe, avg(close_btc) OVER w AS pb FROM zs
         WINDOW w AS (ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)) WHERE z IS NOT NULL),
led_{account} AS (SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS sym, CAST(0 AS DOUBLE) AS amount, CAST(0 AS DOUBLE) AS pv,
         CAST(10000 AS DOUBLE) AS bal, 0 AS days, CAST(0 AS DOUBLE) AS os, '' AS action
  UNION ALL
  SELECT k, CASE WHEN enters THEN leg WHEN closed THEN NULL ELSE sym END,
         CASE WHEN enters THEN bal1 * CAST(0.1 AS DOUBLE) / {new_price} WHEN closed THEN 0 ELSE amount END,
         CASE WHEN enters THEN bal1 * CAST(0.1 AS DOUBLE) WHEN closed THEN 0 ELSE pv END,
         CASE WHEN enters THEN bal1 - bal1 * CAST(0.1 AS DOUBLE) ELSE bal1 END,
         CASE WHEN enters OR closed THEN 0 ELSE days1 END, CASE WHEN enters THEN z WHEN closed THEN 0 ELSE os END,
         CASE WHEN enters AND closed THEN 'reopen' WHEN enters THEN 'open' WHEN closed THEN 'close' ELSE 'hold' END
  FROM (SELECT *, {enters} AS enters, CASE WHEN closed THEN bal + amount * {price} ELSE bal END AS bal1 FROM (
        SELECT *, sym IS NULL OR closed AS flat FROM (
        SELECT s.k, l.sym, l.amount, l.pv, l.bal, l.os, s.z, s.leg, s.pe, s.pb, CASE WHEN l.sym IS NULL THEN 0 ELSE l.days + 1 END AS days1,
               l.sym IS NOT NULL AND (l.days + 1 >= 2 OR s.z >= {level} * (1 + {upper})
               OR s.z <= {level} * (1 - {lower})) AS closed
        FROM led_{account} l JOIN sig_{account} s ON s.k = l.k + 1))))
"""


LEDGER_COLS = """'m-' || CAST(date AS VARCHAR) AS msg_id, action, sym AS symbol, round(amount, 3) AS amount, round(bal, 2) AS account_balance,
       days AS days_in_trade, round(os, 6) AS trade_open_spread"""


def ledger_select(df, *more):
    return df.select(*more, "msg_id", "action", "symbol", b.r("amount", 3), b.r("account_balance", 2), "days_in_trade", b.r("trade_open_spread"))


@query("i2_position_ledger", f"""{ORDER_LEDGER}
SELECT account, msg_id, action, sym AS symbol, round(amount, 3) AS amount, round(bal, 2) AS account_balance, days AS days_in_trade,
       round(os, 6) AS trade_open_spread FROM led JOIN s USING (account, k)""")
def i2(spark, d):
    # one state per account lives in the state store across micro-batches
    path = work_dir(spark, "ledger")
    play_messages(spark, d, path, out=f"{path}/out")
    return ledger_select(spark.read.parquet(f"{path}/out"), "account")


@query("i3_ledger_outputs", f"""{ORDER_LEDGER}
SELECT msg_id, date, strftime(ts, '%H:%M:%S') AS time, sym AS symbol, 'USD' AS currency, CAST(CAST(amount AS DECIMAL(38, 5)) AS DOUBLE) AS position_size,
       round(bal, 2) AS account_balance, account AS account_id FROM led JOIN s USING (account, k)""")
def i3(spark, d):
    path = work_dir(spark, "ledger")
    play_messages(spark, d, path, foreach=ledger.write_ledger(f"{path}/out", run="first"))
    p, bal = (ledger.read_ledger(spark, f"{path}/out", name) for name in ledger.TABLES)
    both = p.join(bal.select("msg_id", "account_balance"), "msg_id")
    return both.select("msg_id", "date", "time", "symbol", "currency", F.col("position_size").cast("double").alias("position_size"),
                       b.r("account_balance", 2), "account_id")


# The barrier margins of the two rule sets.
RULES = {"tight": ledger.LedgerRules(0.173043, 0.117092, barrier_basis="open", reenter_same_step=False),
         "wide": ledger.LedgerRules(0.662016, 0.220194, barrier_basis="open")}


@query("i4_ledger_replay", f"""WITH RECURSIVE {SPREAD_SQL}, {ledger_sql('open', 0.173043, 0.117092, False, 'tight')},
{ledger_sql('open', 0.662016, 0.220194, True, 'wide')}
SELECT 'tight' AS account, {LEDGER_COLS} FROM led_tight JOIN sig_tight USING (k)
UNION ALL SELECT 'wide', {LEDGER_COLS} FROM led_wide JOIN sig_wide USING (k)""")
def i4(spark, d):
    # two rule sets replayed over the whole history, in chunks of a few hundred signals, which are built once
    base, out = training.materialise(signals(spark, d), "signals"), None
    for name, rules in RULES.items():
        part = ledger.replay(base.withColumn("account", F.lit(name)), rules, chunk_rows=512)
        out = part if out is None else out.unionByName(part)
    return ledger_select(out, "account")


CUT = "2001-09-30"


@query("i5_incremental_features", f"""WITH {BARS},
x AS (SELECT symbol, date, avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS m21,
             close - lag(close) OVER (PARTITION BY symbol ORDER BY date) AS close_change FROM bars)
SELECT symbol, date, round(m21, 6) AS m21, close_change FROM x WHERE date > DATE '{CUT}'""")
def i5(spark, d):
    # bars up to a date are stored; the later ones arrive as a stream of files
    path = work_dir(spark, "incremental")
    bars = b.bars(spark, d)
    bars.where(F.col("date") <= CUT).write.mode("overwrite").parquet(f"{path}/bars/batch_id=-1")
    later = bars.where(F.col("date") > CUT)
    later.write.mode("overwrite").parquet(f"{path}/in")

    def compute(df):
        return sliding(df, BAR_SERIES, 21, lambda x, w: R.add(
            x.withColumn("close_change", R.change(F.col("close"), w)), w, R.moving_avg(F.col("close"), "m21")))

    stream = spark.readStream.schema(later.schema).parquet(f"{path}/in")
    def stored_from(day):
        return incremental.latest_rows(spark.read.parquet(f"{path}/bars").where(F.col("date") >= day))

    sink = incremental.refresh_sink(stored_from, compute, f"{path}/bars", f"{path}/features")
    msgs.run_once(stream, "", f"{path}/ckpt", foreach=sink)
    out = incremental.latest_rows(spark.read.parquet(f"{path}/features"))
    return out.select("symbol", "date", b.r("m21"), "close_change")


# --- L ----------------------------------------------------------------------------------------

FACTS = BARS + ", " + DATES + """,
facts AS (SELECT date_code, date, symbol, open, high, low, close, volume, close * volume AS dollar_volume, close - lag(close) OVER w AS close_change,
       CAST(sign(close - lag(close) OVER w) AS DOUBLE) AS close_direction, avg(close) OVER (w ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS dollar_volume1m,
       high - low AS range, CASE WHEN lag(close) OVER w IS NOT NULL THEN greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) END AS true_range,
       sum((high + low + close) / 3 * volume) OVER w / sum(volume) OVER w AS vwap
FROM bars JOIN dates USING (date) WINDOW w AS (PARTITION BY symbol ORDER BY date))
"""


def facts(spark, d):
    return marts.fact_ohlc(marts.stage_bars(b.assets(spark, d), RUN_TS), b.dates(spark, d), BAR_SERIES.with_(keys=("symbol_code",)))


@query("l1_fact_ohlc", f"""WITH {FACTS}
SELECT symbol AS symbol_code, date_code, open, high, low, close, close AS adjusted_close, volume, 'CCC' AS exchange_code, 'USD' AS currency_code,
       dollar_volume, close_change, close_direction, round(dollar_volume1m, 6) AS dollar_volume1m, range, true_range, round(vwap, 4) AS vwap,
       CAST(NULL AS INTEGER) AS prediction, CAST(NULL AS INTEGER) AS actual, CAST(NULL AS VARCHAR) AS model_id FROM facts""")
def l1(spark, d):
    out = marts.mart_ohlc(facts(spark, d))
    return out.withColumns({"dollar_volume1m": F.round("dollar_volume1m", 6), "vwap": F.round("vwap", 4)})


@query("l2_fact_position", f"""WITH {BARS}, {DATES}, {POSITIONS},
v AS (SELECT account_id, positions.symbol, date_code, positions.date, time, currency, position_size, trade_open_spread, position_size * close AS value
      FROM positions JOIN dates ON positions.date = dates.date LEFT JOIN bars ON bars.symbol = positions.symbol AND bars.date = positions.date),
p AS (SELECT *, lag(value) OVER (PARTITION BY account_id, symbol ORDER BY date, time) AS prev FROM v)
SELECT {key_sql('date', 'time', 'symbol')} AS position_hkey, date_code, time, symbol AS symbol_code, currency AS currency_code, position_size,
       trade_open_spread, account_id, value AS position_value, prev AS previous_position_val,
       value / NULLIF(prev, 0) - 1 AS position_value_daily_pct_change FROM p""")
def l2(spark, d):
    return fact_position(spark, d).drop("position_hdiff")


@query("l3_fact_predictions", f"""WITH {PREDICTIONS}, {DATES}
SELECT date_code, prediction, round(confidence, 6) AS confidence, actual, model_id FROM predictions JOIN dates USING (date) WHERE prediction IS NOT NULL""")
def l3(spark, d):
    out = marts.fact_predictions(marts.stage_predictions(b.predictions(spark, d), RUN_TS), b.dates(spark, d))
    return out.withColumn("confidence", F.round("confidence", 6))


@query("l4_dim_symbol", f"""WITH {SNAPSHOT}
SELECT symbol_code, p_brand AS exchange_code, security_name, p_type AS sector, CAST(size AS VARCHAR) AS industry, 'PART' AS asset_type
FROM snap JOIN part ON CAST(p_partkey AS VARCHAR) = symbol_code WHERE valid_to IS NULL""")
def l4(spark, d):
    return marts.dim_symbol(two_snapshots(spark, d))


# the stored facts hold the change of each symbol's own bars, also on dates only one leg has
FACT_CHANGES = """chg AS (SELECT zs.date, zs.o, e.cc AS ce, n.cc AS cb FROM zs
  JOIN (SELECT date, close - lag(close) OVER (ORDER BY date) AS cc FROM bars WHERE symbol = 'A') e ON e.date = zs.date
  JOIN (SELECT date, close - lag(close) OVER (ORDER BY date) AS cc FROM bars WHERE symbol = 'N') n ON n.date = zs.date),"""


@query("l5_feature_row", f"WITH {NUMBERED_PAIR.replace(PAIR_CHANGES, FACT_CHANGES)} SELECT {FEATURE_SELECT} FROM feats")
def l5(spark, d):
    # facts of all days as a stored table, the strict 45-column table, read back as the model input
    path = work_dir(spark, "features")
    frame = feats.feature_frame(training.materialise(facts(spark, d), "facts"), b.dates(spark, d), LEGS, n_days=0)
    feats.feature_table(frame).write.mode("overwrite").parquet(f"{path}/features")
    return feature_select(feats.read_features(spark.read.parquet(f"{path}/features")))


@query("l5_feature_vector_latest")
def l5_latest(spark, d):
    frame = feats.feature_frame(training.materialise(facts(spark, d), "facts"), b.dates(spark, d), LEGS, n_days=150)
    return feats.latest_vector(feats.read_features(feats.feature_table(frame)))


def feature_rows(spark, d):
    """The stored feature table of all days, read back as model inputs, with the key of the pair."""
    path = work_dir(spark, "features")
    frame = feats.feature_frame(training.materialise(facts(spark, d), "facts"), b.dates(spark, d), LEGS, n_days=0)
    feats.feature_table(frame).write.mode("overwrite").parquet(f"{path}/features")
    rows = feats.read_features(spark.read.parquet(f"{path}/features"))
    return rows.withColumn("pair", F.lit("btc-eth"))


def leg_sql(leg: str, symbol: str) -> str:
    return f"""{leg} AS (SELECT date, open, high, low, close, volume, close * volume AS dv, avg(close) OVER (ORDER BY date ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS dv1m,
       close - lag(close) OVER (ORDER BY date) AS cc FROM bars WHERE symbol = '{symbol}')"""


@query("c15_feature_projection", f"""WITH {NUMBERED_PAIR.replace(PAIR_CHANGES, FACT_CHANGES)}, {leg_sql('e', 'A')}, {leg_sql('n', 'N')}
SELECT date, round(mu, 6) AS mu, round(std, 6) AS std, round(z, 6) AS spread, [round(CAST(x AS DOUBLE), 3) FOR x IN [e.open, e.high, e.close, e.close, e.low, e.volume, e.dv, e.dv1m, e.cc, sign(e.cc),
       n.open, n.high, n.close, n.close, n.low, n.volume, n.dv, n.dv1m, n.cc, sign(n.cc), mu, std, z, ent_eth, ent_btc, roll_eth, roll_btc,
       coint, coint, ma_5, ma_20, vwap_btc, vwap_eth, ma_upper_co, ma_lower_co, rsi, atr_btc, atr_eth]] AS x
FROM feats JOIN e USING (date) JOIN n USING (date) ORDER BY date DESC LIMIT 1""")
def c15(spark, d):
    out = feats.latest_vector(feature_rows(spark, d))
    return out.select("date", b.r("mu"), b.r("std"), b.r("spread"), F.transform("x", lambda v: F.round(v, 3)).alias("x"))


TRAINING = NUMBERED_PAIR + """,
tb AS (SELECT a.date, a.z, f.date AS ts, abs(f.z) AS v FROM zs a LEFT JOIN zs f ON f.date > a.date AND f.date <= a.date + 2
       AND (abs(f.z) >= abs(a.z) * (1 + 0.662016) OR abs(f.z) <= abs(a.z) * (1 - 0.220194)) WHERE a.z IS NOT NULL),
lab AS (SELECT date, CASE WHEN ts IS NULL THEN 0 WHEN v >= abs(z) * (1 + 0.662016) THEN 1 ELSE -1 END AS label, coalesce(ts, CAST(date + 2 AS DATE)) AS t1
        FROM tb QUALIFY row_number() OVER (PARTITION BY date ORDER BY ts) = 1)
"""


@query("l6_labelled_training_set", f"""WITH {TRAINING}
SELECT {FEATURE_SELECT}, label, t1 FROM feats JOIN lab USING (date)
WHERE date <= DATE '2000-07-31' AND z IS NOT NULL AND ma_20 IS NOT NULL AND rsi IS NOT NULL AND coint IS NOT NULL AND ent_eth IS NOT NULL""")
def l6(spark, d):
    out = training.labelled_set(b.pair(spark, d), PAIR, until="2000-07-31")
    return feature_select(out, "label", "t1")


@query("l7_cv_report")
def l7(spark, d):
    labelled = training.materialise(training.labelled_features(feature_rows(spark, d)), "labelled")
    return training.cross_validate(labelled, PAIR, k=3, embargo=0.01, inputs=schemas.MODEL_FEATURES)


# Settings of the search and the numbers of trees of its rungs.
SETTINGS, RUNGS = ({"depth": 2}, {"depth": 4}, {"depth": 2, "scaling": False}, {"depth": 3}), (1, 3)


@query("h16_grid_search")
def h16_grid(spark, d):
    labelled = training.materialise(training.labelled_features(feature_rows(spark, d)), "labelled")
    return training.grid_search(labelled, SETTINGS, RUNGS, PAIR, k=2, inputs=schemas.MODEL_FEATURES, use_regimes=False)


# means by symbol in closed form: sums over all earlier rows
SYMBOL_MEANS = """
nb AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS o, close - lag(close) OVER (PARTITION BY symbol ORDER BY date) AS ch FROM bars),
es AS (SELECT t.symbol, t.date, t.o, sum(CASE WHEN i.o = 0 THEN 1 ELSE 2.0 / 6 END * power(1 - 2.0 / 6, t.o - i.o) * i.close) AS e5,
              sum(CASE WHEN i.o = 0 THEN 1 ELSE 2.0 / 21 END * power(1 - 2.0 / 21, t.o - i.o) * i.close) AS e20,
              sum(1.0 / 14 * power(13.0 / 14, t.o - i.o) * greatest(i.ch, 0)) AS u, sum(1.0 / 14 * power(13.0 / 14, t.o - i.o) * greatest(-i.ch, 0)) AS n
       FROM nb t JOIN nb i ON i.symbol = t.symbol AND i.o <= t.o GROUP BY ALL)
"""


@query("i5_carried_features", f"""WITH {BARS}, {SYMBOL_MEANS}, {atr_sql('nb', 'symbol', 'high', 'low', 'close', 'b')},
vw AS (SELECT symbol, date, sum((high + low + close) / 3 * volume) OVER w / sum(volume) OVER w AS vwap FROM bars
       WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING))
SELECT es.symbol, es.date, round(CASE WHEN es.o >= 4 THEN e5 END, 5) AS ma_5, round(CASE WHEN es.o >= 19 THEN e20 END, 5) AS ma_20,
       round(CASE WHEN es.o >= 13 THEN CASE WHEN n = 0 THEN 100 ELSE 100 - 100 / (1 + u / n) END END, 5) AS rsi, round(atr, 3) AS atr, round(vwap, 5) AS vwap
FROM es JOIN atr_b ON k = es.symbol AND atr_b.date = es.date JOIN vw ON vw.symbol = es.symbol AND vw.date = es.date""")
def i5_carried(spark, d):
    # all bars as three batches of a stream; recursive features go on from the carries of the batch before
    path = work_dir(spark, "carried")
    bars = training.materialise(b.bars(spark, d), "bars")
    sink = carried.carry_sink(spark, f"{path}/out", BAR_SERIES, {"ma_5": ("close", 5), "ma_20": ("close", 20)})
    for lo, hi in zip(EDGES, EDGES[1:]):
        bars.where((F.col("date") >= lo) & (F.col("date") < hi)).write.mode("append").parquet(f"{path}/in")
        msgs.run_once(spark.readStream.schema(bars.schema).parquet(f"{path}/in"), "", f"{path}/ckpt", foreach=sink)
    out = spark.read.parquet(f"{path}/out/features")
    return out.select("symbol", "date", b.r("ma_5", 5), b.r("ma_20", 5), b.r("rsi", 5), b.r("atr", 3), b.r("vwap", 5))


# Two versions of a linear scorer.
VERSIONS = [scoring.LinearModel("v1", 0.1, {"standardized_spread": 0.8, "spread": -0.01}),
            scoring.LinearModel("v2", -0.2, {"standardized_spread": 1.5, "mu": 0.02})]


@query("h15_score_stream", f"""WITH {SPREAD_SQL},
f AS (SELECT date, spread, mu, z, date < DATE '1998-01-01' AND year(date) <> 1996 AS early, CASE WHEN year(date) = 1996 THEN 2 ELSE 1 END AS n FROM zs WHERE z IS NOT NULL),
p AS (SELECT date, early, n, 1 / (1 + exp(-CASE WHEN early THEN 0.1 + 0.8 * z - 0.01 * spread ELSE -0.2 + 1.5 * z + 0.02 * mu END)) AS p FROM f)
SELECT date, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS prediction, round(greatest(p, 1 - p), 6) AS confidence, CASE WHEN early THEN 'v1' ELSE 'v2' END AS model_id,
       CAST(n AS BIGINT) AS n_messages FROM p""")
def h15_stream(spark, d):
    # features arrive in three periods; the second version is published after the first, and the last period sends a year again
    path = work_dir(spark, "scores")
    rows = training.materialise(b.spread(spark, d).where(F.col(Z).isNotNull()).select("date", "mu", "std", "spread", Z), "scorable")
    sink = scoring.score_sink(spark, f"{path}/out", f"{path}/models")
    for k, (lo, hi) in enumerate(zip(EDGES, EDGES[1:])):
        if k < len(VERSIONS):
            scoring.publish_model(spark, f"{path}/models", VERSIONS[k], f"2024-01-0{k + 1}")
        again = F.year("date") == 1996 if k == 2 else F.lit(False)
        rows.where(((F.col("date") >= lo) & (F.col("date") < hi)) | again).write.mode("append").parquet(f"{path}/in")
        msgs.run_once(spark.readStream.schema(rows.schema).parquet(f"{path}/in"), "", f"{path}/ckpt", foreach=sink)
    sent = published.read_published(spark, f"{path}/out", "messages")
    n = sent.select(F.from_json("body", schemas.MESSAGE)["date"].cast("date").alias("date")).groupBy("date").agg(F.count(F.lit(1)).alias("n_messages"))
    return scoring.current_predictions(spark, f"{path}/out").join(n, "date").select("date", "prediction", b.r("confidence"), "model_id", "n_messages")
