"""Section A: scans and sources."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom import schemas
from pairloom.catalog import base as b
from pairloom.catalog.base import BARS, DATES, POSITIONS, PREDICTIONS, RUN_TS, SPREAD_SQL, query
from pairloom.functions.columns import packed
from pairloom.plans import marts
from pairloom.plans.features import read_features
from pairloom.sources import bars as src
from pairloom.sources import files
from pairloom.session import work_dir
from pairloom.streaming import predictions as msgs

COLS = "symbol, date, open, high, low, close, volume"


@query("a1_bars_source", f"WITH {BARS} SELECT {COLS} FROM bars WHERE date >= DATE '1998-01-01'")
def a1(spark, d):
    # bars stored as a table, then read back with a declared schema and a pushed date filter
    path = work_dir(spark, "bars")
    stored = b.bars(spark, d).withColumn("adj_close", F.col("close"))
    stored.select(*schemas.BAR.names).write.mode("overwrite").parquet(f"{path}/bars")
    return src.read_bars(spark, f"{path}/bars", "1998-01-01").select(*COLS.split(", "))


@query("a2_bars_from_ticks", """
SELECT event_type AS symbol, date_trunc('hour', ts) AS ts, first(value ORDER BY ts, event_id) AS open, max(value) AS high,
       min(value) AS low, last(value ORDER BY ts, event_id) AS close, CAST(count(*) AS BIGINT) AS volume
FROM events GROUP BY event_type, date_trunc('hour', ts)""")
def a2(spark, d):
    return src.bars_from_ticks(b.table(spark, d, "events"), "event_type", F.col("ts"), F.col("value"),
                               F.lit(1).cast("long"), [packed((F.unix_micros(F.col("ts").cast("timestamp")), 17), (F.col("event_id"), 18))],
                               interval="hour")


@query("a3_high_water_mark", f"WITH {BARS} SELECT symbol, max(date) AS latest FROM bars GROUP BY symbol")
def a3(spark, d):
    return src.high_water(b.bars(spark, d))


@query("a4_incremental_extract", f"""WITH {BARS},
marks AS (SELECT symbol, max(date) AS latest FROM bars WHERE date <= DATE '2001-06-30' GROUP BY symbol)
SELECT {COLS} FROM bars JOIN marks USING (symbol)
WHERE date > latest OR (date = latest AND latest = DATE '2001-06-30')""")
def a4(spark, d):
    df = b.bars(spark, d)
    return src.after_high_water(df, df.where("date <= '2001-06-30'"), "2001-06-30").select(*COLS.split(", "))


@query("a5_drop_open_bar", f"""WITH {BARS}
SELECT {COLS} FROM bars QUALIFY date < max(date) OVER (PARTITION BY symbol)""")
def a5(spark, d):
    return src.drop_open_bar(b.bars(spark, d)).select(*COLS.split(", "))


@query("a6_multi_symbol_extract", f"""WITH {BARS},
info AS (SELECT DISTINCT l_returnflag AS symbol, 'USD' AS currency, 'X' || l_returnflag AS exchange FROM lineitem)
SELECT {COLS}, currency, exchange, CAST(NULL AS DOUBLE) AS actual, CAST(NULL AS DOUBLE) AS prediction
FROM bars LEFT JOIN info USING (symbol)""")
def a6(spark, d):
    info = b.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("symbol")).distinct().select(
        "symbol", F.lit("USD").alias("currency"), F.concat(F.lit("X"), "symbol").alias("exchange"))
    return src.with_symbol_info(b.bars(spark, d), info).select(
        *COLS.split(", "), "currency", "exchange", "actual", "prediction")


@query("a7_csv_copy_into", """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol, CAST(o_orderkey AS DOUBLE) AS size
FROM orders WHERE o_orderpriority <> '5-LOW'""")
def a7(spark, d):
    # one CSV folder per priority; the dates of one priority cannot be read, so its files are skipped
    path = work_dir(spark, "copy")
    o = b.table(spark, d, "orders")
    unreadable = F.col("o_orderpriority") == "5-LOW"
    rows = o.select(
        F.when(unreadable, "n/a").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("date"),
        F.col("o_orderpriority").alias("symbol"), F.col("o_orderkey").cast("double").alias("size"),
        F.col("o_orderpriority").alias("part"))
    rows.write.mode("overwrite").option("header", True).partitionBy("part").csv(f"{path}/copy")
    schema = T.StructType.fromDDL("date date, symbol string, size double")
    return files.copy_csv(spark, f"{path}/copy/*", schema)


@query("a8_seed_load", f"""
SELECT CAST(p_partkey AS VARCHAR) AS symbol, p_brand AS exchange, p_name AS name, p_type AS sector, p_type AS industry,
       'PART' AS asset_type, TIMESTAMP '{RUN_TS}' AS load_ts FROM part""")
def a8(spark, d):
    path = work_dir(spark, "seed")
    p = b.table(spark, d, "part")
    seed = p.select(F.col("p_partkey").cast("string").alias("symbol"), F.col("p_brand").alias("exchange"),
                    F.col("p_name").alias("name"), F.col("p_type").alias("sector"), F.col("p_type").alias("industry"),
                    F.lit("PART").alias("asset_type"), F.lit(None).cast("string").alias("load_ts"))
    seed.write.mode("overwrite").option("header", True).csv(f"{path}/seed")
    return files.load_seed(spark, f"{path}/seed", schemas.SYMBOL_INFO, RUN_TS)


@query("a9_date_dim", f"WITH {DATES} SELECT date_code, date, year, month, day FROM dates")
def a9(spark, d):
    return b.dates(spark, d)


@query("a10_lookback_extract", f"""WITH {BARS}, {DATES},
facts AS (SELECT bars.*, date_code, year, month, day FROM bars JOIN dates USING (date))
SELECT symbol, date_code, open, high, low, close, volume, year, month, day FROM facts
WHERE date_code >= (SELECT max(date_code) FROM facts) - 150""")
def a10(spark, d):
    dim = b.dates(spark, d)
    facts = marts.to_date_code(b.bars(spark, d), dim).drop("date")
    return src.lookback(facts, dim, 150)


@query("a11_symbol_names", "SELECT CAST(p_partkey AS VARCHAR) AS symbol_code, p_name AS security_name FROM part")
def a11(spark, d):
    p = b.table(spark, d, "part")
    return p.select(F.col("p_partkey").cast("string").alias("symbol_code"), F.col("p_name").alias("security_name"))


@query("a12_features_scan", f"""WITH {SPREAD_SQL}
SELECT CAST(date AS VARCHAR) AS date, round(spread, 6) AS spread, round(mu, 6) AS mu, round(std, 6) AS std,
       round(z, 6) AS standardized_spread, volume_eth, volume_btc FROM zs""")
def a12(spark, d):
    stored = b.spread(spark, d).select(
        F.col("date").cast("string").alias("DATE"), F.col("spread").alias("SPREAD"), F.col("mu").alias("MU"),
        F.col("std").alias("STD"), F.col("standardized_spread").alias("STANDARDIZED_SPREAD"),
        F.col("volume_eth").cast("long").alias("VOLUME_ETH"), F.col("volume_btc").cast("long").alias("VOLUME_BTC"))
    out = read_features(stored)
    return out.select("date", b.r("spread"), b.r("mu"), b.r("std"), b.r("standardized_spread"), "volume_eth", "volume_btc")


@query("a13_latest_prediction", f"""WITH {PREDICTIONS}
SELECT date, prediction, round(confidence, 6) AS confidence, model_id FROM predictions
WHERE prediction IS NOT NULL ORDER BY date DESC LIMIT 1""")
def a13(spark, d):
    dim = b.dates(spark, d)
    facts = marts.fact_predictions(marts.stage_predictions(b.predictions(spark, d), RUN_TS), dim)
    dated = facts.join(F.broadcast(dim.select("date_code", "year", "month", "day")), "date_code").withColumn(
        "date", F.make_date("year", "month", "day"))
    row = F.struct("date", "prediction", "confidence", "model_id")
    return dated.agg(F.max_by(row, "date").alias("r")).select("r.date", "r.prediction",
                                                              F.round("r.confidence", 6).alias("confidence"), "r.model_id")


@query("a14_current_position", f"""WITH {POSITIONS}, {DATES}
SELECT symbol, currency, position_size, trade_open_spread, account_id, date FROM positions JOIN dates USING (date)
QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY date DESC, time DESC, position_size DESC) = 1""")
def a14(spark, d):
    p = marts.to_date_code(b.positions(spark, d), b.dates(spark, d))
    row = F.struct("symbol", "currency", "position_size", "trade_open_spread", "date")
    return p.groupBy("account_id").agg(F.max_by(row, F.struct("date", "time", "position_size")).alias("r")).select(
        "r.*", "account_id")


@query("a15_chunked_backfill", f"""WITH {BARS},
chunks AS (SELECT n AS chunk_no, CAST(DATE '1995-01-01' + to_months(CAST(9 * n AS INTEGER)) AS DATE) AS lo,
                  CAST(DATE '1995-01-01' + to_months(CAST(9 * (n + 1) AS INTEGER)) AS DATE) AS hi FROM range(0, 10) t(n))
SELECT {COLS}, CAST(chunk_no AS INTEGER) AS chunk_no FROM bars JOIN chunks ON date BETWEEN lo AND hi
WHERE date <= DATE '2001-10-31' QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY chunk_no) = 1""")
def a15(spark, d):
    # the span is no multiple of nine months: the last range is shorter
    out = src.chunked_backfill(b.bars(spark, d), "1995-01-01", "2001-10-31", 9)
    return out.select(*COLS.split(", "), "chunk_no")


@query("a15_chunked_backfill_whole_ranges", f"""WITH {BARS},
chunks AS (SELECT n AS chunk_no, CAST(DATE '1995-01-01' + to_months(CAST(9 * n AS INTEGER)) AS DATE) AS lo,
                  CAST(DATE '1995-01-01' + to_months(CAST(9 * (n + 1) AS INTEGER)) AS DATE) AS hi FROM range(0, 10) t(n))
SELECT {COLS}, CAST(chunk_no AS INTEGER) AS chunk_no FROM bars JOIN chunks ON date BETWEEN lo AND hi
WHERE hi <= DATE '2001-10-31' QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY chunk_no) = 1""")
def a15_whole(spark, d):
    out = src.chunked_backfill(b.bars(spark, d), "1995-01-01", "2001-10-31", 9, whole_ranges_only=True)
    return out.select(*COLS.split(", "), "chunk_no")


@query("a16_csv_series_read", f"WITH {BARS} SELECT symbol, date, floor(close * 10000) AS close_e4 FROM bars")
def a16(spark, d):
    path = work_dir(spark, "series")
    b.bars(spark, d).select("date", F.floor(F.col("close") * 10000).cast("double").alias("close_e4"), "symbol").write.mode(
        "overwrite").option("header", True).csv(f"{path}/series")
    schema = "date date, close_e4 double, symbol string"
    return files.read_series(spark, f"{path}/series", schema)


def write_messages(spark, d, path):
    """Prediction messages as JSON lines: one per scored date, each third one sent twice, and
    after every seventh a message that is no JSON."""
    from pairloom.operators.tables import prediction_messages
    z = b.spread(spark, d).where("standardized_spread IS NOT NULL").select(
        "date", F.when(F.col("standardized_spread") > 0, 1).otherwise(0).alias("direction"),
        (F.abs("standardized_spread") / (1 + F.abs("standardized_spread"))).alias("confidence"), "mu", "std",
        F.col("standardized_spread").alias("spread"))
    m = prediction_messages(z).select(
        F.concat(F.lit("m-"), F.col("date").cast("string")).alias("msg_id"), F.col("date").cast("timestamp").alias("sent_at"),
        F.lit("main").alias("account"), "body", F.dayofyear("date").alias("_n"))
    copies = F.when(F.col("_n") % 3 == 0, 2).otherwise(1)
    sent = m.withColumn("_c", F.explode(F.sequence(F.lit(1), copies)))
    broken = m.where("_n % 7 = 0").withColumns({"msg_id": F.concat("msg_id", F.lit("-x")), "body": F.lit("not json")})
    sent.drop("_c").unionByName(broken).drop("_n").write.mode("overwrite").json(path)


@query("a17_prediction_stream", f"""WITH {PREDICTIONS},
ok AS (SELECT date, dayofyear(date) AS n FROM predictions WHERE prediction IS NOT NULL)
SELECT CASE WHEN k < 2 THEN 'parsed' ELSE 'quarantined' END AS status, CAST(count(*) AS BIGINT) AS n_messages
FROM (SELECT date, 0 AS k FROM ok UNION ALL SELECT date, 1 FROM ok WHERE n % 3 = 0 UNION ALL SELECT date, 2 FROM ok WHERE n % 7 = 0)
GROUP BY 1""")
def a17(spark, d):
    path = work_dir(spark, "messages")
    write_messages(spark, d, f"{path}/in")
    raw = msgs.message_stream(spark, f"{path}/in")
    status = F.when(F.col("date").isNull(), "quarantined").otherwise("parsed").alias("status")
    msgs.run_once(msgs.parse(raw).select(status, "msg_id"), f"{path}/out", f"{path}/ckpt")
    return spark.read.parquet(f"{path}/out").groupBy("status").agg(F.count(F.lit(1)).alias("n_messages"))


@query("a18_account_state_read", """
SELECT CAST(c_custkey AS VARCHAR) AS date, 0.0 AS amount, c_acctbal AS account_balance, 0 AS days_in_trade,
       CAST(NULL AS VARCHAR) AS symbol FROM customer""")
def a18(spark, d):
    path = work_dir(spark, "accounts")
    b.table(spark, d, "customer").select(
        F.lit(None).cast("string").alias("symbol"), F.lit(0.0).alias("amount"), F.lit(0.0).alias("position_value"),
        F.col("c_acctbal").alias("account_balance"), F.lit(0).alias("days_in_trade"), F.lit(0.0).alias("trade_open_spread"),
        F.col("c_custkey").cast("string").alias("date")).write.mode("overwrite").json(f"{path}/accounts")
    return files.read_accounts(spark, f"{path}/accounts").select("date", "amount", "account_balance", "days_in_trade", "symbol")


@query("a19_init_tables", f"""WITH {BARS},
dim AS (SELECT DISTINCT l_returnflag AS symbol, 'CCC' AS exchange, 'CRYPTOCURRENCY' AS asset_type FROM lineitem)
SELECT 'asset_fact_table' AS name, symbol, date, close, volume, NULL AS asset_type FROM bars
UNION ALL SELECT 'prediction_fact_table', NULL, date, NULL, NULL, NULL FROM bars
UNION ALL SELECT 'symbol_dimension', symbol, NULL, NULL, NULL, asset_type FROM dim""")
def a19(spark, d):
    # bar fact, prediction fact and the de-duplicated symbol dimension, written as CSV
    path = work_dir(spark, "init")
    a = b.assets(spark, d).withColumns({"asset_type": F.lit("CRYPTOCURRENCY"), "confidence": F.lit(None).cast("double")})
    out = {"asset_fact_table": a.select(*schemas.ASSET_SOURCE.names),
           "prediction_fact_table": a.select("date", "prediction", "confidence", "actual", "model_id"),
           "symbol_dimension": a.select("symbol", "exchange", "asset_type").distinct()}
    for name, df in out.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
    none = {c: F.lit(None).cast(k).alias(c) for c, k in (
        ("symbol", "string"), ("date", "date"), ("close", "double"), ("volume", "double"), ("asset_type", "string"))}
    picked = {"asset_fact_table": ("symbol", "date", "close", "volume"), "prediction_fact_table": ("date",),
              "symbol_dimension": ("symbol", "asset_type")}
    back = None
    for name, df in out.items():
        rows = spark.read.option("header", True).schema(df.schema).csv(f"{path}/{name}").select(
            F.lit(name).alias("name"), *[F.col(c).cast("double") if c in ("close", "volume") else F.col(c) for c in picked[name]])
        rows = rows.select("name", *[F.col(c) if c in picked[name] else empty for c, empty in none.items()])
        back = rows if back is None else back.unionByName(rows)
    return back
