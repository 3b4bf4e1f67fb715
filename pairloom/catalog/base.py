"""Query registry and the inputs every query derives from the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pairloom.functions.columns import packed
from pairloom.operators import features
from pairloom.operators.features import pair_frame, standardized_spread
from pairloom.sources.bars import bars_from_ticks

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

RUN_TS = "2024-01-01 00:15:00"
LEGS = {"A": "eth", "N": "btc"}

# here bars and pairs are aggregated from the driver tables, not read from a stored table
BAR_SERIES = features.BARS.with_(shared_input=True)
PAIR = features.PAIR.with_(shared_input=True)


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once and then declared."""
    path = f"{d}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def bars(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars: symbol = return flag, date = ship date, price = extended price per unit."""
    items = table(spark, d, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    order = packed((F.col("l_orderkey"), 17), (F.col("l_linenumber"), 4), (F.round(price * 1_000_000), 15))
    return bars_from_ticks(items, "l_returnflag", F.col("l_shipdate"), price, F.col("l_quantity"), [order])


def pair(spark: SparkSession, d: str) -> DataFrame:
    return pair_frame(bars(spark, d), LEGS)


def spread(spark: SparkSession, d: str, **kw) -> DataFrame:
    return standardized_spread(pair(spark, d), PAIR, "close_btc", "close_eth", **kw)


def assets(spark: SparkSession, d: str) -> DataFrame:
    """Bars in the layout of the staging table."""
    return bars(spark, d).select(
        "date", "open", "high", "low", "close", F.col("close").alias("adj_close"), "volume", "symbol",
        F.lit("USD").alias("currency"), F.lit("CCC").alias("exchange"), F.lit(None).cast("int").alias("prediction"),
        F.lit(None).cast("int").alias("actual"), F.lit(None).cast("string").alias("model_id"))


def dates(spark: SparkSession, d: str) -> DataFrame:
    """Calendar over the span of the ship dates, ``date_code`` from 0."""
    span = table(spark, d, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("lo"), F.max("l_shipdate").cast("date").alias("hi"))
    days = span.select("lo", F.explode(F.sequence("lo", "hi")).alias("date"))
    return days.select(F.datediff("date", "lo").alias("date_code"), "date", F.year("date").alias("year"),
                       F.month("date").alias("month"), F.dayofmonth("date").alias("day"))


def positions(spark: SparkSession, d: str) -> DataFrame:
    """One position per order."""
    o = table(spark, d, "orders")
    seconds = (F.col("o_orderkey") % 86400).cast("int")
    clock = F.format_string("%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60)
    return o.select(
        F.col("o_orderdate").cast("date").alias("date"), clock.alias("time"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("symbol"),
        F.lit("USD").alias("currency"), F.col("o_totalprice").alias("position_size"),
        (F.col("o_totalprice") / 1000000).alias("trade_open_spread"), F.col("o_custkey").cast("string").alias("account_id"))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Sign of the spread score as direction, its squashed size as confidence."""
    z = F.col("standardized_spread")
    return spread(spark, d).select(
        "date", F.when(z > 0, 1).when(z <= 0, 0).alias("prediction"), (F.abs(z) / (1 + F.abs(z))).alias("confidence"),
        F.lit(None).cast("int").alias("actual"), F.lit("spread_sign").alias("model_id"))


# --- the same inputs as SQL text -------------------------------------------------------------

BARS = """
ticks AS (SELECT l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice / l_quantity AS p,
                 l_quantity AS q, l_orderkey AS ok, l_linenumber AS ln FROM lineitem),
bars AS (SELECT symbol, date, first(p ORDER BY ok, ln, p) AS open, max(p) AS high, min(p) AS low,
                last(p ORDER BY ok, ln, p) AS close, sum(q) AS volume FROM ticks GROUP BY symbol, date)
"""
PAIR_SQL = BARS + """,
pair AS (SELECT 'btc-eth' AS pair, a.date, a.open AS open_eth, a.high AS high_eth, a.low AS low_eth,
                a.close AS close_eth, a.volume AS volume_eth, n.open AS open_btc, n.high AS high_btc,
                n.low AS low_btc, n.close AS close_btc, n.volume AS volume_btc
         FROM bars a JOIN bars n ON a.date = n.date WHERE a.symbol = 'A' AND n.symbol = 'N')
"""
SPREAD_SQL = PAIR_SQL + """,
rets AS (SELECT *, (close_btc / NULLIF(lag(close_btc) OVER (ORDER BY date), 0) - 1)
                 - (close_eth / NULLIF(lag(close_eth) OVER (ORDER BY date), 0) - 1) AS spread FROM pair),
moms AS (SELECT *, CASE WHEN count(spread) OVER w = 55 THEN avg(spread) OVER w END AS mu,
                   CASE WHEN count(spread) OVER w = 55 THEN stddev_samp(spread) OVER w END AS std
         FROM rets WINDOW w AS (ORDER BY date ROWS BETWEEN 54 PRECEDING AND CURRENT ROW)),
zs AS (SELECT *, (spread - mu) / NULLIF(std, 0) AS z, row_number() OVER (ORDER BY date) - 1 AS o FROM moms)
"""
DATES = """
span AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem),
days AS (SELECT lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
dates AS (SELECT CAST(date - lo AS INTEGER) AS date_code, date, CAST(year(date) AS INTEGER) AS year,
                 CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day FROM days)
"""
POSITIONS = """
positions AS (SELECT CAST(o_orderdate AS DATE) AS date,
    printf('%02d:%02d:%02d', (o_orderkey % 86400) // 3600, (o_orderkey % 3600) // 60, o_orderkey % 60) AS time,
    ['A', 'N', 'R'][o_orderkey % 3 + 1] AS symbol, 'USD' AS currency, o_totalprice AS position_size,
    o_totalprice / 1000000 AS trade_open_spread, CAST(o_custkey AS VARCHAR) AS account_id FROM orders)
"""
PREDICTIONS = SPREAD_SQL + """,
predictions AS (SELECT date, CASE WHEN z > 0 THEN 1 WHEN z <= 0 THEN 0 END AS prediction,
    abs(z) / (1 + abs(z)) AS confidence, CAST(NULL AS INTEGER) AS actual, 'spread_sign' AS model_id FROM zs)
"""


def r(col, digits: int = 6):
    """Rounded copy of a column under its own name."""
    return F.round(F.col(col), digits).alias(col)
