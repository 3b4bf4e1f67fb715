"""Star schema: staging, dated facts, dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions import columns as C
from pairloom.functions import rolling as R
from pairloom.operators.features import BARS, vwap
from pairloom.operators.series import SeriesSpec, running, sliding
from pairloom.operators.tables import current_versions


def as_text(c: str | Column) -> Column:
    """Numbers as whole ten-thousandths, so a key does not depend on how an engine prints doubles."""
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col.cast("double") * 10000 + 0.5).cast("string")


def staged(df: DataFrame, names: Mapping[str, str], source: str) -> DataFrame:
    """Renamed projection with the name of its source."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()], F.lit(source).alias("source"))


def hashed(df: DataFrame, hkey: str, key_cols: list, hdiff: str, diff_cols: list, run_ts: str) -> DataFrame:
    """Business key, attribute digest and load stamp."""
    return df.select(
        C.surrogate_key(*key_cols).alias(hkey), C.surrogate_key(*diff_cols).alias(hdiff), "*",
        F.lit(run_ts).alias("load_ts_utc"))


def with_missing_member(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add the "Missing" row; columns without a default stay null."""
    row = df.sparkSession.range(1).select(*[
        F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.unionByName(row)


def to_date_code(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Inner join on year, month and day; rows outside the calendar drop.

    The calendar has one row per day of a fixed range, so it is small whatever the facts are.
    """
    dim = dates.select(F.col("year").alias("_y"), F.col("month").alias("_m"), F.col("day").alias("_d"), "date_code")
    on = (F.year("date") == F.col("_y")) & (F.month("date") == F.col("_m")) & (F.dayofmonth("date") == F.col("_d"))
    return df.join(F.broadcast(dim), on).drop("_y", "_m", "_d")


def stage_bars(assets: DataFrame, run_ts: str) -> DataFrame:
    names = {"date": "date", "open": "open", "high": "high", "close": "close", "adj_close": "adjusted_close",
             "low": "low", "volume": "volume", "symbol": "symbol_code", "exchange": "exchange_code",
             "currency": "currency_code", "prediction": "prediction", "actual": "actual", "model_id": "model_id"}
    src = staged(assets, names, "SOURCE_DATA.ASSET_SOURCE")
    prices = [as_text(c) for c in ("open", "high", "low", "close", "adjusted_close", "volume")]
    return hashed(src, "asset_hkey", ["date", "symbol_code"], "asset_hdiff",
                  ["date", "symbol_code", *prices, "exchange_code", "currency_code", "prediction", "actual", "model_id"],
                  run_ts)


def stage_positions(positions: DataFrame, run_ts: str) -> DataFrame:
    names = {"date": "date", "time": "time", "symbol": "symbol_code", "currency": "currency_code",
             "position_size": "position_size", "trade_open_spread": "trade_open_spread", "account_id": "account_id"}
    src = staged(positions, names, "SOURCE_DATA.POSITION_SOURCE")
    return hashed(src, "position_hkey", ["date", "time", "symbol_code"], "position_hdiff",
                  ["symbol_code", "date", "time", "currency_code", as_text("position_size"),
                   as_text("trade_open_spread"), "account_id"], run_ts)


def stage_predictions(predictions: DataFrame, run_ts: str) -> DataFrame:
    names = {c: c for c in ("date", "prediction", "confidence", "actual", "model_id")}
    src = staged(predictions, names, "SOURCE_DATA.PREDICTION_SOURCE")
    return hashed(src, "prediction_hkey", ["date"], "prediction_hdiff",
                  ["date", "prediction", as_text("confidence"), "actual", "model_id"], run_ts)


def stage_symbols(info: DataFrame) -> DataFrame:
    names = {"symbol": "symbol_code", "exchange": "exchange_code", "name": "security_name", "sector": "sector",
             "industry": "industry", "asset_type": "asset_type", "load_ts": "load_ts_utc"}
    src = info.select(*[F.col(o).alias(n) for o, n in names.items()])
    attributes = ["symbol_code", "exchange_code", "security_name", "sector", "industry", "asset_type"]
    return src.select(C.surrogate_key("symbol_code").alias("symbol_hkey"),
                      C.surrogate_key(*attributes).alias("symbol_hdiff"), "*")


def fact_ohlc(staging: DataFrame, dates: DataFrame, spec: SeriesSpec | None = None,
              dollar_volume_mean_of: str = "close") -> DataFrame:
    """Bars with changes, ranges, averages and cumulative VWAP, dated by code.

    ``dollar_volume_mean_of`` names the column behind ``dollar_volume1m``; the stored fact
    averages the close, the name suggests ``dollar_volume``.
    """
    spec = spec or BARS.with_(keys=("symbol_code",))

    def bounded(d: DataFrame, w) -> DataFrame:
        close = F.col("close")
        prev = F.lag("close").over(w)
        d = d.withColumns({"dollar_volume": close * F.col("volume"), "close_change": R.change(close, w)})
        d = R.add(d, w, R.moving_avg(F.col(dollar_volume_mean_of), "dollar_volume1m"))
        return d.withColumns({
            "close_direction": F.signum("close_change"),
            "range": F.col("high") - F.col("low"),
            "true_range": C.true_range(F.col("high"), F.col("low"), prev)})

    dated = to_date_code(staging, dates)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    # position, VWAP sums: one pass of cumulative sums; then one chunked window pass
    summed = running(dated, spec, sums={"_ord": F.lit(1).cast("long"), "_pv": typical * F.col("volume"),
                                        "_v": F.col("volume")}).withColumn("_ord", F.col("_ord") - 1)
    facts = sliding(summed, spec, 22, bounded)
    return facts.withColumn("vwap", C.ratio(F.col("_pv"), F.col("_v"))).drop("_pv", "_v", "date")


def mart_ohlc(facts: DataFrame) -> DataFrame:
    """The fact without its staging columns."""
    return facts.drop("asset_hkey", "asset_hdiff", "source", "load_ts_utc")


def fact_position(staging: DataFrame, dates: DataFrame, facts: DataFrame, chunk_rows: int = 1024) -> DataFrame:
    """Positions with their value at the close and its change per account and symbol."""
    closes = facts.select("symbol_code", "date_code", "close")
    valued = (
        to_date_code(staging, dates).join(closes, ["symbol_code", "date_code"], "left")
        .withColumn("position_value", F.col("position_size").cast("double") * F.col("close")).drop("close"))
    spec = SeriesSpec(("account_id", "symbol_code"), "date", ties=("time", "position_hkey", "position_hdiff"), chunk_rows=chunk_rows)

    def change(d: DataFrame, w) -> DataFrame:
        d = d.withColumn("previous_position_val", F.lag("position_value").over(w))
        return d.withColumn("position_value_daily_pct_change",
                            C.ratio(F.col("position_value"), F.col("previous_position_val")) - 1)

    return sliding(valued, spec, 1, change).drop("date", "source", "load_ts_utc")


def fact_predictions(staging: DataFrame, dates: DataFrame) -> DataFrame:
    """Scored rows only, dated by code."""
    return to_date_code(staging, dates).where(F.col("prediction").isNotNull()).select(
        "date_code", "prediction", "confidence", "actual", "model_id")


def dim_symbol(snapshot: DataFrame) -> DataFrame:
    return current_versions(snapshot).drop("symbol_hkey", "symbol_hdiff", "snsh_load_ts_utc", "load_ts_utc")
