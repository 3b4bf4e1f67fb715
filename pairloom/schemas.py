"""Table schemas and fixed column lists."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _S, _L, _I = T.DoubleType(), T.StringType(), T.LongType(), T.IntegerType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BAR = _schema(("date", T.DateType()), ("open", _D), ("high", _D), ("low", _D), ("close", _D),
              ("adj_close", _D), ("volume", _D), ("symbol", _S))
ASSET_SOURCE = _schema(("date", T.DateType()), ("open", _D), ("high", _D), ("low", _D), ("close", _D),
                       ("adj_close", _D), ("volume", _D), ("symbol", _S), ("currency", _S),
                       ("exchange", _S), ("prediction", _I), ("actual", _I), ("model_id", _S))
SYMBOL_INFO = _schema(("symbol", _S), ("exchange", _S), ("name", _S), ("sector", _S),
                      ("industry", _S), ("asset_type", _S), ("load_ts", T.TimestampNTZType()))
DATES = _schema(("date_id", _I), ("year", _I), ("month", _I), ("day", _I), ("load_ts", T.TimestampNTZType()))
POSITION = _schema(("date", T.DateType()), ("time", _S), ("symbol", _S), ("currency", _S),
                   ("position_size", T.DecimalType(38, 5)), ("trade_open_spread", T.DecimalType(38, 5)),
                   ("account_id", _S))
BALANCE = _schema(("date", T.DateType()), ("account_id", _S), ("account_balance", _D))
MESSAGE = _schema(("direction", T.MapType(_S, _I)), ("confidence", T.MapType(_S, _D)), ("date", _S),
                  ("mu", _D), ("std", _D), ("spread", _D))
ACCOUNT = _schema(("symbol", _S), ("amount", _D), ("position_value", _D), ("account_balance", _D),
                  ("days_in_trade", _I), ("trade_open_spread", _D), ("date", _S), ("time", _S))

# Column order of the stored feature table; the two legs are ETH and BTC.
FEATURE_TABLE = (
    "DATE", "OPEN_ETH", "HIGH_ETH", "CLOSE_ETH", "ADJUSTED_CLOSE_ETH", "LOW_ETH", "VOLUME_ETH",
    "DATE_CODE_ETH", "DOLLAR_VOLUME_ETH", "DOLLAR_VOLUME1M_ETH", "CLOSE_CHANGE_ETH",
    "CLOSE_DIRECTION_ETH", "YEAR_ETH", "MONTH_ETH", "DAY_ETH", "OPEN_BTC", "HIGH_BTC", "CLOSE_BTC",
    "ADJUSTED_CLOSE_BTC", "LOW_BTC", "VOLUME_BTC", "DATE_CODE_BTC", "DOLLAR_VOLUME_BTC",
    "DOLLAR_VOLUME1M_BTC", "CLOSE_CHANGE_BTC", "CLOSE_DIRECTION_BTC", "spread", "mu", "std",
    "standardized_spread", "CLOSE_DIRECTION_ETH_entropy", "CLOSE_DIRECTION_BTC_entropy",
    "bid_ask_spread_CLOSE_CHANGE_ETH", "bid_ask_spread_CLOSE_CHANGE_BTC", "CLOSE_ETH_coint",
    "CLOSE_BTC_coint", "MA_5", "MA_20", "vwap_btc", "vwap_eth", "MA_upper_co", "MA_lower_co", "rsi",
    "atr_btc", "atr_eth",
)

# Columns of the feature table that are not model inputs.
NOT_MODEL_INPUTS = {
    "date", "spread", "date_code_eth", "year_eth", "month_eth", "day_eth", "date_code_btc",
}
MODEL_FEATURES = tuple(c.lower() for c in FEATURE_TABLE if c.lower() not in NOT_MODEL_INPUTS)
