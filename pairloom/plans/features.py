"""From dated facts to the stored feature table and the model input."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom import schemas
from pairloom.operators.features import PAIR, pair_frame, technical_features
from pairloom.operators.series import SeriesSpec
from pairloom.operators.tables import project
from pairloom.sources.bars import lookback

FACT_VALUES = ("open", "high", "low", "close", "adjusted_close", "volume", "date_code", "dollar_volume",
               "dollar_volume1m", "close_change", "close_direction", "year", "month", "day")


def feature_frame(facts: DataFrame, dates: DataFrame, legs: Mapping[str, str], n_days: int = 150,
                  spec: SeriesSpec = PAIR, atr_eth_as_called: bool = False) -> DataFrame:
    """Technical features of the last ``n_days`` days of two symbols (0: of all days)."""
    recent = lookback(facts, dates, n_days).withColumns({
        "symbol": F.col("symbol_code"), "date": F.make_date("year", "month", "day")})
    pair = pair_frame(recent, legs, FACT_VALUES)
    first, second = legs.values()
    return technical_features(pair, spec, first, second, atr_eth_as_called=atr_eth_as_called)


def feature_table(features: DataFrame) -> DataFrame:
    """The 45 stored columns in order; the legs must be named eth and btc."""
    return project(features, schemas.FEATURE_TABLE)


def read_features(table: DataFrame) -> DataFrame:
    """Stored features with lower-case names, numbers as doubles, flags as integers."""
    lower = table.toDF(*[c.lower() for c in table.columns])
    flags = ("ma_upper_co", "ma_lower_co")
    return lower.select(*[
        F.col(c) if c == "date" else F.col(c).cast("double").cast("int").alias(c) if c in flags
        else F.col(c).cast("double").alias(c) for c in lower.columns])


def latest_vector(features: DataFrame) -> DataFrame:
    """Ordered model input of the newest date, with the numbers a message carries."""
    row = F.struct("date", "mu", "std", F.col("standardized_spread").alias("spread"),
                   F.array(*[F.col(c).cast("double") for c in schemas.MODEL_FEATURES]).alias("x"))
    return features.agg(F.max_by(row, "date").alias("r")).select("r.*")
