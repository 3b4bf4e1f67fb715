"""Incremental feature maintenance: recompute the tail that a new batch of bars touches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.series import join_per_key


def touched_tail(stored: DataFrame, batch: DataFrame, lookback_days: int = 150) -> DataFrame:
    """Stored bars of the symbols in ``batch`` from ``lookback_days`` before their first new date
    on, with the batch rows in place of stored rows of the same date."""
    first = batch.groupBy("symbol").agg(F.min("date").alias("_from"))
    old = join_per_key(stored, first, ["symbol"], "date").where(F.col("date") >= F.date_sub("_from", lookback_days)).drop("_from")
    kept = old.join(batch.select("symbol", "date"), ["symbol", "date"], "left_anti")
    return kept.unionByName(batch.select(*kept.columns))


def refreshed(stored: DataFrame, batch: DataFrame, compute: Callable[[DataFrame], DataFrame],
              lookback_days: int = 150) -> DataFrame:
    """Features of the new dates, computed from the touched tail only."""
    computed = compute(touched_tail(stored, batch, lookback_days))
    return computed.join(batch.select("symbol", "date"), ["symbol", "date"], "left_semi")


def latest_rows(log: DataFrame, keys: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Current rows of a table kept as batches: per key the row of the newest batch."""
    values = [c for c in log.columns if c not in (*keys, "batch_id")]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_r"))
    return newest.select(*keys, "_r.*")


def refresh_sink(read_stored: Callable[[dt.date], DataFrame], compute: Callable[[DataFrame], DataFrame], bars_path: str,
                 features_path: str, lookback_days: int = 150):
    """``foreachBatch`` function: one partition per batch in the bar and the feature table.

    ``read_stored`` gets the first date it is asked for and must give the bars of earlier batches from there on
    (``latest_rows`` after a filter on the date, which then reaches the scan). A repeated batch overwrites its own partitions.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        first = batch.agg(F.min("date")).first()[0]
        if first is None:
            return
        features = refreshed(read_stored(first - dt.timedelta(days=lookback_days)), batch, compute, lookback_days)
        features.write.mode("overwrite").parquet(f"{features_path}/batch_id={batch_id}")
        batch.write.mode("overwrite").parquet(f"{bars_path}/batch_id={batch_id}")
    return write
