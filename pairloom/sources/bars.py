"""Bars: reading, building from ticks, incremental extraction and repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom import schemas
from pairloom.operators.series import join_per_key


def read_bars(spark: SparkSession, path: str, start: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Stored bars from ``start`` on; the date filter reaches the scan."""
    reader = spark.read.schema(schemas.BAR).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(path)
    return df if start is None else df.where(F.col("date") >= F.lit(start).cast("date"))


def bars_from_ticks(
    ticks: DataFrame, symbol: str, at: Column, price: Column, size: Column, order: Sequence[Column],
    interval: str = "day",
) -> DataFrame:
    """OHLCV bars per symbol and interval; ``order`` ranks the ticks inside a bar.

    With one column in ``order`` (see ``columns.packed``) ticks are aggregated by hashing, else by sorting.
    """
    key = F.struct(*order) if len(order) > 1 else order[0]
    name, stamp = ("date", at.cast("date")) if interval == "day" else ("ts", F.date_trunc(interval, at))
    return (
        ticks.select(F.col(symbol).alias("symbol"), stamp.alias(name),
                     price.alias("_p"), size.alias("_v"), key.alias("_k"))
        .groupBy("symbol", name)
        .agg(F.min_by("_p", "_k").alias("open"), F.max("_p").alias("high"), F.min("_p").alias("low"),
             F.max_by("_p", "_k").alias("close"), F.sum("_v").alias("volume"))
    )


def high_water(df: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Latest stored date, per key or over all rows."""
    return df.groupBy(*by).agg(F.max("date").alias("latest")) if by else df.agg(F.max("date").alias("latest"))


def after_high_water(incoming: DataFrame, stored: DataFrame, today: str) -> DataFrame:
    """Rows newer than the stored mark of their symbol; the mark itself only while it is today."""
    marks = high_water(stored)
    return (
        join_per_key(incoming, marks, ["symbol"], "date", "left")
        .where(F.col("latest").isNull() | (F.col("date") > F.col("latest"))
               | ((F.col("date") == F.col("latest")) & (F.col("latest") == F.lit(today).cast("date"))))
        .drop("latest")
    )


def last_dates(df: DataFrame) -> DataFrame:
    """Last and second last date per symbol from a mergeable aggregate (no window)."""
    top = df.groupBy("symbol").agg(F.max("date").alias("last_date"))
    marked = join_per_key(df.select("symbol", "date"), top, ["symbol"], "date")
    return marked.groupBy("symbol").agg(
        F.max("last_date").alias("last_date"), F.max(F.when(F.col("date") < F.col("last_date"), F.col("date"))).alias("prev_date"))


def drop_open_bar(df: DataFrame) -> DataFrame:
    """All bars but the newest of each symbol."""
    top = df.groupBy("symbol").agg(F.max("date").alias("_last"))
    return join_per_key(df, top, ["symbol"], "date").where("date < _last").drop("_last")


def with_symbol_info(bars: DataFrame, info: DataFrame) -> DataFrame:
    """Bars plus currency and exchange, and empty prediction columns."""
    return (
        join_per_key(bars, info.select("symbol", "currency", "exchange"), ["symbol"], "date", "left")
        .withColumn("actual", F.lit(None).cast("double"))
        .withColumn("prediction", F.lit(None).cast("double"))
    )


def shift_last_if_missing(df: DataFrame, today: str) -> DataFrame:
    """Move the last bar of a symbol back one day when ``today`` has no bar."""
    top = df.groupBy("symbol").agg(F.max("date").alias("_last"))
    moved = (F.col("date") == F.col("_last")) & (F.col("_last") != F.lit(today).cast("date"))
    joined = join_per_key(df, top, ["symbol"], "date")
    return joined.withColumn("date", F.when(moved, F.date_sub("date", 1)).otherwise(F.col("date"))).drop("_last")


def shift_last_on_gap(df: DataFrame) -> DataFrame:
    """Move the last bar of a symbol back one day when it is not one day after the bar before."""
    ends = last_dates(df)
    moved = (F.col("date") == F.col("last_date")) & (F.datediff("last_date", "prev_date") != 1)
    return (
        join_per_key(df, ends, ["symbol"], "date")
        .withColumn("date", F.when(moved, F.date_sub("date", 1)).otherwise(F.col("date")))
        .drop("last_date", "prev_date")
    )


def calendar(spark: SparkSession, start: str = "2017-11-09", end: str = "2030-01-01") -> DataFrame:
    """One row per day: 0-based ``date_code``, date, year, month, day."""
    days = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS date")
    return days.select(
        F.datediff("date", F.lit(start).cast("date")).alias("date_code"), "date",
        F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"))


def lookback(facts: DataFrame, dim: DataFrame, n_days: int = 150) -> DataFrame:
    """Facts of the last ``n_days`` days before the newest date code, that code included.

    ``n_days=0`` keeps everything. The bound is a scalar subquery, so nothing is collected.
    """
    if n_days:
        newest = facts.agg(F.max("date_code")).scalar()
        facts = facts.where(F.col("date_code") >= newest - n_days)
    return facts.join(F.broadcast(dim.select("date_code", "year", "month", "day")), "date_code")


def range_chunks(spark: SparkSession, start: str, end: str, months: int = 9) -> DataFrame:
    """Consecutive read ranges ``[chunk_start, chunk_end]`` that share their edge dates."""
    return spark.sql(f"""
        SELECT posexplode(sequence(DATE'{start}', DATE'{end}', INTERVAL {months} MONTH)) AS (chunk_no, chunk_start)
    """).withColumn("chunk_end", F.add_months("chunk_start", months))


def chunked_backfill(source: DataFrame, start: str, end: str, months: int = 9, whole_ranges_only: bool = False) -> DataFrame:
    """Rows of ``[start, end]`` with the read range they come from; the last range ends at ``end``.

    A date on the edge of two ranges belongs to the earlier one. The range follows from the date by arithmetic, so nothing
    is joined. ``whole_ranges_only`` leaves out ranges that would end after ``end``, as a provider asked in whole steps would.
    """
    first, last, day = F.lit(start).cast("date"), F.lit(end).cast("date"), F.col("date")
    full = F.floor(((F.year(day) - F.year(first)) * 12 + F.month(day) - F.month(first)) / months).cast("int")
    early = (full > 0) & (day <= F.add_months(first, full * months))
    rows = source.where((day >= first) & (day <= last)).withColumn("chunk_no", F.when(early, full - 1).otherwise(full))
    return rows.where(F.add_months(first, (F.col("chunk_no") + 1) * months) <= last) if whole_ranges_only else rows
