"""Data-quality checks: each returns the violations, so an empty result means a pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, all counted in one pass."""
    counts = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c) for c in columns])
    stacked = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {stacked}) AS (column_name, n_null)")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def outside_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def negatives(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def outside_any(df: DataFrame, columns: Sequence[str], low: float = 0, high: float = 1_000_000) -> DataFrame:
    """Rows where any of ``columns`` leaves ``[low, high]``."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | ~F.col(c).between(low, high)
    return df.where(bad)


def null_gate(df: DataFrame, optional: Sequence[str] = ("actual", "prediction")) -> DataFrame:
    """Verdict on a batch: nulls are allowed only in the ``optional`` columns."""
    required = [c for c in df.columns if c not in optional]
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(bad, 1)).alias("n_bad")).withColumn(
        "accepted", F.col("n_bad") == 0)


def calendar_gaps(df: DataFrame, calendar: DataFrame, key: str = "symbol") -> DataFrame:
    """Calendar days inside the span of each key that have no row."""
    spans = df.groupBy(key).agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    expected = spans.select(key, F.explode(F.sequence("_lo", "_hi")).alias("date"))
    return expected.join(calendar.select("date"), "date", "left_semi").join(
        df.select(key, "date"), [key, "date"], "left_anti").select(key, "date")
