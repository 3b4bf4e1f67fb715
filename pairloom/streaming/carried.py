"""Recursive features that go on from where the last batch stopped.

A table of carries holds one row per series: how many rows it had, its last close, and the states of its recurrences. A batch of later
bars is scanned from these states, so exponential means, strength index, true range and volume-weighted price of n batches equal
those of one run over all bars, and a batch reads its own rows and one row per series. Every batch writes the carries as a new version
and reads the version before its own: a repeated batch starts from the same states and overwrites its own output.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.functions import columns as C
from pairloom.functions import rolling as R
from pairloom.operators import features as f
from pairloom.operators.series import ORD, SeriesSpec, affine_scan, join_per_key, running, sliding, with_ordinal
from pairloom.session import path_exists, stored

#: rows over which the averages of gains, losses and ranges are smoothed
SMOOTHED = 14
_WAS = "_was_"


def carry_schema(df: DataFrame, spec: SeriesSpec, means: Mapping[str, tuple[str, int]]) -> T.StructType:
    """Columns of the carries of ``df``: the keys, the last time, the number of rows and the states."""
    inputs = sorted({c for c, _ in means.values()})
    doubles = ["close", "up", "dn", "atr", "range_sum", "value", "volume", *means]
    longs = ["n_rows", *[f"{k}_{c}" for c in inputs for k in ("seen", "seen_at")]]
    return T.StructType([*[df.schema[k] for k in spec.keys], T.StructField("until", df.schema[spec.ts].dataType),
                         *[T.StructField(c, T.DoubleType()) for c in doubles], *[T.StructField(c, T.LongType()) for c in longs]])


def empty_carry(df: DataFrame, spec: SeriesSpec, means: Mapping[str, tuple[str, int]]) -> DataFrame:
    return df.sparkSession.createDataFrame([], carry_schema(df, spec, means))


def continued(batch: DataFrame, carry: DataFrame, spec: SeriesSpec, means: Mapping[str, tuple[str, int]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(features, carries, late)`` of a batch of bars with high, low, close and volume.

    ``features`` are the bars with the exponential means ``{name: (column, span)}``, rsi, atr and vwap; ``carries`` the states after
    the batch of all series, also those without a row in it; ``late`` the bars that are not after the last time of
    their series, which are left out: they need a run over all bars. ``(keys, ts)`` must be unique in a batch. A column of a mean may
    have nulls, the others may not. The scanned batch is stored in the shared folder, as features and carries both come from it.
    """
    keys, n = list(spec.keys), SMOOTHED
    inputs = sorted({c for c, _ in means.values()})
    states = [c for c in carry.columns if c not in keys]
    known = join_per_key(batch, carry.select(*keys, *[F.col(c).alias(_WAS + c) for c in states]), keys, spec.ts, "left")
    in_time = F.col(_WAS + "until").isNull() | (F.col(spec.ts) > F.col(_WAS + "until"))
    late = known.where(~in_time).select(*batch.columns)

    def was(name: str) -> Column:
        return F.coalesce(F.col(_WAS + name), F.lit(0.0))

    inner = spec.with_(shared_input=True, chunk_rows=max(spec.chunk_rows, n))
    df = with_ordinal(known.where(in_time), inner)
    at = F.col(ORD) + F.coalesce(F.col(_WAS + "n_rows"), F.lit(0).cast("long"))
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    df = running(df, inner, sums={"_pv": typical * F.col("volume"), "_v": F.col("volume")},
                 prevs={f"_at_{c}": F.when(F.col(c).isNotNull(), at) for c in inputs})

    def bounded(d: DataFrame, w) -> DataFrame:
        before = F.when(F.col(ORD) == 0, F.col(_WAS + "close")).otherwise(F.lag("close").over(w))
        d = d.withColumns({"_pos": at, "_before": before})
        change = F.col("close") - F.col("_before")
        d = d.withColumns({"_up": F.when(change > 0, change).otherwise(0.0), "_dn": F.when(change < 0, -change).otherwise(0.0),
                           "_tr": C.true_range(F.col("high"), F.col("low"), F.col("_before"), first_is_range=True)})
        return d.withColumn("_ranges", was("range_sum") + F.sum("_tr").over(R.so_far(w)))  # right in the first chunk, where it is needed

    df = sliding(df, inner, 1, bounded, keep_ordinal=True)
    pos = F.col("_pos")

    def wilder(x: str) -> tuple[Column, Column]:
        return F.lit((n - 1) / n), F.when(pos == 0, F.col(x)).otherwise(F.col(x) / n)

    scans = {"_s_up": wilder("_up"), "_s_dn": wilder("_dn"), "_s_atr": (F.lit((n - 1) / n), F.when(pos < n - 1, 0.0).when(
        pos == n - 1, F.col("_ranges") / n).otherwise(F.col("_tr") / n))}
    for name, (c, span) in means.items():
        gap = pos - F.coalesce(F.col(f"_at_{c}"), F.col(f"{_WAS}seen_at_{c}"))
        scans[f"_s_{name}"] = f._smoothing(F.col(c), gap, 2 / (span + 1))
    old = {"_s_up": "up", "_s_dn": "dn", "_s_atr": "atr", **{f"_s_{m}": m for m in means}}
    # the first row of a series takes the state before it; counts need no decay
    entered = {s: (a, b + F.when(F.col(ORD) == 0, a * was(old[s])).otherwise(0.0)) for s, (a, b) in scans.items()}
    counts = {f"_c_{c}": (F.lit(1.0), F.when(F.col(c).isNotNull(), 1.0).otherwise(0.0)) for c in inputs}
    df = affine_scan(df, inner, {**entered, **counts})
    now = {
        "until": F.col(spec.ts), "close": F.col("close").cast("double"), "up": F.col("_s_up"), "dn": F.col("_s_dn"), "atr": F.col("_s_atr"),
        "range_sum": F.col("_ranges"), "value": was("value") + F.col("_pv"), "volume": was("volume") + F.col("_v"), "n_rows": pos + 1,
        **{m: F.col(f"_s_{m}") for m in means},
        **{f"seen_{c}": (was(f"seen_{c}") + F.col(f"_c_{c}")).cast("long") for c in inputs},
        **{f"seen_at_{c}": F.when(F.col(c).isNotNull(), pos).otherwise(F.coalesce(F.col(f"_at_{c}"), F.col(f"{_WAS}seen_at_{c}"))) for c in inputs}}
    scanned = stored(df.select(*batch.columns, ORD, F.struct(*[now[s].alias(s) for s in states]).alias("_now")), "carried")
    s = {c: F.col(f"_now.{c}") for c in states}
    rsi = F.when(s["dn"] == 0, 100.0).otherwise(100 - F.lit(100.0) / (1 + C.ratio(s["up"], s["dn"])))
    features = scanned.select(
        *batch.columns, *[F.when(s[f"seen_{c}"] >= span, s[m]).alias(m) for m, (c, span) in means.items()],
        F.when(s["n_rows"] >= n, rsi).alias("rsi"), s["atr"].alias("atr"), C.ratio(s["value"], s["volume"]).alias("vwap"))
    last = scanned.groupBy(*keys).agg(F.max_by("_now", ORD).alias("_now")).select(*keys, "_now.*")
    untouched = carry.join(last.select(*keys), keys, "left_anti")
    return features, last.unionByName(untouched.select(*last.columns)), late


def carry_sink(spark: SparkSession, path: str, spec: SeriesSpec, means: Mapping[str, tuple[str, int]]):
    """``foreachBatch`` function under ``path``: ``features`` and ``late`` with a partition a batch, ``carries`` with a version a batch.

    Batch k reads version k - 1 of the carries and writes version k last; the first batch of a checkpoint starts with version -1 if
    there is one (states of bars from before the stream), else from nothing.
    """
    def version(k: int) -> str:
        return f"{path}/carries/version={k}"

    def write(batch: DataFrame, batch_id: int) -> None:
        schema = carry_schema(batch, spec, means)
        if batch_id == 0 and not path_exists(spark, version(-1)):
            carry = batch.sparkSession.createDataFrame([], schema)
        else:
            carry = batch.sparkSession.read.schema(schema).parquet(version(batch_id - 1))
        features, carries, late = continued(batch, carry, spec, means)
        features.write.mode("overwrite").parquet(f"{path}/features/batch_id={batch_id}")
        late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        carries.write.mode("overwrite").parquet(version(batch_id))
    return write
