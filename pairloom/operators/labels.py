"""Event labels, label overlap and validation folds."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.operators.series import CHUNK, ORD, SeriesSpec, join_per_key, running, time_sliding, time_slices, with_ordinal
from pairloom.session import stored


DAY_MICROS = 86_400_000_000


def _micros(df: DataFrame, ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _stamp(micros: Column, dtype: T.DataType) -> Column:
    return F.timestamp_micros(micros).cast(dtype)


def _slices(df: DataFrame, spec: SeriesSpec, value: str, days: int) -> DataFrame:
    """Rows of each time slice and of the ``days`` after it, with ``_t`` (microseconds), ``_v`` (``|value|``) and ``_home``."""
    timed = df.withColumns({"_t": _micros(df, spec.ts), "_v": F.abs(value).cast("double")})
    return time_slices(timed, spec, ahead_days=days)


def first_touch(t: np.ndarray, v: np.ndarray, upper: np.ndarray, lower: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each row the first later row, up to time ``end``, whose ``v`` is at least ``upper`` or at most ``lower``; else the number of rows.

    ``t`` is sorted. Maxima and minima of runs of 1, 2, 4, .. rows tell which runs hold no touch, so a row costs a
    step per doubling and not one per row of its holding time.
    """
    n = len(t)
    at, stop = np.searchsorted(t, t, "right"), np.searchsorted(t, end, "right")
    most, least = np.where(np.isnan(v), -np.inf, v), np.where(np.isnan(v), np.inf, v)
    runs = [(most, least)]
    while 2 ** len(runs) <= n:
        half = 2 ** (len(runs) - 1)
        hi, lo = runs[-1]
        runs.append((np.maximum(hi[:-half], hi[half:]), np.minimum(lo[:-half], lo[half:])))
    for k in range(len(runs) - 1, -1, -1):
        hi, lo = runs[k]
        inside = at + 2 ** k <= stop
        place = np.minimum(at, len(hi) - 1)
        at = np.where(inside & ~((hi[place] >= upper) | (lo[place] <= lower)), at + 2 ** k, at)
    return np.where(at < stop, at, n)


def _touches(t: np.ndarray, v: np.ndarray, take_profit: float, stop_loss: float, days: int) -> tuple[np.ndarray, np.ndarray]:
    """Label and touch time (microseconds) of sorted rows."""
    upper, lower, end = v * (1 + take_profit), v * (1 - stop_loss), t + days * DAY_MICROS
    with np.errstate(invalid="ignore"):
        hit = first_touch(t, v, upper, lower, end)
        touched, row = hit < len(t), np.minimum(hit, len(t) - 1)
        label = np.where(touched, np.where(v[row] >= upper, 1, -1), 0)
    return label, np.where(touched, t[row], end)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def triple_barrier(df: DataFrame, spec: SeriesSpec, value: str, take_profit: float, stop_loss: float,
                   holding_days: int) -> DataFrame:
    """First touch of ``|z|(1+tp)`` (label 1) or ``|z|(1-sl)`` (label -1) within the holding time.

    The upper barrier is tested first; without a touch the label is 0 and ``t1`` the end of the
    holding time. A missing value never touches. Each time slice is searched by itself, with the rows
    of one holding time after it.
    """
    names, dtype = df.columns, df.schema[spec.ts].dataType

    def label(table: pa.Table) -> pa.Table:
        table = table.sort_by("_t")
        hit, t1 = _touches(_numbers(table, "_t"), _numbers(table, "_v"), take_profit, stop_loss, holding_days)
        out = table.select(names).append_column("label", pa.array(hit, pa.int32())).append_column("_t1", pa.array(t1, pa.int64()))
        return out.filter(table.column("_home"))

    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in df.schema.fields],
                           T.StructField("label", T.IntegerType()), T.StructField("_t1", T.LongType())])
    out = _slices(df, spec, value, holding_days).groupBy(*spec.keys, CHUNK).applyInArrow(label, schema)
    return out.select(*names, "label", _stamp(F.col("_t1"), dtype).alias("t1"))


def barrier_sweep(df: DataFrame, spec: SeriesSpec, value: str,
                  grid: Sequence[tuple[float, float, int]]) -> DataFrame:
    """Label counts for every (take profit, stop loss, holding days) of a fixed grid.

    Each time slice is searched once per cell of the grid and gives one row of counts per cell.
    """
    keys = list(spec.keys)

    def count(table: pa.Table) -> pa.Table:
        table = table.sort_by("_t")
        t, v, home = _numbers(table, "_t"), _numbers(table, "_v"), table.column("_home").to_numpy()
        rows = []
        for cell in grid if home.any() else ():
            hit, t1 = (x[home] for x in _touches(t, v, *cell))
            rows.append((*cell, int((hit == 1).sum()), int((hit == -1).sum()), int((hit == 0).sum()), float(((t1 - t[home]) / DAY_MICROS).sum())))
        first = table.slice(0, 1).select(keys)
        series = [pa.concat_arrays([first.column(k).combine_chunks()] * len(rows)) if rows else first.column(k).combine_chunks().slice(0, 0) for k in keys]
        kinds = [pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        return pa.Table.from_arrays([*series, *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], names=schema.names)

    counts = ("n_profit", "n_stop", "n_timeout")
    schema = T.StructType([*[T.StructField(k, df.schema[k].dataType) for k in keys], T.StructField("take_profit", T.DoubleType()),
                           T.StructField("stop_loss", T.DoubleType()), T.StructField("holding_days", T.LongType()),
                           *[T.StructField(c, T.LongType()) for c in counts], T.StructField("days_held", T.DoubleType())])
    cut = _slices(df.select(*keys, *spec.order, value), spec, value, max(h for _, _, h in grid))
    parts = cut.groupBy(*keys, CHUNK).applyInArrow(count, schema)
    return parts.groupBy(*keys, "take_profit", "stop_loss", "holding_days").agg(*[F.sum(c).alias(c) for c in (*counts, "days_held")])


def relabel(df: DataFrame, label: str = "label") -> DataFrame:
    """Drop label 0 and turn -1 into 0."""
    return df.where(F.col(label) != 0).withColumn(label, F.when(F.col(label) == -1, 0).otherwise(F.col(label)))


def forward_candidates(df: DataFrame, spec: SeriesSpec, value: str, days: int) -> DataFrame:
    """For each row the later rows within ``days``: how many, and their reach in ``|value|``."""
    dtype = df.schema[spec.ts].dataType

    def reach(d: DataFrame, w: WindowSpec) -> DataFrame:
        later = Window.partitionBy(*spec.keys, CHUNK).orderBy("_t").rangeBetween(1, days * DAY_MICROS)
        return d.withColumns({"n_candidates": F.count(F.lit(1)).over(later), "_first": F.min("_t").over(later),
                              "max_abs": F.max("_v").over(later), "min_abs": F.min("_v").over(later)})

    timed = df.withColumns({"_t": _micros(df, spec.ts), "_v": F.abs(value)})
    out = time_sliding(timed, spec, reach, ahead_days=days)
    return out.select(*spec.keys, F.col(spec.ts).alias("t0"), "n_candidates", _stamp(F.col("_first"), dtype).alias("first_ts"),
                      "max_abs", "min_abs")


def _covered(bars: DataFrame, spans: DataFrame, spec: SeriesSpec, t0: str, t1: str) -> DataFrame:
    """(keys, ts, _bar, _c) at every bar, start and end: whether a bar is there, and how many spans cover the time.

    Starts and ends are netted per time, then cumulated: no span meets a bar in a join.
    """
    keys, ts = list(spec.keys), spec.ts
    starts = spans.select(*keys, F.col(t0).alias(ts), F.lit(1).alias("_in"), F.lit(0).alias("_out"), F.lit(0).alias("_bar"))
    ends = spans.where(F.col(t1).isNotNull()).select(
        *keys, F.col(t1).alias(ts), F.lit(0).alias("_in"), F.lit(1).alias("_out"), F.lit(0).alias("_bar"))
    marks = bars.select(*keys, ts, F.lit(0).alias("_in"), F.lit(0).alias("_out"), F.lit(1).alias("_bar"))
    net = starts.unionByName(ends).unionByName(marks).groupBy(*keys, ts).agg(
        F.sum("_in").alias("_in"), F.sum("_out").alias("_out"), F.max("_bar").alias("_bar"))
    summed = running(net, spec, sums={"_sin": F.col("_in"), "_sout": F.col("_out")})
    return summed.select(*keys, ts, "_bar", (F.col("_sin") - (F.col("_sout") - F.col("_out"))).cast("long").alias("_c"))


def label_concurrency(bars: DataFrame, spans: DataFrame, spec: SeriesSpec, t0: str = "t0", t1: str = "t1") -> DataFrame:
    """Number of label spans ``[t0, t1]`` that cover each bar; an open ``t1`` lasts to the end."""
    covered = _covered(bars, spans, spec, t0, t1)
    return covered.where("_bar = 1").select(*spec.keys, spec.ts, F.col("_c").alias("concurrency"))


def average_uniqueness(bars: DataFrame, spans: DataFrame, spec: SeriesSpec, t0: str = "t0", t1: str = "t1", out: str = "weight") -> DataFrame:
    """``spans`` with the mean of one over the concurrency at all bars of their whole life ``[t0, t1]``; null if no bar is in it.

    1 / concurrency and the bars are cumulated along each series, at bars as well as at starts and ends of spans. What a
    span holds is the difference between two look-ups, at its end and before its start, however long it is. An open ``t1`` lasts to the last
    bar. Bars of one time count once; ``ts`` of the bars and the bounds must have one type.
    """
    keys, ts = list(spec.keys), spec.ts
    covered = _covered(bars, spans, spec, t0, t1).withColumn("_u", F.when(F.col("_bar") == 1, 1 / F.greatest(F.col("_c"), F.lit(1))).otherwise(0.0))
    cumulated = stored(running(covered, spec.with_(shared_input=True), sums={"_su": F.col("_u"), "_sn": F.col("_bar")}).select(
        *keys, ts, "_bar", "_u", "_su", "_sn"), "uniqueness")
    last = cumulated.groupBy(*keys).agg(F.max("_su").alias("_last_su"), F.max("_sn").alias("_last_sn"))
    before = cumulated.select(*keys, F.col(ts).alias(t0), (F.col("_su") - F.col("_u")).alias("_u0"), (F.col("_sn") - F.col("_bar")).alias("_n0"))
    upto = cumulated.select(*keys, F.col(ts).alias(t1), F.col("_su").alias("_u1"), F.col("_sn").alias("_n1"))
    found = join_per_key(spans.join(before, [*keys, t0]).join(upto, [*keys, t1], "left"), last, keys, t0)
    n = F.coalesce("_n1", "_last_sn") - F.col("_n0")
    mean = (F.coalesce("_u1", "_last_su") - F.col("_u0")) / F.nullif(n, F.lit(0).cast("long"))
    return found.select(*spans.columns, mean.alias(out))


def start_uniqueness(labelled: DataFrame, spec: SeriesSpec, t1: str = "t1", out: str = "weight") -> DataFrame:
    """Add one over the number of label spans that cover the start of a row's own span."""
    keys = list(spec.keys)
    spans = labelled.select(*keys, F.col(spec.ts).alias("t0"), F.col(t1).alias("t1"))
    covering = label_concurrency(labelled.select(*keys, spec.ts), spans, spec).withColumnRenamed("concurrency", "_c")
    return labelled.join(covering, [*keys, spec.ts]).withColumn(out, 1 / F.greatest(F.col("_c"), F.lit(1))).drop("_c")


def purge_train(train: DataFrame, test: DataFrame, spec: SeriesSpec, t0: str = "t0", t1: str = "t1") -> DataFrame:
    """Train spans that overlap no test span.

    A span overlaps some test span exactly when the latest end among the test spans that start
    no later than its own end is not before its start: one cumulative maximum, no range join.
    """
    keys = list(spec.keys)
    tests = test.select(*keys, F.col(t0).alias("_at"), F.lit(0).alias("_side"), F.col(t1).alias("_end"))
    probes = train.withColumns({"_at": F.col(t1), "_side": F.lit(1)})
    both = probes.unionByName(tests, allowMissingColumns=True)
    ordered = spec.with_(ts="_at", ties=("_side", t0))
    reach = running(both, ordered, maxes={"_reach": F.col("_end")})
    clear = F.col("_reach").isNull() | (F.col("_reach") < F.col(t0))
    return reach.where((F.col("_side") == 1) & clear).select(*train.columns)


def _with_size(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add ``_n`` (rows of the series) to an ordinal frame; one small row per series is joined."""
    sizes = df.groupBy(*spec.keys).agg((F.max(ORD) + 1).alias("_n"), F.max(spec.ts).alias("_last"))
    return join_per_key(df, sizes, list(spec.keys), ORD)


def embargo_times(df: DataFrame, spec: SeriesSpec, pct: float) -> DataFrame:
    """Each time with the time ``int(n * pct)`` rows later, or the last time."""
    rows = _with_size(with_ordinal(df.select(*spec.keys, spec.ts), spec), spec)
    rows = rows.withColumn("_to", F.col(ORD) + F.floor(F.col("_n") * pct))
    targets = rows.select(*spec.keys, F.col(ORD).alias("_to"), F.col(spec.ts).alias("embargo"))
    return rows.join(targets, [*spec.keys, "_to"], "left").select(
        *spec.keys, spec.ts, F.coalesce("embargo", "_last").alias("embargo"))


def fold_of(position: Column, n: Column, k: int) -> Column:
    """Index of the contiguous fold: the first ``n % k`` folds hold one row more."""
    size, extra = F.floor(n / k), n % k
    wide = extra * (size + 1)
    return F.when(position < wide, F.floor(position / (size + 1))).otherwise(
        extra + F.floor((position - wide) / F.greatest(size, F.lit(1)))).cast("int")


def purged_kfold(df: DataFrame, spec: SeriesSpec, t1: str = "t1", k: int = 3, embargo: float = 0.0) -> DataFrame:
    """Role of every row in every fold: test, train, or left out (purged or embargoed).

    Train rows end no later than the test start, or lie from the row of the latest test end
    plus the embargo on. Folds are aggregated to ``k`` rows per series before they are joined.
    """
    keys = list(spec.keys)
    rows = _with_size(with_ordinal(df, spec), spec).withColumn("_fold", fold_of(F.col(ORD), F.col("_n"), k))
    bounds = rows.groupBy(*keys, "_fold").agg(F.min(spec.ts).alias("_start"), F.max(t1).alias("_end"))
    per_series = bounds.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_fold").alias("fold"), F.col("_start").alias("start"),
                                             F.col("_end").alias("end")))).alias("_folds"))
    wide = join_per_key(rows, per_series, keys, ORD).withColumn("_f", F.explode("_folds")).drop("_folds")
    reach = (
        wide.groupBy(*keys, F.col("_f.fold").alias("fold"))
        .agg(F.sum(F.when(F.col(spec.ts) < F.col("_f.end"), 1).otherwise(0)).alias("_resume"))
    )
    # one number per fold and series, at most k per series
    resumes = reach.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("fold", "_resume"))).alias("_resumes"))
    wide = join_per_key(wide, resumes, keys, ORD).withColumn("_from", F.element_at("_resumes", F.col("_f.fold")))
    skip = F.floor(F.col("_n") * embargo)
    before = F.col(t1) <= F.col("_f.start")
    after = (F.col("_from") < F.col("_n")) & (F.col(ORD) >= F.col("_from") + skip)
    in_gap = (F.col("_from") < F.col("_n")) & (F.col(ORD) >= F.col("_from"))
    role = (
        F.when(F.col("_fold") == F.col("_f.fold"), "test").when(before | after, "train")
        .when(in_gap, "embargo").otherwise("purged"))
    return wide.select(*df.columns, F.col("_f.fold").alias("fold"), role.alias("role"))
