"""Building blocks for ordered series whose length is not bounded by one task.

A series is the set of rows that share ``keys``, ordered by ``ts``. A plain
``Window.partitionBy(keys)`` puts a whole series into one task; with few keys (or one hot
key) that task grows with the data. The functions here split every series along its order:

* ``running``      cumulative sum / last / max: per time bucket, plus one carry row per bucket
* ``with_ordinal`` dense 0-based position, a cumulative count
* ``sliding``      windows bounded in rows: fixed-size chunks plus a halo of neighbour rows
* ``time_sliding`` windows bounded in time: time slices plus a halo of neighbour rows
* ``affine_scan``  recurrences ``y = a*y_prev + b``: scaled sums per group plus carries, level by level

Only per-bucket or per-chunk summaries ever meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORD = "_ord"
#: factors below this leave less of the past than doubles can show
NOTHING = 1e-20
CHUNK = "_chunk"
HOME = "_home"
_BUCKET = "_bucket"


@dataclass(frozen=True)
class SeriesSpec:
    """How a frame is split into ordered series.

    ``(keys, ts, ties)`` must be unique and ``keys`` not null. ``bucket_days`` is the width of
    the slices used by ``running`` and ``time_sliding``: choose it so that a slice of the busiest
    series fits a task (the default suits daily rows; minutes or less suit ticks). The number of
    slices is bounded by the time span, not by the rows. Give ``bucket`` instead when ``ts`` is
    not a date or time. ``chunk_rows`` is the number of home rows of one chunk of ``sliding``.
    Times are cut in the session time zone, which should be UTC.

    ``running`` reads its input twice, once for the carries. A stored table is best read twice
    with the few columns each use needs. ``shared_input`` says that the input comes out of a
    shuffle instead: both uses then keep all columns, so that Spark runs that shuffle once.
    ``longest`` is a number of rows that no series exceeds; ``affine_scan`` folds in as many
    levels as that takes.
    """

    keys: tuple[str, ...]
    ts: str
    ties: tuple[str, ...] = ()
    bucket_days: float = 1024
    bucket: Callable[[Column], Column] | None = None
    chunk_rows: int = 8192
    shared_input: bool = False
    longest: int = 500_000_000

    @property
    def order(self) -> list[str]:
        return [self.ts, *self.ties]

    def with_(self, **changes) -> SeriesSpec:
        return replace(self, **changes)


def _time_slice(df: DataFrame, ts: str, days: float) -> Column:
    """Index of the slice of ``days`` that holds ``ts``."""
    if isinstance(df.schema[ts].dataType, T.DateType):
        return F.floor(F.unix_date(ts) / F.lit(days)).cast("long")
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(days * 86_400e6)).cast("long")


def _bucket_of(df: DataFrame, spec: SeriesSpec) -> Column:
    """Slice of a row; never null, so that no join adds a filter for it."""
    if spec.bucket is not None:
        return F.coalesce(spec.bucket(F.col(spec.ts)).cast("long"), F.lit(0).cast("long"))
    return F.coalesce(_time_slice(df, spec.ts, spec.bucket_days), F.lit(0).cast("long"))


def _whole_rows(df: DataFrame) -> DataFrame:
    """All rows, by a condition that always holds but needs every column."""
    return df.where(F.xxhash64(*df.columns) >= F.lit(-(1 << 63)))


def running(
    df: DataFrame,
    spec: SeriesSpec,
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    prevs: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add cumulative columns from the start of each series up to the current row.

    ``sums`` and ``maxes`` skip nulls, ``lasts`` is the latest non-null value including the
    current row, ``prevs`` the latest one strictly before it. Each bucket is reduced to one
    carry row before anything is ordered across buckets; the carry join and the in-bucket
    window share one partitioning.
    """
    specs: list[tuple[str, str, Column]] = []
    for kind, group in (("sum", sums), ("last", lasts), ("prev", prevs), ("max", maxes)):
        specs += [(kind, name, col) for name, col in (group or {}).items()]
    keys = list(spec.keys)
    base = df.select("*", _bucket_of(df, spec).alias(_BUCKET),
                     *[c.alias(f"_in{i}") for i, (_, _, c) in enumerate(specs)])

    if spec.shared_input:
        # equal plans for both uses below: the same filters and the same columns
        for k in keys:
            base = base.where(F.col(k).isNotNull())
        base = _whole_rows(base)

    position = F.struct(*spec.order)
    totals = []
    for i, (kind, _, _) in enumerate(specs):
        v = F.col(f"_in{i}")
        if kind == "sum":
            total = F.sum(v)
        elif kind == "max":
            total = F.max(v)
        else:
            total = F.max_by(v, F.when(v.isNotNull(), position))
        totals.append(total.alias(f"_t{i}"))
    before = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = []
    for i, (kind, _, _) in enumerate(specs):
        t = F.col(f"_t{i}")
        fn = {"sum": F.sum, "max": F.max}.get(kind, lambda c: F.last(c, ignorenulls=True))
        carry.append(fn(t).over(before).alias(f"_c{i}"))
    carries = base.groupBy(*keys, _BUCKET).agg(*totals).select(*keys, _BUCKET, *carry)

    inside = Window.partitionBy(*keys, _BUCKET).orderBy(*spec.order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = []
    for i, (kind, name, _) in enumerate(specs):
        v, c = F.col(f"_in{i}"), F.col(f"_c{i}")
        if kind == "sum":
            s = F.sum(v).over(upto)
            col = F.coalesce(s + c, s, c)
        elif kind == "max":
            col = F.greatest(F.max(v).over(upto), c)
        elif kind == "last":
            col = F.coalesce(F.last(v, ignorenulls=True).over(upto), c)
        else:
            strictly = inside.rowsBetween(Window.unboundedPreceding, -1)
            col = F.coalesce(F.last(v, ignorenulls=True).over(strictly), c)
        out.append(col.alias(name))
    kept = [c for c in df.columns if c not in {name for _, name, _ in specs}]
    return base.join(carries, keys + [_BUCKET]).select(*kept, *out)


def with_ordinal(df: DataFrame, spec: SeriesSpec, name: str = ORD) -> DataFrame:
    """Add the dense 0-based position of each row in its series."""
    return running(df, spec, sums={name: F.lit(1).cast("long")}).withColumn(name, F.col(name) - 1)


def sliding(
    df: DataFrame,
    spec: SeriesSpec,
    back: int,
    fn: Callable[[DataFrame, WindowSpec], DataFrame],
    ahead: int = 0,
    keep_ordinal: bool = False,
) -> DataFrame:
    """Run window expressions that look at most ``back`` rows back and ``ahead`` rows ahead.

    ``fn`` gets the chunked frame and its window; nested windows add up their reach. Rows near
    a chunk edge are sent to the neighbour chunks as well and dropped again afterwards.
    """
    if ORD not in df.columns:
        df = with_ordinal(df, spec)
    size = F.lit(spec.chunk_rows)
    first = F.greatest(F.floor((F.col(ORD) - ahead) / size), F.lit(0))
    chunked = df.withColumn(CHUNK, F.explode(F.sequence(first, F.floor((F.col(ORD) + back) / size))))
    w = Window.partitionBy(*spec.keys, CHUNK).orderBy(ORD)
    out = fn(chunked, w).where(F.floor(F.col(ORD) / size) == F.col(CHUNK)).drop(CHUNK)
    return out if keep_ordinal else out.drop(ORD)


def time_slices(df: DataFrame, spec: SeriesSpec, back_days: float = 0, ahead_days: float = 0) -> DataFrame:
    """Every row once in its own time slice (``_home``) and once in each slice that reaches it (``_chunk``)."""
    days = max(spec.bucket_days, back_days, ahead_days)

    def shifted(delta: float) -> Column:
        if isinstance(df.schema[spec.ts].dataType, T.DateType):
            return F.floor((F.unix_date(spec.ts) + delta) / F.lit(days)).cast("long")
        micros = F.unix_micros(F.col(spec.ts).cast("timestamp"))
        return F.floor((micros + F.lit(delta * 86_400e6)) / F.lit(days * 86_400e6)).cast("long")

    chunked = df.withColumn(CHUNK, F.explode(F.sequence(shifted(-ahead_days), shifted(back_days))))
    return chunked.withColumn(HOME, shifted(0) == F.col(CHUNK))


def time_sliding(
    df: DataFrame,
    spec: SeriesSpec,
    fn: Callable[[DataFrame, WindowSpec], DataFrame],
    back_days: float = 0,
    ahead_days: float = 0,
) -> DataFrame:
    """Like ``sliding`` for windows bounded in time; needs no ordinal."""
    w = Window.partitionBy(*spec.keys, CHUNK).orderBy(*spec.order)
    return fn(time_slices(df, spec, back_days, ahead_days), w).where(F.col(HOME)).drop(CHUNK, HOME)


_SALT = "_salt"


def join_per_key(df: DataFrame, values: DataFrame, keys: Sequence[str], by: str, how: str = "inner", salts: int = 64) -> DataFrame:
    """Join ``values``, one small row per series, to the rows of the series.

    A join on ``keys`` alone has as many busy tasks as there are series. Here a hash of ``by``, a column that differs within
    a series, splits the rows of each key, and the small rows are repeated for each part.
    """
    parted = df.withColumn(_SALT, F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    repeated = values.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return parted.join(repeated, [*keys, _SALT], how).drop(_SALT)


def affine_scan(
    df: DataFrame,
    spec: SeriesSpec,
    scans: Mapping[str, tuple[Column, Column]],
    rows: int = 512,
    fan: int = 1024,
    levels: int | None = None,
) -> DataFrame:
    """Add ``y_t = a_t * y_{t-1} + b_t`` (``y_{-1} = 0``) for every ``name: (a, b)`` in ``scans``.

    Needs the ordinal column, ``b`` without nulls, ``a`` not negative and the logarithms of any
    ``rows`` consecutive ``a`` of at least ``NOTHING`` to add up to less than 700 in size (decays
    down to 1/3 per row with the default). A smaller ``a`` lets nothing of the past through: the
    recurrence starts anew. Inside a group of ``rows`` rows the recurrence is a scaled cumulative
    sum. Group results are pairs ``(A, B)`` that compose associatively; they are folded in
    groups of ``fan``, again in groups of ``fan``, and so on, and carried back. There are as many
    levels as the longest series needs (``spec.longest``), so no fold sees more than ``fan`` rows.
    """
    names, keys, each = list(scans), list(spec.keys), range(len(scans))
    if levels is None:
        levels, held = 1, rows * fan
        while held < spec.longest:
            levels, held = levels + 1, held * fan
    grouped = df.select(
        *keys, F.col(ORD).alias("_pos"), _group_of(F.col(ORD), rows).alias("_group"),
        F.when(F.col(ORD) >= 0, F.struct(*[F.col(c) for c in df.columns])).alias("_row"),
        *[F.when(a.cast("double") >= NOTHING, F.ln(a.cast("double"))).alias(f"l{i}") for i, (a, _) in enumerate(scans.values())],
        *[b.cast("double").alias(f"b{i}") for i, (_, b) in enumerate(scans.values())],
    )
    # The frame is used twice below, for the rows and for the group results. Equal plans let
    # Spark run its exchange once, so both ask for keys that are not null (as joins do) and both
    # need the whole row (else each would be pruned to its own columns).
    for c in keys:
        grouped = grouped.where(F.col(c).isNotNull())
    upto = Window.partitionBy(*keys, "_group").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    # a null logarithm marks a new start; what was summed before the latest one is taken off again
    local = (
        grouped.withColumns({f"n{i}": F.col(f"l{i}").isNull() for i in each})
        .withColumns({f"l{i}": F.coalesce(F.sum(f"l{i}").over(upto), F.lit(0.0)) for i in each})
        .withColumns({f"t{i}": F.col(f"b{i}") * F.exp(-F.col(f"l{i}")) for i in each})
        .withColumns({f"b{i}": F.sum(f"t{i}").over(upto) for i in each})
        .withColumns({f"o{i}": F.last(F.when(F.col(f"n{i}"), F.col(f"b{i}") - F.col(f"t{i}")), ignorenulls=True).over(upto) for i in each})
        .where(F.col("_row").isNotNull())
        .select(*keys, "_pos", "_group", "_row", *[F.when(F.col(f"o{i}").isNull(), F.exp(f"l{i}")).otherwise(0.0).alias(f"a{i}") for i in each],
                *[(F.exp(f"l{i}") * (F.col(f"b{i}") - F.coalesce(f"o{i}", F.lit(0.0)))).alias(f"b{i}") for i in each])
    )
    last = F.max_by(F.struct(*[f"{c}{i}" for i in each for c in "ab"]), "_pos").alias("_last")
    tops = local.groupBy(*keys, "_group").agg(last).select(
        *keys, F.col("_group").alias("_pos"), *[F.col(f"_last.{c}{i}").alias(f"{c}{i}") for i in each for c in "ab"])
    entries = _entry_values(tops, keys, len(names), fan, levels - 1).withColumnRenamed("_pos", "_group")
    kept = [F.col(f"_row.{c}").alias(c) for c in df.columns if c not in names]
    return local.join(entries, keys + ["_group"]).select(
        *kept, *[(F.col(f"b{i}") + F.col(f"a{i}") * F.col(f"y{i}")).alias(n) for i, n in enumerate(names)])


def _group_of(position: Column, size: int) -> Column:
    """Index of the group of ``size`` positions; never null, so no join adds a filter for it."""
    return F.coalesce(F.floor(position / size), F.lit(0).cast("long"))


def _entry_values(df: DataFrame, keys: list[str], n: int, fan: int, level: int) -> DataFrame:
    """Values with which each row ``(keys, _pos, a0, b0, a1, b1, ...)`` is entered: ``y0, y1, ...``"""
    each = range(n)
    fields = ["_pos", *[f"{c}{i}" for i in each for c in "ab"]]
    identity = ", ".join(f"'A{i}', 1D, 'B{i}', 0D" for i in each)
    composed = ", ".join(
        f"'A{i}', element_at(acc, -1).A{i} * x.a{i}, 'B{i}', x.a{i} * element_at(acc, -1).B{i} + x.b{i}" for i in each)
    prefix = (f"aggregate(_rows, array(named_struct({identity})), "
              f"(acc, x) -> array_append(acc, named_struct({composed})))")

    group = F.lit(0).cast("long") if level == 0 else _group_of(F.col("_pos"), fan)
    folded = (
        df.groupBy(*keys, group.alias("_group"))
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_rows"))
        .selectExpr(*keys, "_group", "_rows", f"{prefix} AS _prefix")
    )
    if level == 0:
        entered, entry = folded, ["0D" for _ in each]
    else:
        tops = folded.selectExpr(
            *keys, "_group AS _pos", *[f"element_at(_prefix, -1).{c.upper()}{i} AS {c}{i}" for i in each for c in "ab"])
        above = _entry_values(tops, keys, n, fan, level - 1).withColumnRenamed("_pos", "_group")
        entered, entry = folded.join(above, keys + ["_group"]), [f"y{i}" for i in each]
    # element i of _prefix composes the rows before row i
    exploded = entered.selectExpr(
        *keys, *[f"{c} AS _k{i}" for i, c in enumerate(entry)],
        "explode(arrays_zip(_rows, slice(_prefix, 1, size(_rows)))) AS _x")
    return exploded.selectExpr(
        *keys, "_x._rows._pos AS _pos", *[f"_x.`1`.B{i} + _x.`1`.A{i} * _k{i} AS y{i}" for i in each])
