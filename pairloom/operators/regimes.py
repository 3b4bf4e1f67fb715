"""Two-state Gaussian hidden Markov model: fit, decode, predict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.columns import argmax
from pairloom.operators import state_scan as S
from pairloom.operators.series import ORD, SeriesSpec, join_per_key, running, with_ordinal
from pairloom.session import stored


@dataclass(frozen=True)
class Regimes:
    start: tuple[float, float]
    transition: tuple[tuple[float, float], tuple[float, float]]
    means: tuple[float, float]
    variances: tuple[float, float]


def _log_density(x: np.ndarray, m: Regimes) -> np.ndarray:
    mu, var = np.array(m.means), np.array(m.variances)
    return -0.5 * (np.log(2 * np.pi * var) + (x[:, None] - mu) ** 2 / var)


def _backward(beta: np.ndarray, a: np.ndarray, e: np.ndarray) -> np.ndarray:
    out = np.empty_like(e)
    out[-1] = beta
    for t in range(len(e) - 2, -1, -1):
        b = a @ (e[t + 1] * out[t + 1])
        out[t] = b / b.sum()
    return out


PARAMETERS = ("start0", "start1", "p00", "p01", "p10", "p11", "mean0", "mean1", "var0", "var1")
#: rows of a group that is reduced to one matrix, and matrices that one fold sees
ROWS, FAN = 512, 1024
#: in a group the less likely state keeps at least this share (log) of a row's density, so no product of a chain becomes zero
TRACE = -300.0


def _numbers(m: Regimes) -> dict[str, float]:
    return dict(zip(PARAMETERS, (*m.start, *m.transition[0], *m.transition[1], *m.means, *m.variances)))


def _chains(rows: DataFrame, spec: SeriesSpec, value: str, size: int, model: Regimes | None) -> DataFrame:
    """Groups of ``size`` rows of a series with ordinal: ``(keys, _pos, _rows, _a)``.

    A row is a struct of position ``o``, time, value and, with a model, the log densities ``l0`` and ``l1`` of the two states; ``_a`` holds
    start and transition probabilities and their logarithms. They come from ``model`` or from columns of ``rows``.
    """
    number = {n: f"DOUBLE({v!r})" for n, v in _numbers(model).items()} if model else {n: f"DOUBLE({n})" for n in PARAMETERS}
    chained = rows.selectExpr(*spec.keys, f"floor({ORD} / {size}) AS _pos", f"{ORD} AS o", f"{spec.ts} AS t", f"DOUBLE({value}) AS x",
                              f"{_moves(number)} AS _m", *[f"{_log_density_of('x', number, j)} AS l{j}" for j in (0, 1)])
    return chained.groupBy(*spec.keys, "_pos").agg(F.expr("sort_array(collect_list(struct(o, t, x, l0, l1))) AS _rows"), F.first("_m").alias("_a"))


def _log_density_of(x: str, number: Mapping[str, str], j: int) -> str:
    return (f"-0.5D * (ln(2 * pi() * {number[f'var{j}']}) + ({x} - {number[f'mean{j}']}) * ({x} - {number[f'mean{j}']}) / {number[f'var{j}']})")


def _moves(number: Mapping[str, str]) -> str:
    probabilities = {n: e for n, e in number.items() if not n.startswith(("mean", "var"))}
    return S.struct(**probabilities, **{f"log_{n}": f"if({e} > 0, ln({e}), {S.NEVER})" for n, e in probabilities.items()})


def _step(row: str, i: int, j: int) -> str:
    """Logarithm of the move from state i to state j of a row; the first row of a series starts the chain instead."""
    return f"if({row}.o = 0, _a.log_start{j}, _a.log_p{i}{j})"


def _matrix(plus: S.Plus) -> str:
    """The steps of all rows of a group in one."""
    cells = {f"m{i}{j}": plus(f"acc.m{i}0 + {_step('x', 0, j)}", f"acc.m{i}1 + {_step('x', 1, j)}") + f" + x.l{j}"
             for i in (0, 1) for j in (0, 1)}
    return f"aggregate(_rows, {S.IDENTITY}, (acc, x) -> {S.struct(**cells)}, m -> {S.less('m')})"


#: densities of a row relative to the likelier state
_DENSITIES = S.let("_h", "greatest(x.l0, x.l1)", S.struct(**{f"d{j}": f"exp(greatest(x.l{j} - _h, {TRACE}D))" for j in (0, 1)}))
#: filtered probabilities of a row from those of the row before, ``acc.p``
_FILTERED = S.let("_d", _DENSITIES, S.shares(S.struct(**{
    f"s{j}": f"if(x.o = 0, _a.start{j}, acc.p.s0 * _a.p0{j} + acc.p.s1 * _a.p1{j}) * _d.d{j}" for j in (0, 1)})))


def _forward(path: bool) -> str:
    """A struct per row of a group from its entry ``_in``: filtered probabilities p0 and p1, for the path the better predecessors
    b0 and b1; ``v`` are the path scores of the last row."""
    start = S.shares(S.struct(s0="exp(_in.sum.s0)", s1="exp(_in.sum.s1)"))
    if not path:
        empty = "cast(array() AS array<struct<p0:double,p1:double>>)"
        step = S.let("_p", _FILTERED, S.struct(p="_p", out=f"array_append(acc.out, {S.struct(p0='_p.s0', p1='_p.s1')})"))
        return f"aggregate(_rows, {S.struct(p=start, out=empty)}, (acc, x) -> {step})"
    empty = "cast(array() AS array<struct<p0:double,p1:double,b0:int,b1:int>>)"
    options = S.struct(**{f"c{i}{j}": f"acc.v.s{i} + {_step('x', i, j)}" for i in (0, 1) for j in (0, 1)})
    row = S.struct(p0="_n.p.s0", p1="_n.p.s1", b0="int(_n.c.c10 > _n.c.c00)", b1="int(_n.c.c11 > _n.c.c01)")
    scores = S.struct(**{f"s{j}": f"greatest(_n.c.c0{j}, _n.c.c1{j}) + x.l{j}" for j in (0, 1)})
    step = S.let("_n", S.struct(p=_FILTERED, c=options), S.struct(p="_n.p", v=scores, out=f"array_append(acc.out, {row})"))
    return f"aggregate(_rows, {S.struct(p=start, v='_in.best', out=empty)}, (acc, x) -> {step})"


#: scores behind a row (shares) from those behind the next, ``acc.q``, whose densities are ``_d``
_EARLIER = S.shares(S.struct(**{f"s{i}": f"_a.p{i}0 * _d.d0 * acc.q.s0 + _a.p{i}1 * _d.d1 * acc.q.s1" for i in (0, 1)}))


def _back_through(time: str) -> str:
    """Output rows of a group, last one first, from the state ``_state`` and the scores ``_exit`` behind its last row."""
    empty = f"cast(array() AS array<struct<t:{time},x:double,state:int,p0:double,p1:double>>)"
    start = S.struct(q=S.shares(S.struct(s0="exp(_exit.s0)", s1="exp(_exit.s1)")), s="_state", out=empty)
    now = S.let("_w", S.shares(S.struct(s0="y._out.p0 * acc.q.s0", s1="y._out.p1 * acc.q.s1")),
                S.struct(t="y._rows.t", x="y._rows.x", state="acc.s", p0="_w.s0", p1="_w.s1"))
    step = S.let("x", "y._rows", S.let("_d", _DENSITIES, S.struct(
        q=_EARLIER, s="if(acc.s = 0, y._out.b0, y._out.b1)", out=f"array_append(acc.out, {now})")))
    return f"aggregate(reverse(arrays_zip(_rows, _out)), {start}, (acc, y) -> {step}, acc -> acc.out)"


def decode(df: DataFrame, spec: SeriesSpec, value: str, model: Regimes | DataFrame, mode: str = "smooth",
           model_keys: Sequence[str] | None = None) -> DataFrame:
    """States and state probabilities of each row with a value.

    ``smooth`` gives the most likely path and probabilities from the whole series; ``filter`` uses only rows up to the
    current one, for the probabilities and for the state, which is the more probable one. Of equally likely states and
    predecessors the lower one is taken. A series is cut into groups of at most ``spec.chunk_rows`` rows, each group is one matrix over
    (max, +) for the path and over (log-add, +) for the probabilities, and a scan of these matrices gives the exact scores with which each
    group is entered and left; then each group runs by itself. All of it is SQL expressions; the groups, and for the path their
    first run, are stored in the shared folder.

    ``model`` is one model for all series, or a table with a row of ``PARAMETERS`` per ``model_keys`` (the keys of the
    series by default); then the output holds the transition probabilities too, and series without a model are left out.
    """
    shared = model if isinstance(model, Regimes) else None
    keys, path = list(spec.keys), mode == "smooth"
    rows = df.where(F.col(value).isNotNull()).select(*keys, spec.ts, value)
    if shared is None:
        by = list(model_keys or keys)
        rows = join_per_key(rows, model.select(*by, *PARAMETERS), by, spec.ts)
    size = min(spec.chunk_rows, ROWS)
    levels = S.levels_for(spec.longest, size, FAN)
    chains = stored(_chains(with_ordinal(rows, spec), spec, value, size, shared), "chains")
    moves = [] if shared else [f"_a.{n} AS {n}" for n in PARAMETERS[2:6]]
    named = [f"_x.t AS {spec.ts}", f"CAST(_x.x AS {df.schema[value].dataType.simpleString()}) AS {value}",
             *[f"_x.{c} AS {c}" for c in ("state", "p0", "p1")]]

    semirings = {"sum": S.log_add, **({"best": S.best_of} if path else {})}
    matrices = chains.selectExpr(*keys, "_pos", S.struct(**{n: _matrix(plus) for n, plus in semirings.items()}) + " AS _m")
    entered = S.entries(matrices, keys, S.together(**{n: S.forward(plus) for n, plus in semirings.items()}), FAN, levels, "_in")
    run = chains.join(entered, [*keys, "_pos"]).selectExpr(*keys, "_pos", "_rows", "_a", f"{_forward(path)} AS _f")
    if not path:
        each = run.selectExpr(*keys, "_a", "explode(arrays_zip(_rows, _f.out)) AS _y")
        x = S.struct(t="_y._rows.t", x="_y._rows.x", state="int(_y.out.p1 > _y.out.p0)", p0="_y.out.p0", p1="_y.out.p1")
        return each.selectExpr(*keys, "_a", f"{x} AS _x").selectExpr(*keys, *named, *moves)

    run = stored(run.selectExpr(*keys, "_pos", "_rows", "_a", "_f.out AS _out", "int(_f.v.s1 > _f.v.s0) AS _end"), "chains-run")
    through = S.struct(**{f"to{j}": f"if(x.b{j} = 0, acc.to0, acc.to1)" for j in (0, 1)})
    maps = run.selectExpr(*keys, "_pos", f"aggregate(_out, {S.MAPS.unit}, (acc, x) -> {through}) AS _m")
    # behind the last group stands a map that leads to the better end whatever comes
    ends = run.groupBy(*keys).agg(F.max(F.struct("_pos", "_end")).alias("_l")).selectExpr(
        *keys, "_l._pos + 1 AS _pos", f"{S.struct(to0='_l._end', to1='_l._end')} AS _m")
    states = S.entries_from_end(maps.unionByName(ends), keys, S.MAPS, FAN, levels, "_state")
    exits = S.entries_from_end(chains.selectExpr(*keys, "_pos", f"{_matrix(S.log_add)} AS _m"), keys, S.backward(S.log_add), FAN, levels, "_exit")
    whole = run.join(states, [*keys, "_pos"]).join(exits, [*keys, "_pos"])
    back = _back_through(df.schema[spec.ts].dataType.simpleString())
    return whole.selectExpr(*keys, "_a", f"explode({back}) AS _x").selectExpr(*keys, *named, *moves)


# Fixed values of the estimator: variance floor of the start, variance prior, stop threshold.
MIN_VARIANCE = 1e-3
VARIANCE_PRIOR = 1e-2
TOLERANCE = 1e-2


def _two_means(x: np.ndarray) -> np.ndarray:
    """Centres of the best split of sorted values into two groups."""
    s = np.sort(x)
    if len(s) < 2:
        return np.repeat(s, 2)
    n = np.arange(1, len(s))
    left, total = np.cumsum(s)[:-1], s.sum()
    gain = left ** 2 / n + (total - left) ** 2 / (len(s) - n)
    cut = int(gain.argmax()) + 1
    return np.array([s[:cut].mean(), s[cut:].mean()])


def fit_window(x: np.ndarray, n_iter: int = 3000) -> tuple[Regimes, float, int]:
    """Maximum likelihood by expectation-maximisation on one short window."""
    var = float(np.var(x, ddof=1)) if len(x) > 1 else 0.0
    m = Regimes((0.5, 0.5), ((0.5, 0.5), (0.5, 0.5)), tuple(_two_means(x)), (var + MIN_VARIANCE,) * 2)
    previous, step = -np.inf, 0
    for step in range(1, n_iter + 1):
        logs = _log_density(x, m)
        top = logs.max(1, keepdims=True)
        e, a = np.exp(logs - top), np.array(m.transition)
        alpha, ll = np.empty_like(e), float(top.sum())
        p = np.array(m.start) * e[0]
        for t in range(len(x)):
            if t:
                p = (alpha[t - 1] @ a) * e[t]
            ll += np.log(p.sum())
            alpha[t] = p / p.sum()
        beta = _backward(np.ones(2), a, e)
        post = alpha * beta
        post /= post.sum(1, keepdims=True)
        moves = np.zeros((2, 2))
        for t in range(len(x) - 1):
            xi = alpha[t][:, None] * a * (e[t + 1] * beta[t + 1])
            moves += xi / xi.sum()
        weight = post.sum(0)
        mu = (post * x[:, None]).sum(0) / weight
        variance = (VARIANCE_PRIOR + (post * (x[:, None] - mu) ** 2).sum(0)) / weight
        left = moves.sum(1, keepdims=True)
        trans = np.where(left > 0, moves / np.where(left > 0, left, 1), a)  # a state that is never left keeps its row
        m = Regimes(tuple(post[0]), tuple(map(tuple, trans)), tuple(mu), tuple(variance))
        if ll - previous < TOLERANCE:
            break
        previous = ll
    return m, ll, step


FIT_COLUMNS = (*PARAMETERS, "log_likelihood")


def fit(df: DataFrame, spec: SeriesSpec, value: str, roll: int | None = 40, n_iter: int = 3000) -> DataFrame:
    """Model of every series by expectation-maximisation; state 0 has the lower mean.

    With ``roll`` it is fitted to the last ``roll`` values of a series, one small group each. With None it is fitted to all of them, by
    ``fit_series``. Both start from the best split of the values in two groups and stop when a step gains less than ``TOLERANCE``.
    """
    return fit_series(df, spec, value, n_iter) if roll is None else _fit_tails(df, spec, value, roll, n_iter)


def _fit_tails(df: DataFrame, spec: SeriesSpec, value: str, roll: int, n_iter: int) -> DataFrame:
    """A group holds ``roll`` rows, whatever the length of its series."""
    rows = with_ordinal(df.where(F.col(value).isNotNull()).select(*spec.keys, spec.ts, value), spec)
    sizes = rows.groupBy(*spec.keys).agg((F.max(ORD) + 1).alias("_n"))
    tail = join_per_key(rows, sizes, list(spec.keys), ORD).where(F.col(ORD) >= F.col("_n") - roll)
    keys = list(spec.keys)

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(ORD)[value].to_numpy(float)
        m, ll, steps = fit_window(x, n_iter)
        o = [0, 1] if m.means[0] <= m.means[1] else [1, 0]
        t = np.array(m.transition)[np.ix_(o, o)]
        numbers = [m.start[o[0]], m.start[o[1]], *t.ravel(), m.means[o[0]], m.means[o[1]],
                   m.variances[o[0]], m.variances[o[1]], ll]
        row = {**{k: pdf[k].iloc[0] for k in keys}, **dict(zip(FIT_COLUMNS, numbers)), "steps": steps}
        return pd.DataFrame([row])

    schema = ", ".join([f"{k} {df.schema[k].dataType.simpleString()}" for k in keys]
                       + [f"{c} double" for c in FIT_COLUMNS] + ["steps int"])
    return tail.groupBy(*keys).applyInPandas(per_series, schema)


#: quantiles between which a task sorts the values of a series
CUTS = 256


def two_groups(rows: DataFrame, spec: SeriesSpec, value: str) -> DataFrame:
    """Start of a fit: means of the best split of the values of each series in two groups, and their variance.

    Every cut between neighbouring values is tried: its gain follows from cumulative counts and sums over the distinct values, which are
    sorted between quantiles, not in one task a series. ``shift`` is the mean of the series.
    """
    keys = list(spec.keys)
    totals = rows.groupBy(*keys).agg(
        F.count(value).alias("_n"), F.avg(value).alias("shift"), F.coalesce(F.var_samp(value), F.lit(0.0)).alias("_var"),
        F.percentile_approx(value, [k / CUTS for k in range(1, CUTS)], 10_000).alias("_cuts"))
    distinct = join_per_key(rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")), totals, keys, value)
    distinct = distinct.selectExpr(*keys, value, "_c", "shift", "_n", "_var", f"size(filter(_cuts, c -> c < {value})) AS _b",
                                   f"_c * ({value} - shift) AS _s")
    along = spec.with_(ts=value, ties=(), bucket=lambda _: F.col("_b"), shared_input=True)
    summed = running(distinct, along, sums={"_cn": F.col("_c"), "_cs": F.col("_s")})
    # around the mean of the series all sums end at zero, so the upper group has the negative sum of the lower one
    gain = F.when(F.col("_cn") < F.col("_n"), F.col("_cs") * F.col("_cs") * (1 / F.col("_cn") + 1 / F.nullif(F.col("_n") - F.col("_cn"), F.lit(0))))
    best = summed.groupBy(*keys).agg(
        F.max_by(F.struct("_cn", "_cs"), F.when(gain.isNotNull(), F.struct(gain, -F.col("_cn")))).alias("_best"),
        *[F.first(c).alias(c) for c in ("_n", "shift", "_var")])
    return best.selectExpr(
        *keys, "shift", "coalesce(shift + _best._cs / _best._cn, shift) AS mean0", "coalesce(shift - _best._cs / (_n - _best._cn), shift) AS mean1",
        f"_var + {MIN_VARIANCE}D AS var")


#: sums of a group over its rows, last one first: states (g), values (x) and squares (xx) by state, moves (m), states of the first row (f)
_COUNTS = ("g0", "g1", "x0", "x1", "xx0", "xx1", "m00", "m01", "m10", "m11", "f0", "f1")


def _counts() -> str:
    now = S.shares(S.struct(s0="y._out.p0 * acc.q.s0", s1="y._out.p1 * acc.q.s1"))
    weights = {f"w{i}{j}": f"y._from.p{i} * _a.p{i}{j} * _d.d{j} * acc.q.s{j}" for i in (0, 1) for j in (0, 1)}
    total = "(_m.w00 + _m.w01 + _m.w10 + _m.w11)"
    added = {**{f"g{j}": f"acc.g{j} + _w.s{j}" for j in (0, 1)}, **{f"x{j}": f"acc.x{j} + _w.s{j} * x.c" for j in (0, 1)},
             **{f"xx{j}": f"acc.xx{j} + _w.s{j} * x.c * x.c" for j in (0, 1)},
             **{f"m{i}{j}": f"acc.m{i}{j} + if(x.o = 0, 0D, _m.w{i}{j} / {total})" for i in (0, 1) for j in (0, 1)},
             **{f"f{j}": f"acc.f{j} + if(x.o = 0, _w.s{j}, 0D)" for j in (0, 1)}}
    step = S.let("x", "y._rows", S.let("_d", _DENSITIES, S.let("_w", now, S.let("_m", S.struct(**weights), S.struct(q=_EARLIER, **added)))))
    start = S.struct(q=S.shares(S.struct(s0="exp(_exit.s0)", s1="exp(_exit.s1)")), **{c: "0D" for c in _COUNTS})
    return f"aggregate(reverse(arrays_zip(_rows, _out, _from)), {start}, (acc, y) -> {step})"


def _weighed() -> str:
    """Filtered probabilities of a group's rows, those before its first row in front, and the log likelihood of the rows."""
    scores = S.struct(**{f"s{j}": f"if(x.o = 0, _a.start{j}, acc.p.s0 * _a.p0{j} + acc.p.s1 * _a.p1{j}) * _d.d{j}" for j in (0, 1)})
    row = S.struct(p0="_p.s0", p1="_p.s1")
    step = S.let("_d", _DENSITIES, S.let("_s", scores, S.let("_p", S.shares("_s"), S.struct(
        p="_p", ll="acc.ll + ln(_s.s0 + _s.s1) + greatest(x.l0, x.l1)", out=f"array_append(acc.out, {row})"))))
    start = S.let("_p", S.shares(S.struct(s0="exp(_in.s0)", s1="exp(_in.s1)")), S.struct(
        p="_p", ll="0D", out=f"array({row})"))
    return f"aggregate(_rows, {start}, (acc, x) -> {step})"


def fit_series(df: DataFrame, spec: SeriesSpec, value: str, n_iter: int = 3000) -> DataFrame:
    """Model of all values of every series, however long, all series at once.

    Rows are stored once in groups. A step makes one matrix of each group, scans them from both ends for the scores with which the group is
    entered and left, adds up its expected states and moves, and sums those by key. Only the models, one small row a series, go
    from step to step, as a stored table; the driver sees how many series still gain. Series that no longer gain take no part.
    """
    keys = list(spec.keys)
    size = min(spec.chunk_rows, ROWS)
    levels = S.levels_for(spec.longest, size, FAN)
    known = df.where(F.col(value).isNotNull()).select(*keys, spec.ts, value)
    rows = with_ordinal(known, spec).selectExpr(*keys, f"floor({ORD} / {size}) AS _pos", f"{ORD} AS o", f"DOUBLE({value}) AS x")
    groups = stored(rows.groupBy(*keys, "_pos").agg(F.expr("sort_array(collect_list(struct(o, x))) AS _values")), "fit-groups")
    values = groups.selectExpr(*keys, "_pos", "explode(_values) AS _v").selectExpr(*keys, "_v.x AS x")
    number = {n: n for n in PARAMETERS}
    models = stored(two_groups(values, spec, "x").selectExpr(
        *keys, "shift", "0.5D AS start0", "0.5D AS start1", *[f"0.5D AS p{i}{j}" for i in (0, 1) for j in (0, 1)], "mean0", "mean1",
        "var AS var0", "var AS var1", f"{S.NEVER} AS log_likelihood", "0 AS steps", "true AS gains"), "models")

    row = S.struct(o="r.o", c="r.x - shift", l0=_log_density_of("r.x", number, 0), l1=_log_density_of("r.x", number, 1))
    for _ in range(n_iter):
        ready = join_per_key(groups, models.where("gains"), keys, "_pos").selectExpr(
            *keys, "_pos", f"transform(_values, r -> {row}) AS _rows", f"{_moves(number)} AS _a")
        matrices = ready.selectExpr(*keys, "_pos", f"{_matrix(S.log_add)} AS _m")
        entered = S.entries(matrices, keys, S.forward(S.log_add), FAN, levels, "_in")
        left = S.entries_from_end(matrices, keys, S.backward(S.log_add), FAN, levels, "_exit")
        run = ready.join(entered, [*keys, "_pos"]).join(left, [*keys, "_pos"]).selectExpr(*keys, "_rows", "_a", "_exit", f"{_weighed()} AS _f")
        run = run.selectExpr(*keys, "_rows", "_a", "_exit", "_f.ll AS ll", "slice(_f.out, 2, size(_rows)) AS _out", "slice(_f.out, 1, size(_rows)) AS _from")
        sums = run.selectExpr(*keys, "ll", f"{_counts()} AS _s").groupBy(*keys).agg(
            F.sum("ll").alias("ll"), *[F.sum(f"_s.{c}").alias(c) for c in _COUNTS])
        moved = {f"p{i}{j}": f"if(m{i}0 + m{i}1 > 0, m{i}{j} / nullif(m{i}0 + m{i}1, 0D), p{i}{j})" for i in (0, 1) for j in (0, 1)}
        better = models.where("gains").join(sums, keys).selectExpr(
            *keys, "shift", "f0 AS start0", "f1 AS start1", *[f"{e} AS {n}" for n, e in moved.items()],
            *[f"shift + x{j} / g{j} AS mean{j}" for j in (0, 1)], *[f"({VARIANCE_PRIOR}D + greatest(xx{j} - x{j} * x{j} / g{j}, 0D)) / g{j} AS var{j}" for j in (0, 1)],
            "ll AS log_likelihood", "steps + 1 AS steps", f"NOT ll - log_likelihood < {TOLERANCE}D AS gains")
        models = stored(models.where("NOT gains").unionByName(better), "models")
        if models.where("gains").isEmpty():
            break
    first, second = ("mean0 <= mean1", "mean0 > mean1")
    swapped = {f"{n}{j}": f"if({first}, {n}{j}, {n}{1 - j})" for n in ("start", "mean", "var") for j in (0, 1)}
    swapped |= {f"p{i}{j}": f"if({second}, p{1 - i}{1 - j}, p{i}{j})" for i in (0, 1) for j in (0, 1)}
    return models.selectExpr(*keys, *[f"{swapped[n]} AS {n}" for n in PARAMETERS], "log_likelihood", "steps")


def _powers(p: Sequence[Sequence[float]], ahead: int, power: str) -> list[np.ndarray]:
    m = np.array(p, dtype=float)
    if power == "elementwise":
        return [m ** t for t in range(1, ahead + 1)]
    return [np.linalg.matrix_power(m, t) for t in range(1, ahead + 1)]


def _products(transition, ahead: int, power: str, probs: Sequence[str]):
    for t, m in enumerate(_powers(transition, ahead, power), start=1):
        yield t, [sum((F.col(p) * float(m[i, s]) for i, p in enumerate(probs)), F.lit(0.0)) for s in range(m.shape[1])]


def transition_probs(df: DataFrame, transition, ahead: int, probs: Sequence[str] = ("p0", "p1"),
                     power: str = "matrix") -> DataFrame:
    """Probability of each state but the last, 1..``ahead`` steps on.

    ``power="elementwise"`` raises the single entries instead of the matrix.
    """
    cols = {}
    for t, out in _products(transition, ahead, power, probs):
        cols.update({f"transition_{t}_{s}": c for s, c in enumerate(out[:-1])})
    return df.withColumns(cols)


def next_state(df: DataFrame, transition, ahead: int, probs: Sequence[str] = ("p0", "p1"),
               power: str = "matrix") -> DataFrame:
    """Most probable state 1..``ahead`` steps on."""
    return df.withColumns({f"next_state_{t}": argmax(F.array(*out))
                           for t, out in _products(transition, ahead, power, probs)})


def next_state_by_row(df: DataFrame, ahead: int) -> DataFrame:
    """Like ``next_state`` with the transition probabilities in the columns p00, p01, p10 and p11."""
    now, out = (F.col("p0"), F.col("p1")), {}
    for t in range(1, ahead + 1):
        now = tuple(now[0] * F.col(f"p0{j}") + now[1] * F.col(f"p1{j}") for j in (0, 1))
        out[f"next_state_{t}"] = argmax(F.array(*now))
    return df.withColumns(out)
