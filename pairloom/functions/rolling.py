"""Rolling statistics bounded in rows; use them inside ``operators.series.sliding``.

Each factory describes one statistic and states how many rows back it reaches; ``add`` puts
any number of them on a chunked frame. A sum over the last n rows is the difference of two
cumulative sums of the chunk, so a row costs the same for any n; Spark would otherwise add up
the whole frame again for every row. All statistics given to one ``add`` share their window
passes. Values are shifted by the first value of the chunk where that keeps precision.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pairloom.functions.columns import ratio


def so_far(w: WindowSpec) -> WindowSpec:
    """Frame from the start of the chunk."""
    return w.rowsBetween(Window.unboundedPreceding, 0)


def change(x: Column, w: WindowSpec) -> Column:
    """Difference to the previous row (1 row back)."""
    return x - F.lag(x).over(w)


Columns = dict[str, Column]


@dataclass(frozen=True)
class Sums:
    """Window sums of one statistic: differences of cumulative sums."""

    name: str

    def _at(self, term: str, n: int) -> Column:
        return F.col(self.name)[term] if n == 0 else F.coalesce(F.col(f"{self.name}_{n}")[term], F.lit(0))

    def last(self, term: str, n: int, skip: int = 0) -> Column:
        """Sum over the last ``n`` rows, without the ``skip`` newest of them."""
        return self._at(term, skip) - self._at(term, n)


@dataclass(frozen=True)
class Rolling:
    """One statistic: columns to prepare, terms to cumulate, earlier rows to look up, results.

    ``prepare`` and ``results`` are stages; a stage may use the columns of the stages before.
    Only the columns of the last result stage stay.
    """

    name: str
    terms: Columns
    lags: Sequence[int]
    results: Callable[[Sums, WindowSpec], list[Columns]]
    prepare: list[Callable[[WindowSpec], Columns]] = field(default_factory=list)


def add(d: DataFrame, w: WindowSpec, *stats: Rolling) -> DataFrame:
    """Add several statistics in shared window passes."""
    helpers: set[str] = set()

    def stage(d: DataFrame, columns: Columns, keep: Columns | None = None) -> DataFrame:
        helpers.update(set(columns) - set(keep or {}))
        return d.withColumns(columns) if columns else d

    for i in range(max((len(s.prepare) for s in stats), default=0)):
        d = stage(d, {k: c for s in stats if i < len(s.prepare) for k, c in s.prepare[i](w).items()})
    upto = so_far(w)
    d = stage(d, {s.name: F.struct(*[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(k) for k, c in s.terms.items()])
                  for s in stats})
    d = stage(d, {f"{s.name}_{n}": F.lag(s.name, n).over(w) for s in stats for n in sorted(set(s.lags))})
    results = [s.results(Sums(s.name), w) for s in stats]
    kept = {k: c for r in results for k, c in r[-1].items()}
    for i in range(max(len(r) for r in results)):
        d = stage(d, {k: c for r in results if i < len(r) for k, c in r[i].items()}, kept)
    return d.drop(*helpers)


def _one(x: Column) -> Column:
    return F.when(x.isNotNull(), 1)


def _shift(x: Column, w: WindowSpec) -> Column:
    return F.first(x, ignorenulls=True).over(so_far(w))


def moving_avg(x: Column, out: str, n: int = 21, partial: bool = True) -> Rolling:
    """Mean of the last ``n`` rows (n rows back); ``partial`` also averages shorter starts."""
    base = f"_b_{out}"

    def results(s: Sums, w: WindowSpec) -> list[Columns]:
        count = s.last("n", n)
        mean = F.col(base) + ratio(s.last("s", n), count)
        return [{out: mean if partial else F.when(count == n, mean)}]

    return Rolling(f"_avg_{out}", {"s": x - F.col(base), "n": _one(x)}, [n], results,
                   [lambda w: {base: _shift(x, w)}])


def moments(x: str, mean: str, std: str, n: int) -> Rolling:
    """Mean and sample deviation of ``n`` complete rows (n rows back).

    A window whose values are all equal has deviation exactly 0.
    """
    v, base, step = F.col(x), f"_b_{mean}", f"_step_{mean}"
    c = v - F.col(base)

    def results(s: Sums, w: WindowSpec) -> list[Columns]:
        whole, total = s.last("n", n) == n, s.last("s", n)
        var = F.greatest((s.last("ss", n) - total * total / n) / (n - 1), F.lit(0.0))
        dev = F.when(s.last("steps", n - 1) == 0, 0.0).otherwise(F.sqrt(var))
        return [{mean: F.when(whole, F.col(base) + total / n), std: F.when(whole, dev)}]

    return Rolling(f"_mom_{mean}", {"s": c, "ss": c * c, "n": _one(v), "steps": F.col(step)}, [n, n - 1], results,
                   [lambda w: {base: _shift(v, w), step: F.when(v != F.lag(v).over(w), 1).otherwise(0)}])


def entropy(x: Column, out: str, n: int = 30, values: Sequence = (-1.0, 0.0, 1.0)) -> Rolling:
    """Base-2 Shannon entropy of the frequencies of ``values`` in ``n`` complete rows (n rows back)."""
    def results(s: Sums, w: WindowSpec) -> list[Columns]:
        total, seen = F.lit(0.0), F.lit(0)
        for i in range(len(values)):
            c = s.last(f"v{i}", n)
            p = c / F.lit(float(n))
            total, seen = total - F.when(c > 0, p * F.log2(p)).otherwise(0.0), seen + c
        return [{out: F.when(seen == n, total)}]

    return Rolling(f"_ent_{out}", {f"v{i}": F.when(x == F.lit(v), 1) for i, v in enumerate(values)}, [n], results)


def entropy_any(x: Column, w: WindowSpec, n: int = 30) -> Column:
    """The same for values not known beforehand; gathers the window of each row (n - 1 rows back)."""
    seen = F.collect_list(x).over(w.rowsBetween(-(n - 1), 0))
    share = lambda v: F.size(F.filter(seen, lambda u: u == v)) / F.lit(float(n))
    total = F.aggregate(F.array_distinct(seen), F.lit(0.0), lambda acc, v: acc - share(v) * F.log2(share(v)))
    return F.when(F.size(seen) == n, total)


def roll_spread(x: str, out: str, n: int = 20) -> Rolling:
    """Roll's effective spread from the serial covariance of ``n`` changes (n rows back).

    The lagged series is taken inside the window with 0 in front, so it has one product less;
    rows without a full window give 0.
    """
    v, product = F.col(x), f"_prod_{out}"

    def results(s: Sums, w: WindowSpec) -> list[Columns]:
        cov = (s.last("p", n - 1) - s.last("x", n) * s.last("x", n, skip=1) / n) / (n - 1)
        value = F.when(s.last("n", n) == n, F.sqrt(F.greatest(F.lit(0.0), -cov)))
        return [{out: F.coalesce(value, F.lit(0.0))}]

    return Rolling(f"_roll_{out}", {"x": v, "p": F.col(product), "n": _one(v)}, [1, n - 1, n], results,
                   [lambda w: {product: v * F.lag(v).over(w)}])


def trend_beta(y: str, position: str, out: str, n: int = 24) -> Rolling:
    """Least-squares slope on the row position over ``n`` complete rows (n rows back)."""
    v, base, p = F.col(y), f"_b_{out}", f"_p_{out}"
    c = v - F.col(base)

    def results(s: Sums, w: WindowSpec) -> list[Columns]:
        middle = F.col(p) - (n - 1) / 2
        slope = (s.last("py", n) - middle * s.last("y", n)) / F.lit(n * (n * n - 1) / 12)
        return [{out: F.when(s.last("n", n) == n, slope)}]

    return Rolling(f"_beta_{out}", {"y": c, "py": F.col(p) * c, "n": _one(v)}, [n], results, [lambda w: {
        base: _shift(v, w), p: (F.col(position) - F.first(position).over(so_far(w))).cast("double")}])


def t_no_constant(xx: Column, xy: Column, yy: Column, n: int | Column) -> Column:
    """t statistic of the slope of y on x without constant, from plain sums over n pairs."""
    slope = ratio(xy, xx)
    rss = F.greatest(yy - slope * xy, F.lit(0.0))
    return ratio(slope, F.sqrt(ratio(rss / (n - 1), xx)))


def t_with_constant(sxx: Column, sxy: Column, syy: Column, n: int | Column) -> Column:
    """t statistic of the slope of y on x with constant, from centred sums over n pairs."""
    slope = ratio(sxy, sxx)
    rss = F.greatest(syy - slope * sxy, F.lit(0.0))
    return ratio(slope, F.sqrt(ratio(rss / (n - 2), sxx)))


def engle_granger(y: Column, x: Column, out: str, n: int = 100) -> Rolling:
    """Rolling two-step cointegration statistic without constants and lags (n rows back).

    Both steps come from moments: those of the residuals y - beta*x are polynomials in beta, so
    no window is ever materialised.
    """
    y1, x1 = F.col(f"_y_{out}"), F.col(f"_x_{out}")
    dy, dx = y - y1, x - x1
    terms = {
        "xy": x * y, "xx": x * x, "n": F.when(x.isNotNull() & y.isNotNull(), 1),
        "l0": y1 * y1, "l1": x1 * y1, "l2": x1 * x1, "c0": dy * y1, "c1": dx * y1 + dy * x1, "c2": dx * x1,
        "s0": dy * dy, "s1": dx * dy, "s2": dx * dx}

    def results(s: Sums, w: WindowSpec) -> list[Columns]:
        # levels span n rows, differences the n - 1 steps between them
        b, k = F.col(f"_beta_{out}"), n - 1
        sums = {f"_{m}_{out}": s.last(f"{m}0", k) - f * b * s.last(f"{m}1", k) + b * b * s.last(f"{m}2", k)
                for m, f in (("l", 2), ("c", 1), ("s", 2))}
        stat = t_no_constant(*[F.col(c) for c in sums], n - 1)
        return [{f"_beta_{out}": ratio(s.last("xy", n), s.last("xx", n))}, sums,
                {out: F.when(s.last("n", n) == n, stat)}]

    return Rolling(f"_eg_{out}", terms, [n, n - 1], results,
                   [lambda w: {f"_y_{out}": F.lag(y).over(w), f"_x_{out}": F.lag(x).over(w)}])


def unit_root(y: str, out: str, windows: Sequence[int], constant: bool = True) -> Rolling:
    """Dickey-Fuller t statistic without lags; the largest one over several window lengths.

    Reaches ``max(windows)`` rows back and is null until the longest window is complete.
    """
    longest, name = max(windows), f"_df_{out}"
    v, x, step = F.col(y), F.col(f"_x_{out}"), F.col(f"_d_{out}")
    terms = {"x": x, "y": step, "xx": x * x, "xy": x * step, "yy": step * step, "n": _one(v)}

    def sums(start: Column) -> Column:
        n, now, then = start["n"], F.col(name), start["then"]
        sx, sy = (now["x"] - then["x"], now["y"] - then["y"]) if constant else (F.lit(0.0), F.lit(0.0))
        return F.struct(n.alias("n"), (now["xx"] - then["xx"] - sx * sx / n).alias("xx"),
                        (now["xy"] - then["xy"] - sx * sy / n).alias("xy"), (now["yy"] - then["yy"] - sy * sy / n).alias("yy"))

    def results(s: Sums, w: WindowSpec) -> list[Columns]:
        starts = F.array(*[F.struct(F.lit(float(m - 1)).alias("n"), F.lag(name, m - 1).over(w).alias("then")) for m in windows])
        t = t_with_constant if constant else t_no_constant
        stats = F.transform(F.transform(f"_starts_{out}", sums), lambda m: t(m["xx"], m["xy"], m["yy"], m["n"]))
        return [{f"_starts_{out}": starts}, {out: F.when(s.last("n", longest) == longest, F.array_max(stats))}]

    return Rolling(name, terms, [longest], results, [lambda w: {
        f"_x_{out}": F.lag(v).over(w) - (_shift(v, w) if constant else F.lit(0.0)), f"_d_{out}": change(v, w)}])
