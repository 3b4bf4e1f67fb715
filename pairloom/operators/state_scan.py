"""Scans of two-state chains: products of 2x2 matrices over a semiring, level by level, in SQL expressions.

A step of a chain turns the scores of the two states into the next ones: ``v'[j] = plus_i(v[i] + t[i][j])``, with logarithms for
scores. With the maximum for ``plus`` that is the score of the best path, with the logarithm of the sum of exponentials the
filtered probability. Steps compose associatively, so a series is cut into groups of rows: each group is reduced to one matrix, the
matrices are folded in groups of ``fan``, again and again, and carried back as the vectors with which each group is entered. No
fold sees more than ``fan`` matrices and nothing runs in Python.

Expressions are SQL text: a fold has hundreds of terms, and text reaches Spark in one piece.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEVER = "DOUBLE('-Infinity')"
Plus = Callable[[str, str], str]
CELLS = ("m00", "m01", "m10", "m11")


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def log_add(a: str, b: str) -> str:
    """log(exp(a) + exp(b)) without leaving the range of doubles."""
    high = f"greatest({a}, {b})"
    return f"if({high} = {NEVER}, {NEVER}, {high} + log1p(exp(least({a}, {b}) - {high})))"


def best_of(a: str, b: str) -> str:
    return f"greatest({a}, {b})"


IDENTITY = struct(m00="0D", m01=NEVER, m10=NEVER, m11="0D")


def less(matrix: str) -> str:
    """A matrix less its greatest cell: only differences between scores matter, and sums of millions of steps stay exact."""
    cells = struct(**{c: f"_q.{c} - _t" for c in CELLS})
    top = "greatest(" + ", ".join(f"_q.{c}" for c in CELLS) + ")"
    return let("_q", matrix, let("_t", f"if({top} = {NEVER}, 0D, {top})", cells))


def product(a: str, b: str, plus: Plus) -> str:
    """The steps ``a`` followed by the steps ``b``."""
    return less(struct(**{f"m{i}{j}": plus(f"{a}.m{i}0 + {b}.m0{j}", f"{a}.m{i}1 + {b}.m1{j}") for i in (0, 1) for j in (0, 1)}))


def level(v: str) -> str:
    """Two scores less the greater one."""
    return let("_q", v, struct(s0="_q.s0 - greatest(_q.s0, _q.s1)", s1="_q.s1 - greatest(_q.s0, _q.s1)"))


def shares(v: str) -> str:
    """Two weights as shares of their sum."""
    return let("_q", v, struct(s0="_q.s0 / (_q.s0 + _q.s1)", s1="_q.s1 / (_q.s0 + _q.s1)"))


@dataclass(frozen=True)
class Fold:
    """How the values of a column compose, how they act on a state, and the state before the first."""

    unit: str
    compose: Callable[[str, str], str]
    act: Callable[[str, str], str]
    start: str


def forward(plus: Plus) -> Fold:
    """Matrices in the order of the rows; a chain starts in state 0, and its first step holds the start scores."""
    return Fold(IDENTITY, lambda acc, x: product(acc, x, plus),
                lambda v, m: level(struct(**{f"s{j}": plus(f"{v}.s0 + {m}.m0{j}", f"{v}.s1 + {m}.m1{j}") for j in (0, 1)})),
                struct(s0="0D", s1=NEVER))


def backward(plus: Plus) -> Fold:
    """Matrices from the last row on; behind the end both states count alike."""
    return Fold(IDENTITY, lambda acc, x: product(x, acc, plus),
                lambda v, m: level(struct(**{f"s{i}": plus(f"{m}.m{i}0 + {v}.s0", f"{m}.m{i}1 + {v}.s1") for i in (0, 1)})),
                struct(s0="0D", s1="0D"))


def follow(m: str, s: str) -> str:
    return f"if({s} = 0, {m}.to0, {m}.to1)"


#: maps of the two states, the later one followed first; the start does not matter if the first map is constant
MAPS = Fold(struct(to0="0", to1="1"), lambda acc, x: struct(to0=follow(x, f"{acc}.to0"), to1=follow(x, f"{acc}.to1")),
            lambda s, m: follow(m, s), "0")


def together(**folds: Fold) -> Fold:
    """Several folds over one struct column with a field each."""
    return Fold(struct(**{n: f.unit for n, f in folds.items()}),
                lambda acc, x: struct(**{n: f.compose(f"{acc}.{n}", f"{x}.{n}") for n, f in folds.items()}),
                lambda s, m: struct(**{n: f.act(f"{s}.{n}", f"{m}.{n}") for n, f in folds.items()}),
                struct(**{n: f.start for n, f in folds.items()}))


def entries(df: DataFrame, keys: Sequence[str], fold: Fold, fan: int, levels: int, out: str) -> DataFrame:
    """The state with which each row ``(keys, _pos, _m)`` is entered, in the order of ``_pos``: ``(keys, _pos, out)``."""
    keys = list(keys)
    group = "0L" if levels <= 1 else f"floor(_pos / {fan})"
    # element i of _pre composes the rows before row i; the last one all of them
    pre = f"aggregate(_rows, array({fold.unit}), (acc, x) -> array_append(acc, {let('_l', 'element_at(acc, -1)', fold.compose('_l', 'x._m'))}))"
    gathered = (df.selectExpr(*keys, "_pos", "_m", f"{group} AS _over").groupBy(*keys, "_over")
                .agg(F.expr("sort_array(collect_list(struct(_pos, _m))) AS _rows"))
                .selectExpr(*keys, "_over", "transform(_rows, x -> x._pos) AS _at", f"{pre} AS _pre"))
    if levels <= 1:
        entered = gathered.selectExpr("*", f"{fold.start} AS _start")
    else:
        tops = gathered.selectExpr(*keys, "_over AS _pos", "element_at(_pre, -1) AS _m")
        above = entries(tops, keys, fold, fan, levels - 1, "_start").withColumnRenamed("_pos", "_over")
        entered = gathered.join(above, [*keys, "_over"])
    each = entered.selectExpr(*keys, "_start", "explode(arrays_zip(_at, slice(_pre, 1, size(_at)))) AS _x")
    return each.selectExpr(*keys, "_start", "_x._at AS _pos", "_x.`1` AS _before").selectExpr(
        *keys, "_pos", f"{fold.act('_start', '_before')} AS {out}")


def entries_from_end(df: DataFrame, keys: Sequence[str], fold: Fold, fan: int, levels: int, out: str) -> DataFrame:
    """As ``entries`` in the opposite order: the state that the rows behind each row leave."""
    turned = entries(df.selectExpr(*keys, "-_pos AS _pos", "_m"), keys, fold, fan, levels, out)
    return turned.selectExpr(*keys, "-_pos AS _pos", out)


def levels_for(longest: int, rows: int, fan: int) -> int:
    """Levels of folding that series of ``longest`` rows need."""
    levels, held = 1, rows * fan
    while held < longest:
        levels, held = levels + 1, held * fan
    return levels
