"""SQL for Dickey-Fuller statistics with lag choice: regressions by elimination on cross moments, as text for DuckDB.

The library factorises windows; this text takes the other way, through the moments of the columns, so the two agree only if both are right.
"""

from __future__ import annotations

from math import ceil


def most_lags(n: str, constant: bool) -> str:
    return f"least({n} // 2 - {1 + constant}, CAST(ceil(12 * power({n} / 100.0, 0.25)) AS INTEGER))"


def _columns(top: int, constant: bool, level_last: bool) -> list[str]:
    lags = [f"d{k}" for k in range(1, top + 1)]
    return [*["c"][:int(constant)], *([*lags, "l"] if level_last else ["l", *lags]), "y"]


def _cells(names: list[str]) -> list[tuple[str, str]]:
    order = sorted(names)
    return [(a, b) for i, a in enumerate(order) for b in order[i:]]


def _cell(a: str, b: str) -> str:
    return f"m_{min(a, b)}_{max(a, b)}"


def _eliminations(source: str, names: list[str], keys: str, prefix: str, carry) -> tuple[str, str]:
    """CTEs that take one column after the other out of all later ones; ``carry(k)`` gives expressions to keep after k columns."""
    out, left, kept = [], list(names), []
    for k, q in enumerate(names[:-1]):
        left = left[1:]
        now = carry(k)
        cells = [f"{_cell(a, b)} - {_cell(q, a)} * {_cell(q, b)} / {_cell(q, q)} AS {_cell(a, b)}" for a, b in _cells(left)]
        out.append(f"{prefix}{k + 1} AS (SELECT {', '.join([keys, *kept, *now, *cells])} FROM {prefix}{k if k else source})")
        kept += [e.split(' AS ')[-1] for e in now]
    last = carry(len(names) - 1)
    out.append(f"{prefix}_done AS MATERIALIZED (SELECT {', '.join([keys, *kept, *last])} FROM {prefix}{len(names) - 1})")
    return ",\n".join(out).replace(f"FROM {prefix}{source}", f"FROM {source}"), f"{prefix}_done"


def statistic(moments, n: str, longest: int, constant: bool, result: str, keys: str = "symbol, date, n") -> str:
    """CTEs that end in ``result (keys, t)``. ``moments(name, first)`` is a CTE of the moments per window from row ``first`` on; ``n`` is the
    expression of the number of values of a window, ``longest`` the largest."""
    c = int(constant)
    top = min(longest // 2 - 1 - c, ceil(12 * (longest / 100) ** 0.25))
    tops = most_lags(n, constant)
    first = _columns(top, constant, False)
    rows = f"({n} - 1 - {tops})"

    def unexplained(k: int) -> list[str]:
        return [f"m_y_y AS left{k - c - 1}"] if 0 <= k - c - 1 <= top else []

    one, done = _eliminations(f"{result}_top", first, keys, f"{result}_a", unexplained)
    criteria = ", ".join(f"CASE WHEN {k} <= {tops} THEN {rows} * (ln(2 * pi()) + ln(left{k} / {rows}) + 1) + {2 * (k + 1 + c)} END" for k in range(top + 1))
    best = f"""{result}_listed AS MATERIALIZED (SELECT {keys}, [{criteria}] AS aic FROM {done}),
{result}_best AS MATERIALIZED (SELECT {keys}, list_position(aic, list_min(aic)) - 1 AS b FROM {result}_listed)"""
    # the level's row after the constant and b lags are taken out
    second = _columns(top, constant, True)

    def level(k: int) -> list[str]:
        lags = k - c
        if lags < 0 or lags > top:
            return []
        beta = "m_l_y / m_l_l"
        return [f"{beta} / sqrt(greatest(m_y_y - {beta} * m_l_y, 0) / ({n} - 1 - {lags} - {lags + 1 + c}) / m_l_l) AS t{lags}"]

    two, ended = _eliminations(f"{result}_own", second, f"{keys}, b", f"{result}_b", level)
    t = ", ".join(f"t{k}" for k in range(top + 1))
    return ",\n".join([moments(f"{result}_top", tops, ""), one, best, moments(f"{result}_own", "b", f"{result}_best"), two,
                       f"{result} AS MATERIALIZED (SELECT {keys}, ([{t}])[b + 1] AS t FROM {ended})"])


def prefix_moments(series: str, windows: str, longest: int, constant: bool):
    """Moments from cumulative sums along ``series (symbol, o, y)`` for ``windows (symbol, date, o, n)``."""
    c = int(constant)
    top = min(longest // 2 - 1 - c, ceil(12 * (longest / 100) ** 0.25))
    names = _columns(top, constant, False)
    value = {"c": "1", "l": "l", "y": "d", **{f"d{k}": f"coalesce(lag(d, {k}) OVER w, 0)" for k in range(1, top + 1)}}
    base = f"""{series}_d AS (SELECT symbol, o, coalesce(y - lag(y) OVER w, 0) AS d, coalesce(lag(y) OVER w, 0) - avg(y) OVER (PARTITION BY symbol) * {c} AS l
    FROM {series} WINDOW w AS (PARTITION BY symbol ORDER BY o)),
{series}_v AS (SELECT symbol, o, {', '.join(f"CAST({value[q]} AS DOUBLE) AS v_{q}" for q in names)} FROM {series}_d WINDOW w AS (PARTITION BY symbol ORDER BY o)),
{series}_s AS MATERIALIZED (SELECT symbol, o, {', '.join(f"sum(v_{a} * v_{b}) OVER w AS {_cell(a, b)}" for a, b in _cells(names))}
    FROM {series}_v WINDOW w AS (PARTITION BY symbol ORDER BY o ROWS UNBOUNDED PRECEDING))"""

    def moments(name: str, first: str, best: str) -> str:
        more = f" JOIN {best} USING (symbol, date, n)" if best else ""
        cells = ", ".join(f"e.{_cell(a, b)} - s.{_cell(a, b)} AS {_cell(a, b)}" for a, b in _cells(names))
        return f"""{name} AS (SELECT w.symbol, w.date, w.n{', w.b' if best else ''}, {cells} FROM (SELECT *, o - n + 1 + {first} AS before FROM {windows}{more}) w
    JOIN {series}_s e ON e.symbol = w.symbol AND e.o = w.o JOIN {series}_s s ON s.symbol = w.symbol AND s.o = w.before)"""
    return base, moments


def row_moments(rows: str, n: int):
    """Moments from ``rows (symbol, date, i, u)``, the n values of each window, without a constant."""
    top = min(n // 2 - 1, ceil(12 * (n / 100) ** 0.25))
    names = _columns(top, False, False)
    value = {"l": "l", "y": "d", **{f"d{k}": f"coalesce(lag(d, {k}) OVER w, 0)" for k in range(1, top + 1)}}
    base = f"""{rows}_d AS (SELECT symbol, date, {n} AS n, i, u - lag(u) OVER w AS d, lag(u) OVER w AS l FROM {rows} WINDOW w AS (PARTITION BY symbol, date ORDER BY i)),
{rows}_v AS MATERIALIZED (SELECT symbol, date, n, i, {', '.join(f"{value[q]} AS v_{q}" for q in names)} FROM {rows}_d WHERE d IS NOT NULL
    WINDOW w AS (PARTITION BY symbol, date ORDER BY i))"""

    def moments(name: str, first: str, best: str) -> str:
        more = f" JOIN {best} USING (symbol, date, n)" if best else ""
        cells = ", ".join(f"sum(v_{a} * v_{b}) AS {_cell(a, b)}" for a, b in _cells(names))
        return f"""{name} AS (SELECT symbol, date, n{', b' if best else ''}, {cells} FROM {rows}_v{more} WHERE i > {first} GROUP BY ALL)"""
    return base, moments
