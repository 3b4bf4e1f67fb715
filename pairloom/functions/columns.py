"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Text that stands for a null inside a surrogate key, and the joining mark.
KEY_NULL = "_dbt_utils_surrogate_key_null_"
KEY_JOIN = "-"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the joined text of ``cols``; pass fractional columns as decimals."""
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(KEY_JOIN, *texts))


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, null for a zero divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def pct_change(x: Column, w: WindowSpec) -> Column:
    return ratio(x, F.lag(x).over(w)) - 1


def true_range(high: Column, low: Column, prev_close: Column, first_is_range: bool = False) -> Column:
    """Largest of the bar range and the distances to the previous close.

    The first bar has no previous close: null, or its own range with ``first_is_range``.
    """
    full = F.greatest(high - low, F.abs(high - prev_close), F.abs(low - prev_close))
    return F.when(prev_close.isNotNull(), full).otherwise(high - low if first_is_range else F.lit(None))


def crossed_up(a: Column, b: Column, w: WindowSpec) -> Column:
    """1 where ``a`` reaches the previous ``b`` from below."""
    hit = (a >= F.lag(b).over(w)) & (F.lag(a).over(w) < F.lag(b).over(w))
    return F.coalesce(hit, F.lit(False)).cast("int")


def crossed_down(a: Column, b: Column, w: WindowSpec) -> Column:
    """1 where ``a`` falls to the previous ``b`` from above."""
    hit = (a <= F.lag(b).over(w)) & (F.lag(a).over(w) > F.lag(b).over(w))
    return F.coalesce(hit, F.lit(False)).cast("int")


def barrier_levels(spread: Column, upper: float, lower: float) -> tuple[Column, Column]:
    return spread * (1 + upper), spread * (1 - lower)


def normal_name(name: str) -> str:
    """Column name as stored: upper case, blanks as underscores."""
    return name.upper().replace(" ", "_")


def argmax(values: Column) -> Column:
    """0-based position of the first largest array element."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def packed(*parts: tuple[Column, int]) -> Column:
    """One number that orders like the given (non-negative whole number, most digits) parts, first part first.

    ``min_by`` and ``max_by`` aggregate such a key by hashing; a key of several columns would make them sort. A part
    with more digits raises an error.
    """
    out: Column | None = None
    for value, digits in parts:
        whole = value.cast(f"decimal({digits},0)")
        out = whole if out is None else out * F.lit(10 ** digits).cast(f"decimal({digits + 1},0)") + whole
    return out


def any_null(cols: Sequence[str]) -> Column:
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.col(c).isNull()
    return hit
