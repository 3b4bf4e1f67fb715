"""Helpers shared by the text operators."""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.session import work_dir

__all__ = ["fresh", "hash_sample", "read", "stored", "text_or_empty", "uniform", "word_hashes", "work_dir"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once under the shared folder and read back: later jobs survive lost executors."""
    path = work_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone, so a recomputed task draws the same."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0 ** -53)


#: labels that are broadcast at most
MOST_LABELS = 2_000_000


def with_labels(texts: DataFrame, labels: DataFrame, key: str, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``of(texts)`` joined with ``labels`` by ``key``; where there are few labels, only the texts that have one go through ``of``.

    ``of`` computes something costly and narrow from each row and keeps the key. Up to ``MOST_LABELS`` labels are broadcast before it; more are
    joined behind it by a shuffle, which then moves no text.
    """
    if labels.count() <= MOST_LABELS:
        have = texts.join(F.broadcast(labels.select(key)), key, "left_semi")
        return of(have).join(F.broadcast(labels), key)
    return of(texts).join(labels, key)


def hash_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows by the hash of their key, and never more; all rows if there are no more than that.

    The share to take follows from a count, so only about that many rows leave the executors.
    """
    n = rows.count()
    if n > most:
        rows = rows.where(uniform(F.lit(11), F.col(key)) < most / n)
    return rows.orderBy(F.xxhash64(key), key).limit(most)


# --- words of many texts at once ------------------------------------------------------------------

PIECE_BYTES = 1 << 20
_rng = np.random.default_rng(20240607)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for positions below ``n``."""
    size = max(PIECE_BYTES, 1 << (n - 1).bit_length())
    if size not in _powers:
        up, down = (np.empty(size, np.uint64) for _ in range(2))
        for out, base in ((up, _BASE), (down, pow(_BASE, -1, 2**64))):
            out[0] = 1
            have, step = 1, base
            while have < size:
                more = min(have, size - have)
                out[have:have + more] = out[:more] * np.uint64(step)
                have, step = have + more, step * step % 2**64
        if n > PIECE_BYTES:
            return up, down  # rare long texts do not stay in memory
        _powers[size] = up, down
    return _powers[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_SPACE = np.ones(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
# fixed values: first and last characters of scripts that write no spaces between words (Thai to Khmer, kana, bopomofo, Han)
UNSPACED = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3040, 0x312F),
            (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xAA00, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B2FF),
            (0x20000, 0x323AF))
_OTHER, _LETTER, _MARK, _ALONE, _ALONE_MARK = range(5)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of every character up to the last Han one: letter or digit, mark, letter or mark of a script without spaces, other."""
    kinds = np.array([_OTHER if c[0] not in "LNM" else _MARK if c[0] == "M" else _LETTER
                      for c in map(unicodedata.category, map(chr, range(UNSPACED[-1][1] + 1)))], np.int8)
    for first, last in UNSPACED:
        part = kinds[first:last + 1]
        part[part == _LETTER] = _ALONE
        part[part == _MARK] = _ALONE_MARK
    return kinds


def _letters(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """True for the bytes of words, and the bytes before which a word ends although the next byte belongs to one.

    Words are runs of letters, digits and marks by their Unicode category. In scripts without spaces each letter, with the marks on
    it, is a word.
    """
    inside = _ALNUM[b]
    lead = np.flatnonzero(b >= 0xC0)
    if not len(lead):
        return inside, lead
    size = 2 + (b[lead] >= 0xE0) + (b[lead] >= 0xF0)
    code = np.where(size == 2, b[lead] & 0x1F, np.where(size == 3, b[lead] & 0x0F, b[lead] & 0x07)).astype(np.int64)
    for k in (1, 2, 3):
        code = np.where(size > k, code << 6 | b[np.minimum(lead + k, len(b) - 1)] & 0x3F, code)
    kinds = _kinds()
    kind = kinds[np.minimum(code, len(kinds) - 1)]
    kind[code >= len(kinds)] = _OTHER
    known = kind != _OTHER
    for k in range(4):
        at = lead[known & (size > k)] + k
        inside[at[at < len(b)]] = True
    alone, behind = kind >= _ALONE, (lead + size)[kind >= _ALONE]
    marks = np.zeros(len(b) + 5, bool)
    marks[lead[(kind == _MARK) | (kind == _ALONE_MARK)]] = True
    return inside, np.concatenate([lead[kind == _ALONE], behind[~marks[behind]]]) if alone.any() else lead[:0]


def pieces(texts: pa.Array, limit: int = PIECE_BYTES):
    """(first row, end row) ranges whose texts have about ``limit`` bytes; a longer text is a range of its own."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(lengths)])
    lo = 0
    while lo < len(lengths):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + limit, "right")) - 1)
        yield lo, min(hi, len(lengths))
        lo = hi


def word_hashes(texts: pa.Array, letters: bool = False):
    """64-bit hashes of all words of ``texts`` and the position of each text's first word (one more than texts).

    Words are runs of bytes other than space and \\t..\\r, or, with ``letters``, lower-cased runs of letters, digits and marks, in scripts
    without spaces single letters. Also gives the byte bounds of each word and the bytes they refer to.
    """
    texts = pc.fill_null(texts, "")
    if letters:
        texts = pc.utf8_lower(texts)
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    b = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    n = len(b)
    if n == 0:
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64), empty, empty, b
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    if letters:
        inside, apart = _letters(b)
        cut[np.minimum(apart, n)] = True
    else:
        inside = _SPACE[b]
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.concatenate([inside[1:], [False]])
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    up, down = _power_table(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUE[b] * up[:n], out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return h, np.searchsorted(starts, bounds).astype(np.int64), starts, ends, b
