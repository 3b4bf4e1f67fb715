"""Fill-in-the-middle transformation of texts as piece tables over immutable buffers.

A document is a list of descriptors (buffer, start, length) over two buffers that never change: the UTF-8 bytes of a batch of
texts, as Arrow holds them, and the bytes of the three sentinels. Cutting splits the descriptor of the whole text in three, an
arrangement is a permutation of descriptors, and the inverse permutation puts the text together again. Text bytes are copied
once, when an output is written; hashes read the descriptors one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import fresh, pieces

# fixed values: the sentinels, and the draws (of 100) from which on a text stays plain and below which the suffix comes first
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
SENTINELS = (PREFIX + SUFFIX + MIDDLE).encode()
TEXT, MARK = 0, 1
#: descriptors of the sentinels: prefix, suffix, middle
_P, _S, _M = ((MARK, 0, 3), (MARK, 3, 3), (MARK, 6, 3))
#: an arrangement of the six descriptors [P, prefix, M, middle, S, suffix]
ARRANGED = {"psm": (0, 1, 4, 5, 2, 3), "spm": (4, 5, 0, 1, 2, 3)}
#: bytes of texts that a worker turns at a time; a longer text is a batch of its own
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Buffers:
    """The immutable bytes that descriptors refer to."""

    text: memoryview
    marks: memoryview = memoryview(SENTINELS)

    def view(self, piece: tuple[int, int, int]) -> memoryview:
        buffer, start, length = piece
        return (self.text if buffer == TEXT else self.marks)[start:start + length]

    def joined(self, table: list[tuple[int, int, int]]) -> bytes:
        return b"".join([self.view(p) for p in table])

    def sha256(self, table: list[tuple[int, int, int]]) -> str:
        h = hashlib.sha256()
        for p in table:
            h.update(self.view(p))
        return h.hexdigest()


def cut(piece: tuple[int, int, int], at: int) -> tuple[tuple[int, int, int], tuple[int, int, int]]:
    """The descriptors of a piece's first ``at`` bytes and of the rest."""
    buffer, start, length = piece
    return (buffer, start, at), (buffer, start + at, length - at)


def arranged(whole: tuple[int, int, int], first: int, second: int, form: str) -> list[tuple[int, int, int]]:
    """The table of the output: ``whole`` cut at bytes ``first`` and ``second``, its parts in the order of ``form``."""
    if form == "plain":
        return [whole]
    head, suffix = cut(whole, second)
    prefix, middle = cut(head, first)
    table = [_P, prefix, _M, middle, _S, suffix]
    return [table[k] for k in ARRANGED[form]]


def restored(whole: tuple[int, int, int], found: list[int], form: str) -> list[tuple[int, int, int]]:
    """The table of the text from the output ``whole``: cut at the sentinels at bytes ``found``, parts back in place."""
    if form == "plain":
        return [whole]
    table, rest = [], whole
    for at, end in zip(found, [*found[1:], whole[2]]):
        mark, rest = cut(rest, len(PREFIX))
        part, rest = cut(rest, end - at - len(PREFIX))
        table += [mark, part]
    back = [0] * 6
    for k, p in zip(ARRANGED[form], table):
        back[k] = p
    return back[1::2]


def _bytes_of(texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of all texts and the bounds of each; nulls have none."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    if texts.null_count:
        texts = texts.fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return memoryview(data if data is not None else b""), bounds


def _characters(data: memoryview, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which characters begin (from the first text on), and the first character of each text."""
    b = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
    begins = np.flatnonzero((b & 0xC0) != 0x80) + bounds[0]
    return begins, np.searchsorted(begins, bounds)


def _draws(key: Column) -> list[Column]:
    """The first four 8-digit groups of the sha256 of ``1:`` and the key; a null key counts as an empty one."""
    h = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars, output and output_sha256.

    A text of n code points is cut at two of the n + 1 places between them, both drawn from the hash of its key, and written
    as prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``) with a sentinel before each part. It stays ``plain``,
    without counts of characters, if it is empty or null, if it contains a sentinel, or by its draw. Parts can be empty. Rows
    are turned one by one: repeated rows give repeated results, null keys draw like the empty one, long texts are whole, an empty table
    gives an empty table; input columns named like results are replaced.
    """
    new = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
           T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()), T.StructField("output_sha256", T.StringType())]
    names = [c for c in docs.columns if c.lower() not in {f.name for f in new}]
    drawn = docs.select(*names, F.coalesce(F.col(text), F.lit("")).alias(fresh(docs, "whole_text")),
                        *[d.alias(fresh(docs, f"draw{k}")) for k, d in enumerate(_draws(F.col(key)))])
    schema = T.StructType([*drawn.schema.fields[:len(names)], *new])
    marks = [m.decode() for m in (SENTINELS[:3], SENTINELS[3:6], SENTINELS[6:])]

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in pieces(batch.column(len(names)), SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                data, bounds = _bytes_of(part.column(len(names)))
                buffers = Buffers(data)
                begins, first = _characters(data, bounds)
                h1, h2, h3, h4 = (part.column(len(names) + 1 + k).to_numpy() for k in range(4))
                n = np.diff(first)
                one, two = h1 % (n + 1), h2 % (n + 1)
                near, far = np.minimum(one, two), np.maximum(one, two)
                ends = np.append(begins, bounds[-1])  # a cut after the last character of a text is where the next one begins
                at, to = (ends[first[:-1] + k] - bounds[:-1] for k in (near, far))
                texts = part.column(len(names)).to_pylist()
                form = ["plain" if not t or h >= PLAIN_FROM or any(m in t for m in marks) else "spm" if g < SPM_BELOW else "psm"
                        for t, h, g in zip(texts, (h3 % 100).tolist(), (h4 % 100).tolist())]
                del texts
                tables = [arranged((TEXT, a, b - a), x, y, f) for a, b, x, y, f in
                          zip(bounds[:-1].tolist(), bounds[1:].tolist(), at.tolist(), to.tolist(), form)]
                plain = np.array([f == "plain" for f in form], bool)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(names)], pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(near, pa.int64(), mask=plain), pa.array(far - near, pa.int64(), mask=plain),
                     pa.array([buffers.joined(t) for t in tables], pa.binary()).cast(pa.string()),
                     pa.array([buffers.sha256(t) for t in tables], pa.string())], names=schema.names)

    return drawn.mapInArrow(turned, schema)


def _tables_back(outputs: pa.Array, forms: list[str | None]) -> tuple[Buffers, list[list[tuple[int, int, int]] | None]]:
    """Buffers and tables of the texts that ``outputs`` were made from; None where output or form is null."""
    data, bounds = _bytes_of(outputs)
    tables = []
    for a, b, form, known in zip(bounds[:-1].tolist(), bounds[1:].tolist(), forms, outputs.is_valid().to_pylist()):
        if not known or form is None:
            tables.append(None)
            continue
        found = []
        if form != "plain":
            whole = bytes(data[a:b])
            order = (_S, _P, _M) if form == "spm" else (_P, _S, _M)
            found = [whole.index(SENTINELS[s:s + n]) for _, s, n in order]  # each stands in an output once
        tables.append(restored((TEXT, a, b - a), found, form))
    return Buffers(data), tables


def original(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from, from the output and its form alone; null if either is null."""
    @F.arrow_udf("string")
    def back(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for outputs, forms in batches:
            out = [pa.array([None if t is None else buffers.joined(t) for t in tables], pa.binary()).cast(pa.string())
                   for lo, hi in pieces(outputs, SLICE_BYTES)
                   for buffers, tables in (_tables_back(outputs.slice(lo, hi - lo), forms.slice(lo, hi - lo).to_pylist()),)]
            yield pa.concat_arrays(out) if out else pa.array([], pa.string())
    return back(output, form)


def original_sha256(output: Column, form: Column) -> Column:
    """The sha256 of ``original``, streamed over its descriptors: the text is never put together."""
    @F.arrow_udf("string")
    def digest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for outputs, forms in batches:
            yield pa.array([None if t is None else buffers.sha256(t) for lo, hi in pieces(outputs, SLICE_BYTES)
                            for buffers, tables in (_tables_back(outputs.slice(lo, hi - lo), forms.slice(lo, hi - lo).to_pylist()),)
                            for t in tables], pa.string())
    return digest(output, form)
