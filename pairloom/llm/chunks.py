"""Values of texts from their space-separated chunks, each distinct one computed once while it stays in a bounded cache."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes that the chunks of one generation and their values take; a worker holds two generations
KEPT_BYTES = 48 << 20
#: longer chunks rarely come again: they are computed for the texts at hand and not kept
LONGEST = 128
#: what an entry of so few characters costs besides them, with its ids
_ENTRY = 260
#: rows and bytes of texts that are cut at a time
SLICE_ROWS, SLICE_BYTES = 2048, 8 << 20
#: marks that byte-pair patterns always separate from letters before them, and keep together
TAIL = ".,!?;:)#$%&*"
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def _strings(texts: pa.Array) -> list[str]:
    """Like ``to_pylist``, without a scalar object for each text."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class Chunks:
    """``compute`` gives the values (numbers, or ids as bytes of 32-bit numbers) of a list of chunks.

    With ``keep_space`` a chunk holds the space before it. Such a cut is sound only between two characters that
    are no white space; texts with other spaces are cut by a pattern that checks it. With ``lead`` a space is put before
    each text, so that all chunks start with one. The value of a text is the sum or the concatenation of all its chunks,
    so no text is cut short and the cache changes only the speed. ``tail`` are marks that may be cut off after letters.

    What a generation holds is bounded in bytes (``kept``), and chunks over ``LONGEST`` characters are not kept, so text
    without spaces, where every line is a chunk, costs no more memory than prose.
    """

    def __init__(self, compute: Callable[[list[str]], list], keep_space: bool, kept: int = KEPT_BYTES, lead: bool = False,
                 tail: str = TAIL):
        self.compute, self.keep_space, self.kept, self.lead, self.tail = compute, keep_space, kept, lead, tail
        self.forget()

    def forget(self) -> None:
        """Empties the cache, so that a worker that goes on to other work doesn't carry it along."""
        self.young: dict = {}
        self.old: dict = {}
        self.held = 0

    def _unsafe(self, chunk: str) -> bool:
        return self.keep_space and (chunk in ("", " ") or chunk[-1].isspace() or chunk[0] == " " and chunk[1].isspace())

    def _values(self, chunks: list[str]) -> list:
        """The chunks' values; None for chunks at which a plain cut is not sound."""
        if self.held > self.kept:
            self.old, self.young, self.held = self.young, {}, 0
        young, old, tail = self.young, self.old, self.tail
        found = list(map(young.get, chunks, repeat(self)))
        missing = [i for i, v in enumerate(found) if v is self]
        if old and missing:
            names = [chunks[i] for i in missing]
            for i, c, v in zip(missing, names, map(old.get, names, repeat(self))):
                if v is not self:
                    found[i] = v
                    self._keep(c, v)
            missing = [i for i in missing if found[i] is self]
        whole, cut, need = [], [], {}
        for i in missing:
            c = chunks[i]
            if self.keep_space and self._unsafe(c):
                found[i] = None
                self._keep(c, None)
                continue
            core = c.rstrip(tail) if tail else c
            if len(core) < len(c) and core.lstrip(" ").isalpha():
                end = c[len(core):]
                cut.append((i, c, core, end))
                for part in (core, end):
                    if part not in young:
                        need[part] = None
            else:
                whole.append(i)
                need[c] = None
        fresh = dict(zip(need, self.compute(list(need)))) if need else {}
        for i in whole:
            found[i] = fresh[chunks[i]]
        kept = {c: v for c, v in fresh.items() if len(c) <= LONGEST}
        young.update(kept)
        self.held += _ENTRY * len(kept) + 2 * sum(map(len, kept))
        for i, c, core, end in cut:
            found[i] = v = (fresh[core] if core in fresh else young[core]) + (fresh[end] if end in fresh else young[end])
            self._keep(c, v)
        return found

    def _keep(self, chunk: str, value) -> None:
        if len(chunk) <= LONGEST:
            self.young[chunk] = value
            self.held += _ENTRY + 2 * len(chunk)

    def _odd(self, text: str) -> list:
        """Chunk values of a text with unusual spaces; chunks that a plain cut would not trust are not kept."""
        parts = _BETWEEN.split(text)
        chunks = [parts[0], *[" " + p for p in parts[1:]]]
        values = self._values(chunks)
        lost = list({c for c, v in zip(chunks, values) if v is None})
        extra = dict(zip(lost, self.compute(lost))) if lost else {}
        return [extra[c] if v is None else v for c, v in zip(chunks, values)]

    def _cut(self, texts: list[str]) -> tuple[list, np.ndarray, np.ndarray, dict[int, list]]:
        """Distinct values, the index into them of each chunk, the first chunk of each text, and the texts cut otherwise."""
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        first = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        distinct = _strings(coded.dictionary)
        if not self.keep_space:
            return self._values(distinct), at, first, {}
        if self.lead:
            values = self._values([" " + d for d in distinct])
            odd = np.array([v is None for v in values])
            strange = np.flatnonzero(np.logical_or.reduceat(odd[at], first[:-1])) if odd.any() else ()
            return values, at, first, {int(i): self._odd(" " + texts[i]) for i in strange}
        heads = lists.flatten().take(pa.array(first[:-1])).dictionary_encode()
        starts = _strings(heads.dictionary)
        values = self._values([" " + d for d in distinct] + starts)
        at[first[:-1]] = heads.indices.to_numpy() + len(distinct)
        odd = np.array([v is None for v in values])
        strange = np.flatnonzero(np.logical_or.reduceat(odd[at], first[:-1])) if odd.any() else ()
        return values, at, first, {int(i): self._odd(texts[i]) for i in strange}

    def _parts(self, texts: list[str]) -> Iterator[list[str]]:
        """The texts in slices of few rows and bytes; a longer text is a slice of its own."""
        lo, held = 0, 0
        for i, t in enumerate(texts):
            if i > lo and (i - lo == SLICE_ROWS or held + len(t) > SLICE_BYTES):
                yield texts[lo:i]
                lo, held = i, 0
            held += len(t)
        if lo < len(texts):
            yield texts[lo:]

    def sums(self, texts: list[str]) -> np.ndarray:
        """The sum of the chunk values of each text."""
        return np.concatenate([np.empty(0, np.int64), *map(self._sums, self._parts(texts))])

    def _sums(self, texts: list[str]) -> np.ndarray:
        values, at, first, odd = self._cut(texts)
        out = np.add.reduceat(np.array([v or 0 for v in values], np.int64)[at], first[:-1])
        for i, v in odd.items():
            out[i] = sum(v)
        return out

    def joined(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of all chunks of each text in a row (unsigned 32-bit numbers)."""
        return [ids for part in self._parts(texts) for ids in self._joined(part)]

    def _joined(self, texts: list[str]) -> list[np.ndarray]:
        values, at, first, odd = self._cut(texts)
        plain = [v or b"" for v in values] if self.keep_space else values
        size = np.fromiter(map(len, plain), np.int64, len(plain)) // 4
        begin = np.cumsum(size) - size
        ids = np.frombuffer(b"".join(plain), np.uint32)
        taken = size[at]
        ends = np.cumsum(taken)
        place = np.repeat(begin[at] - (ends - taken), taken)
        place += np.arange(ends[-1])
        flat = ids[place]
        bounds = np.concatenate([[0], ends[first[1:] - 1]])
        return [np.frombuffer(b"".join(odd[i]), np.uint32) if i in odd else flat[bounds[i]:bounds[i + 1]] for i in range(len(texts))]
