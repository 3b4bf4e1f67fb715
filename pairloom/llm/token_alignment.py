"""Alignment of the tokens that two tokenizers give for the same text, and id pairs that belong together corpus-wide.

Two token sequences over the same bytes are cut into groups wherever tokens of both end at one byte. Most of a text is one token
against one token for a while, so the search runs along a diagonal: at the present shift between the two indexes it compares ever
longer stretches of the two arrays of ends, 1, 2, 4, .. tokens, and halves the last one to the first difference. There it leaves the
diagonal: the tokens up to the next common end are one irregular group, found by advancing the side that is behind, and the shift
changes by what one side has more.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.chunks import TAIL, Chunks
from pairloom.llm.common import fresh, pieces, stored
from pairloom.llm.token_counts import byte_characters, in_byte_characters

#: bytes of texts that a worker aligns at a time; a longer text is a batch of its own
SLICE_BYTES = 1 << 20
#: bytes of chunks that a worker keeps per generation
KEPT = 48 << 20
#: rows of the id pair table that are broadcast at most
MOST_PAIRS = 2_000_000
#: id pairs whose documents a task counts before it hands the counts on
HELD_PAIRS = 1 << 20


#: a pair of ids in one number; the id of the first side is the upper half
SHIFT = 32
#: marks ids of the second side in a stream of both, and a chunk whose tokens do not give its bytes back
SECOND, BROKEN = 1 << 31, (1 << 32) - 1


class ByteLevel:
    """Ids and token bytes of a byte-level file of the tokenizers library; special strings are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = made = Tokenizer.from_file(path)
        made.encode_special_tokens = True
        byte_of = {c: b for b, c in byte_characters().items()}
        vocab = made.get_vocab()
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for name, i in vocab.items():
            self.bytes_of[i] = bytes([byte_of[c] for c in name]) if all(c in byte_of for c in name) else name.encode()
        cut = made.pre_tokenizer
        self.separable = made.normalizer is None and type(cut).__name__ == "ByteLevel" and not cut.add_prefix_space and cut.use_regex

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space. A space and letters are one match of the pattern and go straight to the merges."""
        out: list[list[int]] = [[]] * len(texts)
        others = []
        merge = self.tokenizer.model.tokenize
        for i, t in enumerate(texts):
            if self.separable and t[0] == " " and t[1:].isalpha():
                out[i] = [x.id for x in merge(in_byte_characters(t))]
            else:
                others.append(i)
        for i, e in zip(others, self.tokenizer.encode_batch_fast([texts[i] for i in others], add_special_tokens=False)):
            out[i] = e.ids
        return out


class Pieces:
    """Ids and token bytes of a sentencepiece model, which puts a space before each text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
                         for i, n in enumerate(names)]
        # where no piece goes on after a space within it, no merge crosses from a character to the space behind it
        same = "a  b éé ﬁ "
        self.separable = (all("▁" not in n.lstrip("▁") for n in names)
                          and self.model.normalize(same) == "▁" + same.replace(" ", "▁"))
        # likewise marks can be encoded apart from the letters before them
        joined = any(x.isalpha() and y in TAIL for n in names for x, y in zip(n, n[1:]))
        self.tail = TAIL if not joined and names[self.model.piece_to_id("▁a")] == "▁a" else ""

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space, which the model adds again, or of marks that follow a letter."""
        got = self.model.encode([t[1:] if t[0] == " " else "a" + t for t in texts], num_threads=1)
        return [g if t[0] == " " else g[1:] for t, g in zip(texts, got)]


def runs(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int], list[int], list[int], list[int], list[int]]:
    """The alignment of two lists of token ends over the same bytes, both of which end at the last byte.

    Gives the one-to-one stretches (first index in ``a``, in ``b``, length) and, of the irregular groups, the links (indexes of
    tokens that share bytes) and how many tokens of ``a`` and ``b`` there are up to the end of each.
    """
    first_a, first_b, lengths, links_a, links_b, ends_a, ends_b = ([] for _ in range(7))
    n, i, j = len(a), 0, 0
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            # probe along the diagonal: stretches that double while all their ends are equal
            start, width = i, 1
            i, j = i + 1, j + 1
            while (stretch := a[i:i + 2 * width]) and stretch == b[j:j + 2 * width]:
                width *= 2
                i, j = i + len(stretch), j + len(stretch)
            # the first difference lies within the last stretch: halve it
            while width:
                stretch = a[i:i + width]
                if len(stretch) == width and stretch == b[j:j + width]:
                    i, j = i + width, j + width
                width >>= 1
            first_a.append(start)
            first_b.append(start + j - i)
            lengths.append(i - start)
            if i == n:
                break
            x, y = a[i], b[j]
        # an irregular group: the side that is behind advances to the next common end, and the shift changes
        links_a.append(i)
        links_b.append(j)
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
            links_a.append(i)
            links_b.append(j)
        i, j = i + 1, j + 1
        ends_a.append(i)
        ends_b.append(j)
    return first_a, first_b, lengths, links_a, links_b, ends_a, ends_b


def alignment(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (indexes into both, in no order) and the tokens of both up to the end of each group (in order) from two arrays of ends."""
    first_a, first_b, lengths, links_a, links_b, ends_a, ends_b = (np.array(x, np.int64) for x in runs(a.tolist(), b.tolist()))
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    one_a, one_b = np.repeat(first_a, lengths) + within, np.repeat(first_b, lengths) + within
    return (np.concatenate([one_a, links_a]), np.concatenate([one_b, links_b]),
            np.sort(np.concatenate([one_a + 1, ends_a])), np.sort(np.concatenate([one_b + 1, ends_b])))


class Aligner:
    """Aligns texts under a byte-level file (of a space and the text) and a sentencepiece model (of the text).

    Both sides are encoded chunk by chunk where both allow it; the alignment itself runs over whole texts.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.lengths = [np.array([len(t) for t in x.bytes_of], np.int64) for x in (self.a, self.b)]
        self.chunks = Chunks(self._encode, keep_space=True, lead=True, tail=self.b.tail,
                             kept=KEPT) if self.a.separable and self.b.separable else None
        # decimal ids with the mark behind them: in a group, at the end of its first half, at its end
        size_a, size_b = len(self.a.bytes_of), len(self.b.bytes_of)
        self.names = pa.array([f"{i}{mark}" for size, marks in ((size_a, ",|"), (size_b, ",;")) for mark in marks for i in range(size)])

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of both sides in one stream, those of the second marked; of a chunk whose bytes a side changes, ``BROKEN``."""
        out = []
        for c, a, b in zip(chunks, self.a.ids(chunks), self.b.ids(chunks)):
            data = c.encode()
            whole = all(b"".join([side.bytes_of[k] for k in ids]) == data for side, ids in ((self.a, a), (self.b, b)))
            out.append(array("I", [*a, *[k + SECOND for k in b]] if whole else [BROKEN]).tobytes())
        return out

    def streams(self, texts: list[str]) -> list[np.ndarray]:
        if self.chunks is not None:
            return self.chunks.joined(texts)
        return [np.frombuffer(b, np.uint32) for b in self._encode([" " + t for t in texts])]

    def forget(self) -> None:
        if self.chunks is not None:
            self.chunks.forget()

    def of(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], list[np.ndarray], list[np.ndarray]]:
        """Of each text: (n_a, n_b, n_groups, n_links), the written groups, the distinct linked pairs and their links.

        All texts are aligned as one sequence of tokens: where a text ends, tokens of both sides end.
        """
        n = len(texts)
        streams = [s if t and not (s == BROKEN).any() else s[:0] for t, s in zip(texts, self.streams(texts))]
        flat = np.concatenate([np.empty(0, np.uint32), *streams]).astype(np.int64)
        of = np.repeat(np.arange(n), [len(s) for s in streams])
        second = flat >= SECOND
        a, b, of_a, of_b = flat[~second], flat[second] - SECOND, of[~second], of[second]
        links_a, links_b, ends_a, ends_b = alignment(*(np.cumsum(size[x]) for size, x in zip(self.lengths, (a, b))))
        counts = np.stack([np.bincount(x, minlength=n) for x in (of_a, of_b, of_a[ends_a - 1], of_a[links_a])], axis=1)
        size_a, size_b = (len(x) for x in self.lengths)
        key, times = np.unique((of_a[links_a] * size_a + a[links_a]) * size_b + b[links_b], return_counts=True)
        text, pair = np.divmod(key, size_a * size_b)
        pair = pair // size_b << SHIFT | pair % size_b
        cut = np.searchsorted(text, np.arange(1, n))
        return counts, self._written(a, b, ends_a, ends_b, counts), np.split(pair, cut), np.split(times, cut)

    def _written(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The groups of each text, ``a1,a2|b1;a3|b2,b3``: ids of both sides in order.

        Tokens of a group stand behind those of earlier groups, the first side before the second; taking their names in that
        order writes all texts at once.
        """
        size_a, size_b = (len(x) for x in self.lengths)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[ends_a - 1] = last_b[ends_b - 1] = 1
        before_b = np.concatenate([[0], ends_b[:-1]]) if len(ends_b) else ends_b
        at_a = np.arange(len(a)) + np.repeat(before_b, np.diff(ends_a, prepend=0))
        at_b = np.arange(len(b)) + np.repeat(ends_a, np.diff(ends_b, prepend=0))
        names = np.empty(len(a) + len(b), np.int64)
        names[at_a] = a + size_a * last_a
        names[at_b] = b + size_b * last_b + 2 * size_a
        written = self.names.take(pa.array(names)).cast(pa.large_string())
        offsets = np.frombuffer(written.buffers()[1], np.int64) if len(names) else np.zeros(1, np.int64)
        data = memoryview(written.buffers()[2]) if len(names) else memoryview(b"")
        ends = np.concatenate([[0], np.cumsum(counts[:, 0] + counts[:, 1])])
        return [bytes(data[offsets[x]:max(offsets[x], offsets[y] - 1)]) for x, y in zip(ends[:-1], ends[1:])]


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, path_a: str, path_b: str, text: str = "text", with_groups: bool = False) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, n_links, groups_sha256, and the linked id pairs: ``pairs`` and ``times`` (arrays of long).

    Side a is the byte-level file over a space and the text, side b the sentencepiece model over the text. Two tokens are
    linked if their byte ranges overlap; ``pairs`` are the distinct linked ids (``a << 32 | b``) and ``times`` how many links have
    them. Null and empty texts, and texts whose tokens do not give back the bytes, have no tokens: zeros, empty arrays and the
    empty string. With ``with_groups`` the groups themselves come too, as ``groups``. Rows are aligned one by one: repeated rows
    and null keys need nothing special, long texts are whole, an empty table gives an empty table; input columns named like
    results are replaced.
    """
    new = [*[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")], T.StructField("groups_sha256", T.StringType()),
           T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType())),
           *([T.StructField("groups", T.StringType())] if with_groups else [])]
    names = [c for c in docs.columns if c.lower() not in {f.name for f in new}]
    source = docs.select(*names, F.coalesce(F.col(text), F.lit("")).alias(fresh(docs, "whole_text")))
    schema = T.StructType([*source.schema.fields[:-1], *new])

    def lists(rows: list[np.ndarray]) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64), pa.int64()))

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            for lo, hi in pieces(batch.column(len(names)), SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                texts = part.column(len(names)).to_pylist()
                counts, written, pairs, times = aligner.of(texts)
                digests = [hashlib.sha256(w).hexdigest() if w else "" for w in written]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *[pa.array(counts[:, k], pa.int64()) for k in range(4)], pa.array(digests, pa.string()),
                     lists(pairs), lists(times), *([pa.array(written, pa.binary()).cast(pa.string())] if with_groups else [])], names=schema.names)
        aligner.forget()

    return source.mapInArrow(through, schema)


def pair_counts(rows: DataFrame, held: int = HELD_PAIRS) -> DataFrame:
    """(pair, docs, best): how many rows hold each pair in ``pairs``, and whether that is the highest of its first id.

    A task adds up the counts of its own rows and hands them on whenever it holds ``held`` pairs, so a pair of every
    document leaves it a few times, not once a document.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(docs)], names=["pair", "docs"])

        pairs, docs, fresh_pairs, waiting = np.empty(0, np.int64), np.empty(0, np.int64), [], 0
        for batch in batches:
            got = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            fresh_pairs.append(got)
            waiting += len(got)
            if waiting >= held:
                pairs, docs = _added(pairs, docs, fresh_pairs)
                fresh_pairs, waiting = [], 0
                if len(pairs) >= held:
                    yield out(pairs, docs)
                    pairs, docs = pairs[:0], docs[:0]
        pairs, docs = _added(pairs, docs, fresh_pairs)
        yield out(pairs, docs)

    partial = rows.select("pairs").mapInArrow(counted, "pair long, docs long")
    counts = partial.groupBy("pair").agg(F.sum("docs").alias("docs"))
    first = F.shiftright("pair", SHIFT)
    # the pairs of one first id are bounded by the size of the other vocabulary
    tops = counts.groupBy(first.alias("first")).agg(F.max("docs").alias("top"))
    return (counts.withColumn("first", first).join(tops, "first")
            .select("pair", "docs", (F.col("docs") == F.col("top")).alias("best")))


def _added(pairs: np.ndarray, docs: np.ndarray, more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    new = np.concatenate([pairs, *more])
    weight = np.concatenate([docs, np.ones(len(new) - len(docs), np.int64)])
    found, at = np.unique(new, return_inverse=True)
    return found, np.bincount(at, weights=weight, minlength=len(found)).astype(np.int64)


def scored_links(rows: DataFrame, row_id: str, counts: DataFrame, most: int = MOST_PAIRS) -> DataFrame:
    """``rows`` of ``aligned`` with n_best and count_sum in place of pairs and times: the links whose pair is the best of its first id, and
    the sum of the links' document counts.

    ``rows`` and ``counts`` (of ``pair_counts``) are stored tables, and ``row_id`` differs in all rows. Up to ``most`` pairs are broadcast: all,
    if there are no more; else those of at least R / ``most`` documents, where R is the sum of all counts, so there can't be more
    than ``most`` of them. The other pairs are joined by a shuffle, in which no pair has more than R / ``most`` rows.
    """
    links = rows.select(row_id, F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        row_id, F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    n, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    if n <= most:
        found = links.join(F.broadcast(counts), "pair")
    else:
        often = F.col("docs") * most >= total
        hot = links.join(F.broadcast(counts.where(often)), "pair", "left")
        rare = hot.where(F.col("docs").isNull()).select(row_id, "pair", "times").join(counts.where(~often), "pair")
        found = hot.where(F.col("docs").isNotNull()).unionByName(rare)
    sums = found.groupBy(row_id).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                     F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    kept = [c for c in rows.columns if c.lower() not in ("n_best", "count_sum", "pairs", "times")]
    return rows.select(*kept).join(sums, row_id, "left").select(
        *[c for c in kept if c != row_id], F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"))


def with_alignment(docs: DataFrame, path_a: str, path_b: str, text: str = "text", most: int = MOST_PAIRS) -> DataFrame:
    """``docs`` with the counts of ``aligned``, n_best and count_sum: alignment, corpus-wide pair counts and their sums per row.

    Texts are aligned once; the linked pairs of each row are stored in the shared folder for the second pass. Of tables with
    large columns pass those that are needed.
    """
    row_id = fresh(docs, "row_id")
    rows = stored(aligned(docs, path_a, path_b, text).withColumn(row_id, F.monotonically_increasing_id()), "alignment")
    return scored_links(rows, row_id, stored(pair_counts(rows), "pair-counts"), most)
