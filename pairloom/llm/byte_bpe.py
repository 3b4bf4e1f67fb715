"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.chunks import Chunks
from pairloom.llm.common import fresh
from pairloom.llm.token_counts import byte_characters, in_byte_characters

#: rows that a worker turns into ids at a time, and bytes of chunks it keeps per generation: both bound its memory
SLICE, KEPT = 512, 24 << 20


# fixed value: the pattern of rank files whose texts may be cut before a single space
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class ByteBpe:
    """Encoder and decoder for a rank file.

    The vocabulary is written with one printable character per byte. Rank files merge any adjacent pair whose joined
    bytes have a rank, so every split of a token into two tokens becomes a merge with the rank of the token. Chunks are
    kept for the pattern whose cuts at spaces are known to be sound; with another one the library gets whole texts.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        names = byte_characters()
        written = {token: "".join([names[b] for b in token]) for token in ranks}
        merges = [(written[t[:k]], written[t[k:]]) for t in sorted(ranks, key=ranks.get)
                  for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.tokenizer = Tokenizer(models.BPE(vocab={written[t]: i for t, i in ranks.items()}, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # the way back: character -> byte, token by token
        byte_of = {c: b for b, c in names.items()}
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for name, i in self.tokenizer.get_vocab().items():
            self.bytes_of[i] = bytes([byte_of[c] for c in name])
        self.lengths = np.array([len(t) for t in self.bytes_of], np.int64)
        self.chunks = Chunks(self._encode_chunks, keep_space=True, kept=KEPT) if pattern == PATTERN else None

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """A chunk of one space at most and letters is one match of the pattern, so it goes straight to the merges."""
        merge, out = self.tokenizer.model.tokenize, [b""] * len(chunks)
        others = []
        for i, c in enumerate(chunks):
            if (c[1:] if c[:1] == " " else c).isalpha():
                out[i] = array("I", [t.id for t in merge(in_byte_characters(c))]).tobytes()
            else:
                others.append(i)
        for i, e in zip(others, self.tokenizer.encode_batch_fast([chunks[i] for i in others], add_special_tokens=False)):
            out[i] = array("I", e.ids).tobytes()
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.chunks is None:
            return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [x.view(np.int32) for x in self.chunks.joined(texts)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all tokens in a row; only together do they form characters again."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def starts(self, text: str, ids: np.ndarray) -> np.ndarray:
        """Position of the character in which each token begins; tokens of one split character share it."""
        data = np.frombuffer(text.encode(), np.uint8)
        if not len(ids):
            return np.empty(0, np.int32)
        at = np.concatenate([[0], np.cumsum(self.lengths[ids])[:-1]])
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        return character[at].astype(np.int32)


@lru_cache(maxsize=2)
def _bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32), pa.int32()))


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Token ids (array of int) of every whole text; a null text counts as empty and has no ids."""
    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _bpe(path, pattern)
        for batch in batches:
            yield _lists([x for lo in range(0, len(batch), SLICE) for x in bpe.encode(batch.slice(lo, SLICE).to_pylist())])
    return encode(F.coalesce(text, F.lit("")))


def starts(text: Column, ids: Column, path: str, pattern: str) -> Column:
    """Character offsets (array of int) at which the tokens of ``ids`` begin in ``text``."""
    @F.arrow_udf("array<int>")
    def locate(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        bpe = _bpe(path, pattern)
        for texts, rows in batches:
            yield _lists([bpe.starts(t, np.array(r, np.int64)) for t, r in zip(texts.to_pylist(), rows.to_pylist())])
    return locate(F.coalesce(text, F.lit("")), F.coalesce(ids, F.array().cast("array<int>")))


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that ``ids`` stand for; null ids give no bytes. They are UTF-8 when whole texts were encoded."""
    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _bpe(path, pattern)
        for batch in batches:
            ends, flat = batch.offsets.to_numpy(), batch.values.to_numpy()
            yield pa.array([bpe.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.binary())
    return decode(F.coalesce(ids, F.array().cast("array<int>")))


def encode_and_decode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None,
                      offsets: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with ``ids`` and ``decoded``, the bytes that the ids give back.

    With ``offsets`` also ``starts``, the character of the text in which each token begins.

    Null and empty texts have no ids and decode to no bytes. Every row is encoded by itself: repeated rows and null
    keys stay; input columns named ids or decoded are replaced. Texts are never cut short. Rows go through a worker
    in small slices, so its memory does not depend on the size of Arrow batches.
    """
    new = ("ids", "decoded", "starts") if offsets else ("ids", "decoded")
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    source = docs.select(*names, F.coalesce(F.col(text), F.lit("")).alias(fresh(docs, "whole_text")))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType()),
                           *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in new[2:]]])

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                texts = part.column(len(names)).to_pylist()
                ids = bpe.encode(texts)
                at = [_lists([bpe.starts(t, x) for t, x in zip(texts, ids)])] if offsets else []
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], _lists(ids), pa.array([bpe.decode(x) for x in ids], pa.binary()), *at], names=schema.names)
        if bpe.chunks is not None:
            bpe.chunks.forget()

    return source.mapInArrow(through, schema)
