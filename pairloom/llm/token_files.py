"""Token ids in patched frame-of-reference blocks, written in key order and read back.

A file set is a Parquet folder whose rows are segments; a segment holds whole documents. Its payload:

    header    magic "PFR1", number of ids, number of blocks
    index     start of each block in the payload (uint32 each, one more than blocks)
    blocks    minimum (uint32), width (uint8), number of exceptions (uint8), the low ``width`` bits of all 128 residuals,
              then the positions (uint8) and the whole residuals (uint32) of the exceptions

The columns beside the payload say where a segment stands (part, segment, ids before it in its part) and which documents it
holds (ids, lengths). Spark writes and reads the rows, so any store that Spark reaches will do.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.chunks import Chunks
from pairloom.llm.token_counts import in_byte_characters

BLOCK = 128
#: share of a block's residuals that the chosen width holds at least; the others are exceptions
PERCENTILE = 0.9
SEGMENT_IDS = 65536
#: texts that a worker encodes at a time
SLICE = 2048
#: bytes of a generation of cached chunks (a worker holds two): the distinct words of some tens of megabytes of prose
KEPT = 96 << 20
_MAGIC = b"PFR1"
#: widths that numbers of whole bytes have
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def _bits(x: np.ndarray) -> np.ndarray:
    """Number of significant bits of each value below 2**32."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64) * (x > 0)


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of the values of each row (blocks of 128), lowest first; 32 values fill ``width`` words."""
    values = values.reshape(-1, 32).T & np.uint32((1 << width) - 1)
    words = np.zeros((width, values.shape[1]), np.uint32)
    for k in range(32):
        word, shift = divmod(k * width, 32)
        words[word] |= values[k] << np.uint32(shift)
        if shift + width > 32:
            words[word + 1] |= values[k] >> np.uint32(32 - shift)
    return np.ascontiguousarray(words.T).astype("<u4", copy=False).view(np.uint8).reshape(-1, BLOCK * width // 8)


def _unpack_bits(packed: np.ndarray, width: int) -> np.ndarray:
    """The values that ``_pack_bits`` has packed."""
    words = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u4").reshape(-1, width).T)
    values = np.empty((32, words.shape[1]), np.uint32)
    for k in range(32):
        word, shift = divmod(k * width, 32)
        np.right_shift(words[word], np.uint32(shift), out=values[k])
        if shift + width > 32:
            values[k] |= words[word + 1] << np.uint32(32 - shift)
    values &= np.uint32((1 << width) - 1)
    return values.T.reshape(-1, BLOCK)


def pack(ids: np.ndarray) -> bytes:
    """The payload for ``ids`` (uint32). Blocks of one width are packed together."""
    n = len(ids)
    count = -(-n // BLOCK)
    if not count:
        return _MAGIC + struct.pack("<II", 0, 0) + struct.pack("<I", 16)
    padded = np.concatenate([ids, np.full(count * BLOCK - n, ids[-1], np.uint32)]).reshape(count, BLOCK)
    low = padded.min(1)
    rest = padded - low[:, None]
    width = _bits(np.sort(rest, axis=1)[:, int(np.ceil(PERCENTILE * BLOCK)) - 1])
    odd = rest >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    exceptions = odd.sum(1)
    sizes = 6 + 16 * width + 5 * exceptions
    first = 12 + 4 * (count + 1)
    starts = first + np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(starts[-1]), np.uint8)
    out[:12] = np.frombuffer(_MAGIC + struct.pack("<II", n, count), np.uint8)
    out[12:first] = starts.astype("<u4").view(np.uint8)
    at = starts[:-1]
    out[at[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(count, 4)
    out[at + 4], out[at + 5] = width, exceptions
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w in _WHOLE:
            packed = rest[rows].astype(_WHOLE[w]).view(np.uint8)
        elif w:
            packed = _pack_bits(rest[rows], int(w))
        if w:
            out[(at[rows] + 6)[:, None] + np.arange(16 * w)] = packed
    block, place = np.nonzero(odd)
    if len(block):
        k = np.arange(len(block)) - np.concatenate([[0], np.cumsum(exceptions)])[block]
        lists = at[block] + 6 + 16 * width[block]
        out[lists + k] = place
        values = lists + exceptions[block] + 4 * k
        out[values[:, None] + np.arange(4)] = rest[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes()


def unpack(payload: bytes, blocks: slice | None = None) -> np.ndarray:
    """The ids of a payload, or of a range of its blocks, found by the index of block starts."""
    n, count = struct.unpack_from("<II", payload, 4)
    if payload[:4] != _MAGIC:
        raise ValueError("not a payload of this format")
    lo, hi, _ = (blocks or slice(0, count)).indices(count)
    data = np.frombuffer(payload, np.uint8)
    at = np.frombuffer(payload, "<u4", hi - lo, 12 + 4 * lo).astype(np.int64)
    low = data[at[:, None] + np.arange(4)].copy().view("<u4").ravel()
    width, exceptions = data[at + 4].astype(np.int64), data[at + 5].astype(np.int64)
    rest = np.zeros((hi - lo, BLOCK), np.uint32)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        packed = data[(at[rows] + 6)[:, None] + np.arange(16 * w)]
        if w in _WHOLE:
            rest[rows] = packed.view(_WHOLE[w])
        elif w:
            rest[rows] = _unpack_bits(packed, int(w))
    if exceptions.any():
        block = np.repeat(np.arange(hi - lo), exceptions)
        k = np.arange(len(block)) - np.concatenate([[0], np.cumsum(exceptions)])[block]
        lists = at[block] + 6 + 16 * width[block]
        values = lists + exceptions[block] + 4 * k
        rest[block, data[lists + k]] = data[values[:, None] + np.arange(4)].copy().view("<u4").ravel()
    return (rest + low[:, None]).ravel()[: min(n, hi * BLOCK) - lo * BLOCK]


# fixed values: the steps before the merges that let texts be cut at spaces
STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed",
         "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "truncation": None, "padding": None, "post_processor": None,
}


class WordEncoder:
    """Ids of whole texts by the tokenizers library, for vocabularies whose white space is dropped.

    Texts are cut at spaces, which no token crosses, and each distinct piece goes to the library once while it stays in
    the cache. Where lower-casing first cannot change the result it is done first, so that more pieces are equal. That holds
    for files with ``STEPS``; with any other file the library gets the whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, steps = made["model"], {k: made.get(k) for k in STEPS}
        plain = steps == STEPS and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges")) and all(
            t["content"].startswith("<|") and not any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))
            and " " not in t["content"] for t in made.get("added_tokens", ()))
        self.chunks = Chunks(self._encode, keep_space=False, kept=KEPT) if plain else None

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """A lower-case word in normal form is one match of the pattern, so it goes straight to the merges."""
        merge, out = self.tokenizer.model.tokenize, [b""] * len(chunks)
        others = []
        for i, c in enumerate(chunks):
            if c.isascii():  # letters among the first 128 characters stand for their own bytes
                plain = c if c.isalpha() and c.islower() else None
            else:
                plain = in_byte_characters(c) if c.isalpha() and c == c.lower() and "Σ" not in c and unicodedata.is_normalized("NFC", c) else None
            if plain is not None:
                out[i] = array("I", [t.id for t in merge(plain)]).tobytes()
            else:
                others.append(i)
        for i, e in zip(others, self.tokenizer.encode_batch_fast([chunks[i] for i in others], add_special_tokens=False)):
            out[i] = array("I", e.ids).tobytes()
        return out

    @staticmethod
    def lowered(text: str) -> str:
        if "<|" in text or "Σ" in text:  # special strings have a case; a capital sigma has two small forms
            return text
        if text.isascii():
            return text.lower()
        low = text.lower()
        return low if unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low) else text

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if self.chunks is None:
            return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return self.chunks.joined([self.lowered(t).replace("\n", " ") for t in texts])


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encodes every whole text, appends ``end_id`` and writes the ids as segments in ascending key order.

    Rows with a null key come first; rows of equal key stand in the order of their text hash, and rows that are equal in both give equal
    ids, so the file content does not depend on how Spark dealt the rows. Null and empty texts give ``end_id`` alone. A range
    partitioning by key and text hash splits even a key that a third of the rows share, unless their texts are equal
    too. Columns other than key and text are not read. An empty table gives an empty file set.
    """
    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(F.col("key").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("key").asc_nulls_first(), F.xxhash64("text")).withColumn("part", F.spark_partition_id())
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("segment", T.IntegerType()), T.StructField("before", T.LongType()),
        T.StructField("n_ids", T.LongType()), T.StructField("keys", T.ArrayType(kind)), T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("payload", T.BinaryType())])
    end = np.array([end_id], np.uint32)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        arrow = None
        part = number = before = held = 0
        keys, ids = [], []

        def flush() -> pa.RecordBatch:
            data = np.concatenate(ids)
            row = {"part": [part], "segment": [number], "before": [before], "n_ids": [len(data)], "keys": [keys],
                   "lengths": [[len(x) for x in ids]], "payload": [pack(data)]}
            return pa.RecordBatch.from_arrays([
                pa.array(row["part"], pa.int32()), pa.array(row["segment"], pa.int32()), pa.array(row["before"], pa.int64()),
                pa.array(row["n_ids"], pa.int64()), pa.array(row["keys"], pa.list_(arrow)), pa.array(row["lengths"], pa.list_(pa.int64())),
                pa.array(row["payload"], pa.binary())], names=schema.names)

        for batch in batches:
            arrow = batch.schema.field("key").type
            for lo in range(0, batch.num_rows, SLICE):
                names, texts, (part, *_) = (batch.column(c).slice(lo, SLICE).to_pylist() for c in ("key", "text", "part"))
                for name, got in zip(names, encoder.ids(texts)):
                    keys.append(name)
                    ids.append(np.append(got, end))
                    held += len(got) + 1
                    if held >= SEGMENT_IDS:
                        yield flush()
                        keys, ids, number, before, held = [], [], number + 1, before + held, 0
        if ids:
            yield flush()

    ordered.mapInArrow(segments, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a file set: key, start (ids of all documents before it), n_tokens, ids (array of long).

    Segments are unpacked where Spark reads them; the starts of parts, a few numbers per file, are summed first.
    """
    return documents_of(spark, path, "array<bigint>", lambda ids: ids.astype(np.int64))


def documents_of(spark: SparkSession, path: str, kind: str, of) -> DataFrame:
    """Like ``read_token_files`` with ``of(ids)`` in place of the ids, computed while a segment is unpacked."""
    files = spark.read.parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    offsets = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    name = files.schema["keys"].dataType.elementType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("key", name), T.StructField("within", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T._parse_datatype_string(kind))])

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("part", "before", "keys", "lengths", "payload")}
                ids = unpack(row["payload"])
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(ends), pa.int32()), pa.array(row["keys"], arrow.field("key").type),
                    pa.array(starts + row["before"], pa.int64()), pa.array(row["lengths"], pa.int64()),
                    pa.array([of(ids[a:b]) for a, b in zip(starts, ends)], arrow.field("ids").type)], schema=arrow)

    return (files.mapInArrow(unpacked, schema).join(offsets, "part")
            .select("key", (F.col("offset") + F.col("within")).alias("start"), "n_tokens", "ids"))


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
