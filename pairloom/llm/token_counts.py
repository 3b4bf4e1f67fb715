"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are produced."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.chunks import Chunks
from pairloom.llm.common import text_or_empty

# fixed values: the split pattern of byte-level vocabularies; its \s is the Unicode property of white space
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: texts that a worker counts at a time
SLICE = 2048
_BITS = 20
_LOW = (1 << _BITS) - 1


def byte_characters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    out.update({b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in out)})
    return out


def in_byte_characters(text: str) -> str:
    return text.encode().decode("latin-1").translate(byte_characters_of)


byte_characters_of = byte_characters()


def require_byte_level(made: dict, path: str) -> None:
    """Raises a ValueError unless the file says what ``MergeCounter`` does: no normaliser, the byte-level pattern, plain merges."""
    model, cut = made["model"], made.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
           if model.get(k)]
    if (made.get("normalizer") or model.get("type") != "BPE" or odd or made.get("truncation") or made.get("padding")
            or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True)):
        raise ValueError(f"{path} is no plain byte-level BPE file")
    if any(t.get(k) for t in made.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path} has added tokens that take in text around them")


class MergeCounter:
    """Counts tokens of texts by the merges of a byte-level tokenizer file; other files are refused."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        require_byte_level(made, path)
        vocab = made["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in made["model"]["merges"]]
        # left id and right id -> rank and id of the merged symbol
        self.merges = {vocab[a] << _BITS | vocab[b]: rank << _BITS | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        names = byte_characters()
        self.first = [vocab[names[b]] for b in range(256)]
        special = sorted((t["content"] for t in made["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.split = regex.compile(PATTERN)
        self.chunks = Chunks(lambda todo: [self.of_text(c) for c in todo], keep_space=True)

    def of_piece(self, piece: bytes) -> int:
        """Initial symbols minus merges: the adjacent pair of lowest rank, leftmost first, is merged again and again."""
        n = len(piece)
        if n < 2:
            return n
        get, first = self.merges.get, self.first
        ids = [first[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            v = get(ids[i] << _BITS | ids[i + 1])
            if v is not None:
                heap.append((v >> _BITS) << 40 | i)
        heapq.heapify(heap)
        left = n
        while heap:
            e = heapq.heappop(heap)
            i = e & 0xFFFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            v = get(ids[i] << _BITS | ids[j])
            if v is None or v >> _BITS != e >> 40:
                continue  # one of the two symbols has changed since
            ids[i], ids[j] = v & _LOW, -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                v = get(ids[i] << _BITS | ids[k])
                if v is not None:
                    heapq.heappush(heap, (v >> _BITS) << 40 | i)
            p = before[i]
            if p >= 0:
                v = get(ids[p] << _BITS | ids[i])
                if v is not None:
                    heapq.heappush(heap, (v >> _BITS) << 40 | p)
        return left

    def of_text(self, text: str) -> int:
        """Tokens of a text; a special string counts as the one token it stands for."""
        if self.special is None or not (found := self.special.findall(text)):
            return sum(self.of_piece(p.encode()) for p in self.split.findall(text))
        return len(found) + sum(self.of_piece(p.encode()) for part in self.special.split(text) for p in self.split.findall(part))

    def of_texts(self, texts: list[str]) -> list[int]:
        return self.chunks.sums(texts).tolist()


@lru_cache(maxsize=2)
def _counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_count(text: Column, tokenizer_path: str) -> Column:
    """Number of tokens (long) of every whole text; a null or empty text has none."""
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(tokenizer_path)
        for s in batches:
            texts = s.tolist()
            yield pd.Series([n for lo in range(0, len(texts), SLICE) for n in counter.of_texts(texts[lo:lo + SLICE])], dtype="int64")
    return count(F.coalesce(text, F.lit("")))


def with_token_counts(docs: DataFrame, tokenizer_path: str, limit: int, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    Null and empty texts have no bytes and no tokens. Rows are counted one by one, so repeated rows and null keys stay
    as they are; input columns of the same names are replaced. Very long texts are whole: a run of n letters
    costs n log n.
    """
    names = [c for c in docs.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")]
    counted = docs.select(*names, F.octet_length(text_or_empty(text)).cast("long").alias("n_bytes"),
                          token_count(F.col(text), tokenizer_path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
