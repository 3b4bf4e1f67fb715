"""Benchmark passages in documents: CGK embeddings of item-sized windows, bit-sampling LSH, exact edit distance."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import fresh, mix, pieces, stored, word_hashes

#: edits (words inserted, dropped or replaced) a passage may have, as a share of the item's words
EDIT_SHARE = 0.2
#: items with fewer words match only word for word
MIN_WORDS = 5
#: sampled positions a key, and the most keys a window; classes that these don't serve are searched by segments
SAMPLED, MOST_KEYS = 4, 64
TARGET_RECALL = 0.95
#: edited copies of a size class's items, at least, that its number of keys follows from
TRIALS = 400
#: words, or keys, of items that a task holds for its filters, about; larger benchmarks are searched in slices
HELD = 4_000_000
#: bytes of text scanned, and windows embedded, at a time, so that the arrays stay in a processor's cache
PIECE, WINDOWS = 1 << 20, 1024
_GAP = np.uint64(0x2545F4914F6CDD1D)


def edits_allowed(n):
    return np.floor(EDIT_SHARE * np.asarray(n) + 1e-9).astype(np.int64)


def size_class(n: np.ndarray) -> np.ndarray:
    """The largest of 5, 6, 8, 10, 13, .. (each a quarter more) that is not above ``n``, below 5 ``n`` itself: windows of an item's class have that size."""
    n = np.asarray(n)
    steps = [MIN_WORDS]
    while steps[-1] <= n.max(initial=MIN_WORDS):
        steps.append(math.ceil(steps[-1] * 1.25))
    steps = np.array(steps)
    return np.where(n < MIN_WORDS, n, steps[np.maximum(0, np.searchsorted(steps, n, "right") - 1)])


@lru_cache(maxsize=256)
def _positions(size: int, keys: int) -> np.ndarray:
    """Sampled positions (keys x SAMPLED) of an embedding of a window of ``size`` words."""
    rng = np.random.default_rng([17, size])
    return np.sort(np.stack([rng.choice(2 * size, SAMPLED, replace=2 * size < SAMPLED) for _ in range(MOST_KEYS)])[:keys], axis=1)


def embed(h: np.ndarray, start: np.ndarray, end: np.ndarray, size: int, keys: int) -> np.ndarray:
    """LSH keys (windows x keys) of the windows of ``size`` words from ``start``; words from ``end`` on count as gaps.

    The CGK walk copies the word it stands on and then moves on or stays by a random bit of the step and the word. Two
    windows of small edit distance fall into step again after an edit, so their copies differ in few positions. Every key
    has a walk of its own and takes some positions of it.
    """
    places = _positions(size, keys)
    at = np.repeat(start[:, None], keys, axis=1)
    stop = np.minimum(end, start + size)[:, None]
    key = np.full((len(start), keys), np.uint64(size), np.uint64) + mix(np.arange(keys, dtype=np.uint64))[None, :]
    taken = np.zeros(keys, np.int64)
    for step in range(int(places.max(initial=0)) + 1):
        word = np.where(at < stop, h[np.minimum(at, len(h) - 1)], _GAP)
        hit = taken < SAMPLED
        hit[hit] = places[hit, taken[hit]] == step
        for k in np.flatnonzero(hit):
            while taken[k] < SAMPLED and places[k, taken[k]] == step:
                key[:, k] = mix(key[:, k] * np.uint64(0x9E3779B97F4A7C15) + word[:, k])
                taken[k] += 1
        salt = mix(np.uint64((step + 1) * 0xD6E8FEB86659FD93 % 2**64) + np.arange(keys, dtype=np.uint64))
        at += (mix(word ^ salt[None, :]) >> np.uint64(63)).astype(np.int64)
    return key


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Fewest word edits between ``a`` and any beginning of ``b``; ``most`` + 1 if there are more."""
    b = b[:len(a) + most]
    row = np.arange(len(b) + 1)
    steps = np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        change = np.empty_like(row)
        change[0] = i
        change[1:] = np.minimum(row[1:] + 1, row[:-1] + (b != x))
        row = np.minimum.accumulate(change - steps) + steps
        if row.min() > most:
            return most + 1
    return int(min(row.min(), most + 1))


def _words(texts: list[str]) -> list[np.ndarray]:
    h, first, *_ = word_hashes(pa.array(texts, pa.string()), letters=True)
    return [h[a:b] for a, b in zip(first[:-1], first[1:])]


def _edited(words: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """The words with as many random edits as are allowed, other words behind them, and where the first kept word is."""
    most = int(edits_allowed(len(words)))
    out, own = list(words), [True] * len(words)
    for _ in range(most):
        i, kind = int(rng.integers(len(out))), int(rng.integers(3))
        out[i:i + (kind != 0)] = [np.uint64(rng.integers(1, 2**63))] if kind != 2 else []
        own[i:i + (kind != 0)] = [False] if kind != 2 else []
    return np.concatenate([np.array(out, np.uint64), rng.integers(1, 2**63, most).astype(np.uint64)]), own.index(True)


def found_at(words: np.ndarray, rounds: int) -> np.ndarray:
    """For ``rounds`` edited copies of an item, the first key that it shares with the window from its first kept word; MOST_KEYS if none.

    The draws follow from the words alone.
    """
    rng = np.random.default_rng([5, len(words), int(np.bitwise_xor.reduce(words))])
    size = int(size_class(np.array([len(words)]))[0])
    copies, kept = zip(*[_edited(words, rng) for _ in range(rounds)])
    ends = np.cumsum([len(c) for c in copies])
    own = embed(words, np.array([0]), np.array([len(words)]), size, MOST_KEYS)
    same = embed(np.concatenate(copies), ends - [len(c) for c in copies] + np.array(kept), ends, size, MOST_KEYS) == own
    return np.where(same.any(axis=1), same.argmax(axis=1), MOST_KEYS)


def keys_needed(items: DataFrame, target: float = TARGET_RECALL) -> dict[int, int]:
    """Keys that windows of each size class need so that ``target`` of its items are found with as many random edits as are allowed.

    ``items`` has item_text, n and size. Found out by editing all items, each so often that a class has ``TRIALS`` copies; only counts
    per class and key are collected. The share of the copies must exceed the target by two standard errors. A class that ``MOST_KEYS``
    keys don't serve gets 0.
    """
    @F.arrow_udf("array<int>")
    def trial(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, rounds in batches:
            rows = [found_at(w, r).tolist() for w, r in zip(_words(texts.to_pylist()), rounds.to_pylist())]
            yield pa.array(rows, pa.list_(pa.int32()))

    rounds = items.groupBy("size").agg(F.ceil(F.lit(TRIALS) / F.count(F.lit(1))).cast("int").alias("rounds"))
    found = items.join(rounds, "size").select("size", F.explode(trial(F.col("item_text"), F.col("rounds"))).alias("at"))
    at: dict[int, np.ndarray] = {}
    for r in found.groupBy("size", "at").agg(F.count(F.lit(1)).alias("n")).collect():
        at.setdefault(r["size"], np.zeros(MOST_KEYS + 1, np.int64))[r["at"]] = r["n"]
    served = {size: np.cumsum(n)[:-1] >= target * n.sum() + 2 * math.sqrt(target * (1 - target) * n.sum()) for size, n in at.items()}
    return {size: int(ok.argmax()) + 1 if ok.any() else 0 for size, ok in served.items()}


def grams(h: np.ndarray, length: int, size: int) -> np.ndarray:
    """Hashes of the runs of ``length`` words from each word on, told apart by size class."""
    out = np.full(max(0, len(h) - length + 1), mix(np.array([size], np.uint64))[0])
    for k in range(length):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + len(out)])
    return out


def segments(words: np.ndarray, length: int, size: int) -> np.ndarray:
    """Hashes of the first ``length`` words of the item's segments, one more than edits, so that each passage has one of them unchanged."""
    parts = int(edits_allowed(len(words))) + 1
    return grams(words, length, size)[np.arange(parts) * len(words) // parts]


class Marks:
    """A set of hashes: sorted, behind a table of their lowest bits that answers most questions."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        size = 1 << min(26, max(16, int(16 * max(1, len(values))).bit_length()))
        self.mask = np.uint64(size - 1)
        self.table = np.zeros(size, bool)
        self.table[values & self.mask] = True

    def has(self, x: np.ndarray) -> np.ndarray:
        out = self.table[x & self.mask]
        if len(self.values):
            maybe = x[out]
            out[out] = self.values[np.minimum(np.searchsorted(self.values, maybe), len(self.values) - 1)] == maybe
        return out


@dataclass
class Search:
    """What a scan needs to know of its slice of the items: their sizes, the numbers of keys, their words, word pairs and keys."""
    words: Marks
    pairs: Marks
    known: Marks
    keys: dict[int, int]  # class -> keys a window; 0: by segments
    lengths: dict[int, int]  # class -> words of a segment that are compared
    sizes: dict[int, int] = field(default_factory=dict)  # class -> most edits of its items
    longest: dict[int, int] = field(default_factory=dict)
    changes: dict[int, int] = field(default_factory=dict)  # class -> fewest pairs in the first words of an item that differ from the pair before
    early: dict[int, Marks] = field(default_factory=dict)  # class -> words that the first kept word of an item can be
    short: list[int] = field(default_factory=list)  # numbers of words of items that match only word for word


def _search(parts: DataFrame, keys: dict[int, int], lengths: dict[int, int]) -> Search:
    rows = parts.select("item_text", "keys").toPandas()
    words = _words(rows["item_text"].tolist())
    out = Search(Marks(np.concatenate(words)), Marks(np.concatenate([_pairs(w) for w in words])),
                 Marks(np.concatenate([np.asarray(k, np.int64) for k in rows["keys"]]).view(np.uint64)), keys, lengths)
    of: dict[int, list[np.ndarray]] = {}
    for w in words:
        of.setdefault(int(size_class(np.array([len(w)]))[0]), []).append(w)
    out.short = sorted(size for size in of if size < MIN_WORDS)
    for size, group in of.items():
        if size < MIN_WORDS:
            continue
        out.longest[size] = max(map(len, group))
        out.sizes[size] = most = int(edits_allowed(out.longest[size]))
        out.early[size] = Marks(np.concatenate([w[:most + 1] for w in group]))
        both = [_pairs(w[:size]) for w in group]
        out.changes[size] = min(size, min(int((b[1:] != b[:-1]).sum()) for b in both))
    return out


def _pairs(h: np.ndarray) -> np.ndarray:
    return mix(h[:-1] * np.uint64(3) + h[1:])


def _measured(items: DataFrame) -> DataFrame:
    @F.arrow_udf("struct<n:bigint,size:bigint>")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n = np.array([len(w) for w in _words(batch.to_pylist())], np.int64)
            yield pa.StructArray.from_arrays([pa.array(n), pa.array(size_class(n))], ["n", "size"])
    return items.withColumn("m", measure(F.col("item_text"))).select("item", "item_text", "m.*")


def _item_keys(items: DataFrame, keys: dict[int, int], lengths: dict[int, int]) -> DataFrame:
    @F.arrow_udf("array<bigint>")
    def given(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, sizes in batches:
            rows = [grams(w, s, s) if s < MIN_WORDS else embed(w, np.array([0]), np.array([len(w)]), s, keys[s])[0] if keys[s]
                    else segments(w, lengths[s], s)
                    for w, s in zip(_words(texts.to_pylist()), sizes.to_pylist())]
            yield pa.array([r.view(np.int64).tolist() for r in rows], pa.list_(pa.int64()))
    return items.withColumn("keys", given(F.col("item_text"), F.col("size")))


def _windows(text: pa.Array, search: Search):
    """(row, start byte, end byte, keys) of the windows of some texts that may hold an item, and the bytes."""
    h, first, begin, finish, data = word_hashes(text, letters=True)
    if not len(h):
        return
    row = np.repeat(np.arange(len(text)), np.diff(first))
    end = first[1:][row]
    for size in search.short:
        gram = grams(h, size, size)
        at = np.flatnonzero((end[:len(gram)] - np.arange(len(gram)) >= size) & search.known.has(gram))
        at = at[np.unique(np.stack([row[at].astype(np.uint64), gram[at]]), axis=1, return_index=True)[1]]  # each item once a text
        for lo in range(0, len(at), WINDOWS):
            part = at[lo:lo + WINDOWS]
            yield row[part], begin[part], finish[part + size - 1], [gram[k:k + 1] for k in part], data
    if not search.sizes:
        return
    flag = search.words.has(h)
    total = np.concatenate([[0], np.cumsum(flag, dtype=np.int32)])
    both = _pairs(h)
    pair = np.append(search.pairs.has(both) & (row[1:] == row[:-1]), False)
    pairs = np.concatenate([[0], np.cumsum(pair, dtype=np.int32)])
    fresh_pair = pair & np.concatenate([[True], both[1:] != both[:-1], [False]])[:len(h)]
    fresh_pairs = np.concatenate([[0], np.cumsum(fresh_pair, dtype=np.int32)])
    for size, most in search.sizes.items():
        stop = np.minimum(np.arange(size, len(h) + size), end)
        # a window that begins with the first kept word of an item, one of its first words, shares all of its words but one an edit, all of its word pairs but two an
        # edit, and all of its pairs that differ from the pair before (which repeated words lack) but three an edit
        near = np.flatnonzero(flag & (total[stop] - total[:-1] >= size - most))
        near = near[pairs[stop[near] - 1] - pairs[near] >= size - 1 - 2 * most]
        near = near[search.early[size].has(h[near])]
        start = near[fresh_pairs[stop[near] - 1] - fresh_pairs[near] >= search.changes[size] - 3 * most]
        if not search.keys[size] and len(start):
            # from each window's first word to the last that a passage can have: all segments that stand there
            length = search.lengths[size]
            gram = grams(h, length, size)
            at = np.flatnonzero((end[:len(gram)] - np.arange(len(gram)) >= length) & search.known.has(gram))
            lo, hi = np.searchsorted(at, start), np.searchsorted(at, np.minimum(start + search.longest[size] + most, end[start]) - length, "right")
            for k in range(0, len(start), WINDOWS):
                on = k + np.flatnonzero(hi[k:k + WINDOWS] > lo[k:k + WINDOWS])
                if len(on):
                    part = start[on]
                    last = np.minimum(part + search.longest[size] + most, end[part]) - 1
                    yield row[part], begin[part], finish[last], [gram[at[a:b]] for a, b in zip(lo[on], hi[on])], data
            continue
        for lo in range(0, len(start), WINDOWS):
            part = start[lo:lo + WINDOWS]
            keys = embed(h, part, end[part], size, search.keys[size])
            hit = search.known.has(keys)
            on = hit.any(axis=1)
            part, keys, hit = part[on], keys[on], hit[on]
            if len(part):
                last = np.minimum(part + search.longest[size] + most, end[part]) - 1
                yield row[part], begin[part], finish[last], [x[y] for x, y in zip(keys, hit)], data


def find_passages(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", target_recall: float = TARGET_RECALL, short_items: bool = True) -> DataFrame:
    """(key, node, item, edits) for each text that holds a passage of an item; ``node`` is a hash of the text.

    A passage matches if it can be turned into the item by at most ``EDIT_SHARE`` of the item's words inserted, dropped or
    replaced. Words are lower-cased runs of letters, digits and the marks on them, so punctuation and spaces don't matter; in scripts without
    spaces (``UNSPACED`` in ``common``) each letter is a word. Items of fewer than ``MIN_WORDS`` words are found word for word, or not at all without
    ``short_items``; null items, items without a word and null or empty texts match nothing. ``edits`` is the fewest over all places found. Equal
    texts share a node, so repeated rows give repeated results; items that repeat are found each. An empty
    table on either side gives an empty result; other columns are not read.

    Each text is scanned whole. Windows of an item's size class begin at every word; those that share too few words or word pairs
    with all items to be within the edits are passed over, which loses nothing. The others are embedded, and those that share a key with an item are compared
    with it exactly. Each size class has its own number of keys, which follows from ``target_recall`` for the hardest edits of all its items; a class
    for which ``MOST_KEYS`` keys are too few (long items) is searched by segments instead: one more than edits, so that one
    of them stands unchanged in each passage, and none is lost. Exact passages are always found. A benchmark of more than ``HELD`` words or
    keys is dealt into slices by the hash of the text, and the texts are scanned once for each, with the same result.
    """
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("item_text")).where("item_text IS NOT NULL")
    sized = stored(_measured(items).where(F.col("n") >= (1 if short_items else MIN_WORDS)), "sized-items")
    needed = keys_needed(sized.where(F.col("n") >= MIN_WORDS), target_recall)
    shortest = F.min(F.floor(F.col("n") / (F.floor(F.col("n") * EDIT_SHARE + 1e-9) + 1)))
    lengths = {r["size"]: int(r["length"]) for r in sized.groupBy("size").agg(shortest.alias("length")).collect()}
    measured = stored(_item_keys(sized, needed, lengths), "items")
    distinct = measured.select("item_text", "n", "keys").dropDuplicates(["item_text"])
    volume = distinct.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.greatest(F.sum("n"), F.sum(F.size("keys"))), F.lit(0)).alias("held")).first()
    slices = min(volume["items"], math.ceil(volume["held"] / max(1, HELD)))
    named = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))
    matches = []
    for k in range(slices):
        mine = F.pmod(F.xxhash64("item_text"), F.lit(slices)) == k
        if distinct.where(mine).isEmpty():
            continue
        found = _found(named, _search(distinct.where(mine), needed, lengths))
        met = (found.select("node", "window", F.explode(F.array_distinct("keys")).alias("k"))
               .join(measured.where(mine).select("item", "item_text", F.explode("keys").alias("k")), "k")
               .groupBy("node", "window", "item", "item_text").agg(F.count(F.lit(1)).alias("shared")))
        close = (met.where("shared > 0").withColumn("edits", _edits(F.col("item_text"), F.col("window"))).where("edits IS NOT NULL")
                 .groupBy("node", "item").agg(F.min("edits").alias("edits")))
        # item ids may repeat with other texts, so a pair can come from two slices
        matches.append(stored(close, "passages"))
    if not matches:
        matches = [docs.sparkSession.createDataFrame([], T.StructType([
            T.StructField("node", T.LongType()), T.StructField("item", items.schema["item"].dataType), T.StructField("edits", T.IntegerType())]))]
    best = matches[0] if len(matches) == 1 else reduce(DataFrame.unionAll, matches).groupBy("node", "item").agg(F.min("edits").alias("edits"))
    return named.select("key", "node").join(best, "node").select(F.col("key").alias(key), "node", "item", "edits")


def _found(named: DataFrame, search: Search) -> DataFrame:
    """(node, window, keys) of the windows that share keys with items of the slice."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, texts = batch.column("node"), batch.column("text")
            for lo, hi in pieces(texts, PIECE):
                for row, begin, finish, keys, data in _windows(texts.slice(lo, hi - lo), search):
                    for k in range(0, len(row), 1024):
                        cut = slice(k, k + 1024)
                        yield pa.RecordBatch.from_arrays([
                            node.take(pa.array(row[cut] + lo)),
                            pa.array([data[a:b].tobytes().decode(errors="replace") for a, b in zip(begin[cut], finish[cut])], pa.string()),
                            pa.array([x.view(np.int64).tolist() for x in keys[cut]], pa.list_(pa.int64()))],
                            names=["node", "window", "keys"])

    return named.select("node", "text").mapInArrow(scan, "node long, window string, keys array<bigint>")


def _edits(item_text: Column, window: Column) -> Column:
    """Edits between the item and the beginning of the window; null if there are too many, or if the window does not begin with
    one of the item's first words: what is found for an item must not follow from the other items of its slice.

    Called non-deterministic, for else Spark moves it before the grouping and compares a pair once per shared key.
    """
    @F.arrow_udf("int")
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for one, two in batches:
            out = []
            for a, b in zip(_words(one.to_pylist()), _words(two.to_pylist())):
                most = int(edits_allowed(len(a)))
                d = edit_distance(a, b, most) if len(b) and b[0] in a[:most + 1] else most + 1
                out.append(d if d <= most else None)
            yield pa.array(out, pa.int32())
    return count.asNondeterministic()(item_text, window)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                      item_text: str = "text", short_items: bool = False) -> DataFrame:
    """The documents without any passage of an item, with their own columns.

    Items of fewer than ``MIN_WORDS`` words drop nothing unless ``short_items`` says so: a clean text has them by chance.
    """
    node = fresh(docs, "node")
    bad = find_passages(docs, benchmark, key, text, item, item_text, short_items=short_items).select(F.col("node").alias(node)).distinct()
    return docs.withColumn(node, F.xxhash64(F.coalesce(F.col(text), F.lit("")))).join(bad, node, "left_anti").drop(node)
