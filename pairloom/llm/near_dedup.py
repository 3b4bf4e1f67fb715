"""Near-duplicate classes: ProbMinHash signatures of weighted word shingles, banding, and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import fresh, mix, pieces, stored, word_hashes
from pairloom.llm.components import components

WORDS = 5
SIMILARITY = 0.8
#: bands and registers a band: pairs of similarity 0.8 share a band with probability 1 - (1 - 0.8**5)**20 > 0.999
BANDS, ROWS = 20, 5
#: rounds in which the members of a bucket are compared with one hub, before those of different classes that are left meet in blocks
HUB_ROUNDS = 2
#: texts on either side of a block
BLOCK = 128
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all ``words``-word shingles and the position of each text's first one.

    A text with fewer words has one shingle of all its words; a text without words has none.
    """
    h, first, *_ = word_hashes(texts)
    n = np.diff(first)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    start = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(start[-1], np.uint64)
    row = np.repeat(np.arange(len(n)), count)
    at = first[row] + np.arange(len(out)) - start[row]
    for k in range(words):
        held = k < n[row]
        out += np.where(held, h[np.minimum(at + k, max(0, len(h) - 1))] if len(h) else 0, np.uint64(0)) * _ODD[k % 8] * np.uint64(2 * k + 1)
    return mix(out + np.minimum(n, words)[row].astype(np.uint64)), start


def prob_min_hash(element: np.ndarray, weight: np.ndarray, row: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """Signatures (rows x registers) of the weighted sets in ``row``: the element that reaches each register first.

    An element arrives by a Poisson process of its weight's rate and each arrival hits a random register, all by
    draws that depend on the element alone. Two sets agree in a register with their probability Jaccard
    similarity. An element drops out once it comes later than the last of its set's registers was taken;
    later arrivals can't change anything.
    """
    time = np.full((rows, registers), np.inf)
    taken = np.zeros((rows, registers), np.uint64)
    flat_time, flat_taken = time.ravel(), taken.ravel()
    t = np.zeros(len(element))
    arrival = 0
    while len(element):
        arrival = (arrival + 0x9E3779B97F4A7C15) % 2**64
        draw = mix(element + np.uint64(arrival))
        t = t - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0 ** -53) / weight
        slot = row * registers + (mix(draw) >> np.uint64(33)).astype(np.int64) % registers
        np.minimum.at(flat_time, slot, t)
        won = t == flat_time[slot]
        flat_taken[slot[won]] = element[won]
        open_rows = np.unique(row)
        last = np.zeros(rows)
        last[open_rows] = time[open_rows].max(axis=1)
        on = t < last[row]
        element, weight, row, t = element[on], weight[on], row[on], t[on]
    return taken


def _bands(signatures: np.ndarray) -> np.ndarray:
    """One key per band of each signature."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS)
    return mix((parts * _ODD[:ROWS]).sum(axis=2, dtype=np.uint64) + mix(np.arange(BANDS, dtype=np.uint64)[None, :]))


def _keys(texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct shingles and band keys of every text.

    Shingles weigh as often as they occur. A text in which some occur more than once also gets the keys of the same set
    without weights, so that similarity of the sets is found as well; for all other texts both are equal.
    """
    h, start = shingles(texts)
    rows = len(texts)
    row = np.repeat(np.arange(rows, dtype=np.uint64), np.diff(start))
    both = np.sort((row << np.uint64(40)) | (h >> np.uint64(24)))  # a text's shingles side by side, by 40 bits of their hash
    head = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.empty(0, np.int64)
    weight = np.diff(np.concatenate([head, [len(both)]])).astype(np.float64)
    row = (both[head] >> np.uint64(40)).astype(np.int64)
    element = mix(both[head] & np.uint64((1 << 40) - 1))
    count = np.bincount(row, minlength=rows)
    keys: list[np.ndarray] = [np.empty(0, np.uint64)] * rows
    full = np.flatnonzero(count)
    place = np.zeros(rows, np.int64)
    place[full] = np.arange(len(full))
    for i, k in zip(full, _bands(prob_min_hash(element, weight, place[row], len(full), BANDS * ROWS))):
        keys[i] = k
    several = np.unique(row[weight > 1])
    if len(several):
        place[several] = np.arange(len(several))
        own = np.isin(row, several)
        flat = prob_min_hash(element[own], np.ones(int(own.sum())), place[row[own]], len(several), BANDS * ROWS)
        for i, k in zip(several, _bands(flat)):
            keys[i] = np.unique(np.concatenate([keys[i], k]))
    return count, keys


def band_keys(text: Column) -> Column:
    """Band keys (array of long) of every whole text; none for a text without words."""
    @F.arrow_udf("array<bigint>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            keys: list[np.ndarray] = []
            for lo, hi in pieces(batch):
                keys += _keys(batch.slice(lo, hi - lo))[1]
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
            yield pa.ListArray.from_arrays(ends, pa.array(flat, pa.int64()))
    return sign(F.coalesce(text, F.lit("")))


def jaccard(left: Column, right: Column) -> Column:
    """Exact Jaccard similarity of the shingle sets of two texts; 0 if either has none."""
    @F.arrow_udf("double")
    def compare(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for one, two in batches:
            out = []
            for lo, hi in pieces(one):
                (ha, sa), (hb, sb) = shingles(one.slice(lo, hi - lo)), shingles(two.slice(lo, hi - lo))
                for i in range(hi - lo):
                    x, y = np.unique(ha[sa[i]:sa[i + 1]]), np.unique(hb[sb[i]:sb[i + 1]])
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    out.append(same / max(1, len(x) + len(y) - same))
            yield pa.array(out, pa.float64())
    return compare(left, right)


def _links(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough. Both sides of each join are plain shuffles, so adaptive execution
    splits the rows of a hub that many texts are compared with."""
    met = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
           .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return met.where(jaccard(F.col("text_a"), F.col("text_b")) >= similarity).select("a", "b")


def _block_links(open_members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links between texts of different classes that still share buckets, directly or through others.

    Such texts form families. All pairs of different classes in a family hold a text outside its largest class; those texts meet
    the whole family in blocks of ``BLOCK`` by ``BLOCK`` texts, dealt to tasks by family and block numbers. Overlaps are counted
    inside a block, and only links leave it: one for each text and class it is similar to.
    """
    low = open_members.groupBy("band").agg(F.min("node").alias("low"))
    family = components(open_members.join(low, "band").select("node", "low").distinct(), "node", "low")
    nodes = stored(open_members.select("node", F.col("label").alias("class")).distinct().join(family, "node").withColumnRenamed("label", "family"), "families")
    classes = nodes.groupBy("family", "class").agg(F.count(F.lit(1)).alias("n"))
    sizes = classes.groupBy("family").agg(F.sum("n").alias("all"), F.max(F.struct("n", "class")).alias("main")).select(
        "family", F.col("main.class").alias("main"), F.ceil(F.col("all") / BLOCK).alias("n_all"), F.ceil((F.col("all") - F.col("main.n")) / BLOCK).alias("n_rest"))
    met = nodes.join(sizes, "family")
    spread = F.xxhash64(F.lit(3), F.col("node"))

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    rest = met.where("class <> main").select("family", F.pmod(spread, "n_rest").alias("row"), every(F.col("n_all")).alias("col"), F.lit(0).alias("side"), "node", "class")
    whole = met.where("n_rest > 0").select("family", every(F.col("n_rest")).alias("row"), F.pmod(spread, "n_all").alias("col"), F.lit(1).alias("side"), "node", "class")

    def compare(table: pa.Table) -> pa.Table:
        side, node, kind = (table.column(c).to_numpy() for c in ("side", "node", "class"))
        h, start = shingles(table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string()))
        sets = [np.unique(h[a:b]) for a, b in zip(start[:-1], start[1:])]
        right = np.flatnonzero(side == 1)
        size = np.array([len(sets[i]) for i in right], np.int64)
        held = np.concatenate([sets[i] for i in right]) if len(right) else np.empty(0, np.uint64)
        order = np.argsort(held, kind="stable")
        held, owner = held[order], np.repeat(np.arange(len(right)), size)[order]
        a, b = [], []
        for i in np.flatnonzero(side == 0) if len(held) else ():
            first, last = np.searchsorted(held, sets[i]), np.searchsorted(held, sets[i], "right")
            n = last - first
            at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            same = np.bincount(owner[at], minlength=len(right))
            close = right[(same >= similarity * (len(sets[i]) + size - same)) & (same > 0) & (kind[right] != kind[i])]
            found = close[np.unique(kind[close], return_index=True)[1]]
            a += [int(node[i])] * len(found)
            b += node[found].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return (rest.unionAll(whole).join(texts, "node").groupBy("family", "row", "col").applyInArrow(compare, "a long, b long")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: its key, ``node`` (a 64-bit hash of its text), ``label`` and ``class_id``.

    Rows are in one class if their texts are equal, or linked by a chain of pairs whose shingle sets have a Jaccard
    similarity of ``similarity`` or more. ``label`` is the smallest node of the class, ``class_id`` the smallest
    key (null only if all its keys are). Null texts count as empty; texts without words are alike only if
    equal. Repeated rows get a row each. Columns beyond key and text are not read; an empty table gives
    an empty result.

    Equal texts are one node. In each bucket of a band the members are first compared with one hub (its smallest node),
    and classes are formed. Buckets that still hold several classes get a further round with another hub, for members
    outside the hub's class. At last the texts of different classes that still share buckets are compared in blocks
    (``_block_links``). So no candidate pair that could join two classes is left out, and the members of a large class cost
    a comparison or two each; only texts that share buckets with a large class and are like none of it meet all of it.
    """
    plain = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = plain.withColumn("node", F.xxhash64("text"))
    signed = stored(named.select("key", "node", band_keys(F.col("text")).alias("bands")), "signatures")
    members = signed.select(F.explode("bands").alias("band"), "node").distinct()
    shared = members.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    members = stored(members.join(shared.select("band"), "band"), "buckets")
    wanted = members.select("node").distinct()
    # equal texts are reduced before anything moves, so copies of one text don't meet in a task
    texts = stored(named.groupBy("node").agg(F.min("text").alias("text")).join(wanted, "node"), "texts")
    spark = docs.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "node long, label long")
    for turn in range(HUB_ROUNDS + 1):
        at = members.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
        split = at.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        at = stored(at.join(split.select("band"), "band"), "open-buckets") if turn else at
        if turn and at.isEmpty():
            break
        if turn == HUB_ROUNDS:
            links = links.unionAll(stored(_block_links(at, texts, similarity), "similar"))
        else:
            order = F.col("node") if not turn else F.xxhash64(F.lit(turn), F.col("node"))
            # reduced map-side and stored: a band that many texts share meets its hub where its rows are, or in a join that can be split
            hub = stored(at.groupBy("band").agg(F.min(F.struct(order.alias("rank"), "node", "label")).alias("h"))
                         .select("band", F.col("h.node").alias("hub"), F.col("h.label").alias("hub_label")), "hubs")
            pairs = at.join(hub, "band").where("label <> hub_label").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
            links = links.unionAll(stored(_links(pairs.distinct(), texts, similarity), "similar"))
        labels = components(links)
    classed = signed.select("key", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = stored(classed.groupBy("label").agg(F.min("key").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "classes")
    return classed.join(least, "label").select(F.col("key").alias(key), "node", "label", "class_id", "class_size")


def _has_order(kind: T.DataType) -> bool:
    """Whether Spark can sort values of a type."""
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One document of each near-duplicate class, with its own columns: the one of smallest key (nulls last).

    Among rows of that key and class the smallest row stays, so of rows that are equal in all columns one stays. Columns whose type has
    no order (maps, variants) are compared as JSON text.
    """
    columns = docs.columns
    node = fresh(docs, "node")
    classed = near_classes(docs, key, text, similarity)
    first = (classed.groupBy("label").agg(F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "node")).alias("best"))
             .select(F.col("best.node").alias(node)))
    rest = [c for c in columns if c != key]
    ordered = {c: F.col(c) if _has_order(docs.schema[c].dataType) else F.to_json(F.struct(c)) for c in rest}
    rank = F.struct(F.col(key).isNull().alias("none"), F.col(key), *[o.alias(c) for c, o in ordered.items()])
    plain = all(_has_order(docs.schema[c].dataType) for c in rest)
    row = F.min(rank) if plain else F.min_by(F.struct(*columns), rank)
    best = docs.withColumn(node, F.xxhash64(F.coalesce(F.col(text), F.lit("")))).groupBy(node).agg(row.alias("row"))
    return best.join(first, node, "left_semi").select(*[F.col("row").getField(c).alias(c) for c in columns])
