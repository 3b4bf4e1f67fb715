"""Uniform shuffle of rows into shards of exact size by a hypergeometric communication matrix."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import stored, uniform

#: rows that one local permutation holds on average
BLOCK_ROWS = 65536


def _walk(steps: Column) -> Column:
    return F.when(steps > 0, F.sequence(F.lit(1).cast("long"), steps)).otherwise(F.array().cast("array<bigint>"))


def _weight(up: Column | bool, k: Column, total: Column, good: Column, drawn: Column) -> Column:
    """Probability of the next (or the previous) count of good ones relative to that of ``k``."""
    def ratio(x):  # p(x + 1) / p(x)
        return ((good - x).cast("double") * (drawn - x)) / ((x + 1).cast("double") * (total - good - drawn + x + 1))
    if isinstance(up, bool):
        return ratio(k) if up else 1 / ratio(k - 1)
    return F.when(up, ratio(k)).otherwise(1 / ratio(k - 1))


def hypergeometric(u: Column, total: Column, good: Column, drawn: Column) -> Column:
    """How many of ``drawn`` rows out of ``total``, ``good`` of them marked, are marked; ``u`` is uniform in [0, 1).

    Inversion outward from the mode. The walk ends 12 standard deviations away, where the rest of the
    distribution is below the resolution of ``u``.
    """
    low, high = F.greatest(F.lit(0).cast("long"), drawn + good - total), F.least(good, drawn)
    peak = F.least(high, F.greatest(low, F.floor((drawn + 1).cast("double") * (good + 1) / (total + 2))))
    share = good.cast("double") / F.greatest(total, F.lit(1).cast("long"))
    spread = F.ceil(12 * F.sqrt(F.greatest(F.lit(0.0), drawn * share * (1 - share))) + 16)
    above, below = F.least(high - peak, spread), F.least(peak - low, spread)

    def side(up: bool, steps: Column) -> Column:
        def step(s, i):
            at = peak + (i - 1) if up else peak - (i - 1)
            w = s["w"] * _weight(up, at, total, good, drawn)
            return F.struct(w.alias("w"), (s["sum"] + w).alias("sum"))
        return F.aggregate(_walk(steps), F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")), step)["sum"]

    def find(v: Column) -> Column:
        up = v["target"] <= v["above"]
        left = F.when(up, v["target"]).otherwise(v["target"] - v["above"])

        def step(s, i):
            at = F.when(up, peak + (i - 1)).otherwise(peak - (i - 1))
            w = s["w"] * _weight(up, at, total, good, drawn)
            passed = s["sum"] >= left
            return F.struct(F.when(passed, s["k"]).otherwise(i).alias("k"), w.alias("w"), (s["sum"] + w).alias("sum"))

        start = F.struct(F.lit(0).cast("long").alias("k"), F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        moved = F.aggregate(_walk(F.when(up, above).otherwise(below)), start, step)["k"]
        return F.when(v["target"] <= 0, peak).when(up, peak + moved).otherwise(peak - moved)

    sums = F.array(F.struct(side(True, above).alias("above"), side(False, below).alias("below")))
    aimed = F.transform(sums, lambda s: F.struct(s["above"].alias("above"),
                                                 (u * (1 + s["above"] + s["below"]) - 1).alias("target")))
    return F.transform(aimed, find)[0].cast("long")


def _split(seed: int, level: int) -> Column:
    """Rows per shard of the left half of a node: a multivariate hypergeometric draw of ``left`` rows."""
    def step(s, x):
        u = uniform(F.lit(seed), F.lit(level), F.col("node"), x["i"])
        got = hypergeometric(u, s["total"], x["n"], s["drawn"])
        return F.array(F.struct((s["total"] - x["n"]).alias("total"), (s["drawn"] - got).alias("drawn"),
                                F.concat(s["out"], F.array(got)).alias("out")))
    start = F.array(F.struct(F.col("rows").alias("total"), F.col("left").alias("drawn"),
                             F.array().cast("array<bigint>").alias("out")))
    counts = F.transform("counts", lambda n, i: F.struct(n.alias("n"), i.alias("i")))
    return F.aggregate(counts, start, lambda s, x: step(s[0], x))[0]["out"]


def communication_matrix(blocks: DataFrame, shards: int, bits: int, total: int, seed: int) -> DataFrame:
    """(block, counts): how many rows every block sends to every shard.

    ``blocks`` has (block, n) for blocks 0 .. 2**bits - 1. Shard sizes differ by one row at most. The matrix is
    split by halves of the blocks; each split is a multivariate hypergeometric draw, so the matrix has the law
    of a uniformly random permutation of all rows.
    """
    spark = blocks.sparkSession
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    nodes = spark.range(1).select(F.col("id").alias("node"), F.lit(total).cast("long").alias("rows"),
                                  F.array(*[F.lit(x).cast("long") for x in sizes]).alias("counts"))
    for level in range(bits):
        halves = (blocks.groupBy(F.shiftright("block", bits - level - 1).alias("half")).agg(F.sum("n").alias("left"))
                  .where(F.col("half") % 2 == 0).select(F.shiftright("half", 1).alias("node"), "left"))
        split = (nodes.join(halves, "node", "left").withColumn("left", F.coalesce("left", F.lit(0).cast("long")))
                 .withColumn("taken", _split(seed, level)))
        nodes = split.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("rows"), F.col("taken").alias("counts")),
            F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("rows") - F.col("left")).alias("rows"),
                     F.zip_with("counts", "taken", lambda a, b: a - b).alias("counts")))).alias("x")).select("x.*")
    return nodes.select(F.col("node").alias("block"), "counts")


def shuffle_into_shards(rows: DataFrame, shards: int = 16, seed: int = 1, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with their ``shard`` (0 ..) and ``slot`` (0 .. without gaps in each shard), a uniform shuffle.

    Every row gets a place by all its columns, so rows may hold nulls and may repeat: equal rows are counted and
    numbered first, and each of them is placed on its own. Shard sizes differ by one row at most. An empty
    input gives an empty result. Input columns called shard or slot are replaced.

    Rows are dealt to blocks by a hash, the matrix says how many of a block go to which shard, a local random order
    of the block says which, and a second random order of each shard gives the slots. That order is ranked in
    slices of a shard, so no task holds more than a slice.
    """
    rows = rows.drop("shard", "slot")
    names = rows.columns
    fields = [f"c{i}" for i in range(len(names))]
    plain = rows.toDF(*fields)
    told = (plain.groupBy(*fields).agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies"))
    every = stored(told.select(*fields, "copy", *[
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(k), *fields, "copy"), 1).alias(x)
        for k, x in enumerate(("deal", "local", "final"))]), "shard-rows")
    total = every.count()
    bits = max(3, math.ceil(math.log2(max(1, total / block_rows))))
    every = every.withColumn("block", F.shiftright("deal", 63 - bits))
    blocks = stored(every.groupBy("block").agg(F.count(F.lit(1)).alias("n")), "shard-blocks")
    matrix = (communication_matrix(blocks, shards, bits, total, seed)
              .select("block", F.transform("counts", lambda _, i: F.aggregate(
                  F.slice("counts", 1, i + 1), F.lit(0).cast("long"), lambda a, x: a + x)).alias("upto")))
    rank = F.row_number().over(Window.partitionBy("block").orderBy("local", *fields, "copy"))
    slices = max(0, math.ceil(math.log2(max(1, total / shards / block_rows))))
    cut = F.shiftright("final", 63 - slices)
    placed = stored(
        every.withColumn("rank", rank).join(matrix, "block")
        .select(*fields, "copy", "final", cut.alias("cut"),
                F.size(F.filter("upto", lambda x: x < F.col("rank"))).alias("shard")), "shard-placed")
    before = (placed.groupBy("shard", "cut").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("first", F.sum("n").over(Window.partitionBy("shard").orderBy("cut")) - F.col("n")))
    slot = F.row_number().over(Window.partitionBy("shard", "cut").orderBy("final", *fields, "copy")) - 1
    done = placed.withColumn("at", slot).join(before.select("shard", "cut", "first"), ["shard", "cut"])
    return done.select(*[F.col(f).alias(n) for f, n in zip(fields, names)], "shard",
                       (F.col("at") + F.col("first")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 1) -> None:
    """Writes ``docs`` as Parquet in shuffled order, one folder per shard; files hold consecutive slots."""
    placed = shuffle_into_shards(docs, shards, seed)
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
