"""Exact sizes, gapless slots and the law of the communication matrix."""

import math

import numpy as np
from pyspark.sql import functions as F

from pairloom.llm import sharding
from pairloom.llm.common import uniform


def test_hypergeometric_law(spark):
    n, total, good, drawn = 40000, 60, 25, 20
    u = uniform(F.col("id"))
    got = (spark.range(n).select(sharding.hypergeometric(u, *[F.lit(x).cast("long") for x in (total, good, drawn)]).alias("k"))
           .groupBy("k").count().collect())
    seen = {r.k: r["count"] for r in got}
    want = {k: n * math.comb(good, k) * math.comb(total - good, drawn - k) / math.comb(total, drawn) for k in range(0, drawn + 1)}
    chi = sum((seen.get(k, 0) - w) ** 2 / w for k, w in want.items() if w > 5)
    assert sum(seen.values()) == n and chi < 40, chi  # about 12 degrees of freedom


def test_hypergeometric_borders_and_large_counts(spark):
    cases = [(0, 0, 0), (5, 0, 3), (5, 5, 3), (5, 2, 5), (5, 2, 0), (3_000_000_000, 187_500_000, 1_500_000_000)]
    df = spark.createDataFrame(cases, "total long, good long, drawn long").select("*", sharding.hypergeometric(
        F.lit(0.3), F.col("total"), F.col("good"), F.col("drawn")).alias("k"))
    for r in df.collect():
        assert max(0, r.drawn + r.good - r.total) <= r.k <= min(r.good, r.drawn)
        share = r.good / max(1, r.total)
        assert abs(r.k - r.drawn * share) <= 5 * math.sqrt(r.drawn * share * (1 - share)) + 1


def check(df, n, shards):
    rows = df.collect()
    assert len(rows) == n
    sizes = np.bincount([r.shard for r in rows], minlength=shards) if n else np.zeros(shards, int)
    assert sizes.max() - sizes.min() <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    return rows


def test_sizes_slots_and_repetition(spark):
    # a third of all rows are the same row, others have nulls, and columns clash
    df = (spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
                                   F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("shard"), F.lit(None).cast("string").alias("n")))
    got = check(sharding.shuffle_into_shards(df, 7, block_rows=200), 3000, 7)
    again = sharding.shuffle_into_shards(df.repartition(5), 7, block_rows=200).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.shard, r.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))
    nulls = np.bincount([r.shard for r in got if r.doc_id is None], minlength=7)
    assert nulls.sum() == 1000 and nulls.min() > 90
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot)) if r.doc_id is not None]
    assert abs(np.corrcoef(order, np.arange(len(order)))[0, 1]) < 0.1
    other = sharding.shuffle_into_shards(df, 7, seed=2, block_rows=200).collect()
    assert sorted(map(key, got)) != sorted(map(key, other))


def test_small_and_empty(spark):
    df = spark.range(5).toDF("doc_id")
    check(sharding.shuffle_into_shards(df, 16), 5, 16)
    check(sharding.shuffle_into_shards(df.limit(0), 16), 0, 16)
