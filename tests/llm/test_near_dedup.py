"""ProbMinHash against exact similarities; classes against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import near_dedup
from pairloom.llm.common import word_hashes


def shingle_set(text, k=5):
    w = (text or "").encode().split()
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if len(w) >= k else {tuple(w)}


def similar(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def brute_classes(texts):
    """Smallest member of each text's class, by comparing all pairs."""
    sets = [shingle_set(t) for t in texts]
    at = list(range(len(texts)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    seen = {}
    for i, t in enumerate(texts):
        j = seen.setdefault(t or "", i)
        at[max(root(i), root(j))] = min(root(i), root(j))
    index = {}
    for i, s in enumerate(sets):
        for j in {j for x in s for j in index.get(x, ())}:
            if similar(sets[i], sets[j]) >= 0.8:
                a, b = root(i), root(j)
                at[max(a, b)] = min(a, b)
        for x in s:
            index.setdefault(x, []).append(i)
    return [root(i) for i in range(len(texts))]


def check(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    df = spark.createDataFrame(list(zip(ids, texts, ["clash"] * len(ids))), "doc_id long, text string, node string")
    got = near_dedup.near_classes(df).collect()
    assert len(got) == len(texts)
    want = brute_classes(texts)
    found = {r.doc_id: r.class_id for r in got}
    assert found == {i: ids[w] for i, w in zip(ids, want)}
    kept = near_dedup.keep_one(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted({ids[w] for w in want})
    assert kept[0].asDict().keys() == {"doc_id", "text", "node"} and {r.node for r in kept} == {"clash"}


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_planted_copies_chains_and_groups(spark):
    rng = random.Random(3)
    texts = [" ".join(words(rng, rng.randrange(1, 300))) for _ in range(60)]
    base = words(rng, 200)
    for _ in range(60):  # a large group of near copies of one text, not all of them similar to each other
        copy = list(base)
        for _ in range(rng.randrange(1, 8)):
            copy[rng.randrange(200)] = "x"
        texts.append(" ".join(copy))
    chain = words(rng, 150)
    for step in range(12):  # a chain: neighbours are similar, ends are not
        chain = chain[10:] + words(rng, 10)
        texts.append(" ".join(chain))
    texts += [texts[0]] * 5 + ["", "  \n", "", None, "one", "one", "two words", "ß " * 40, "ß " * 41]
    texts.append(" ".join(words(rng, 30000)))
    check(spark, texts)


def test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    check(spark, [r.text for r in rows], [r.doc_id for r in rows])


def test_null_keys_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (5, "a b c d e f g"), (5, "a b c d e f g"), (None, "other text here"), (7, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.class_id is None, r.class_id or 0, r.class_size) for r in near_dedup.near_classes(df).collect())
    assert got == [(False, 5, 4)] * 4 + [(False, 7, 2)] * 2 + [(True, 0, 1)]
    kept = near_dedup.keep_one(df).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in kept), key=str) == [(False, 5, "a b c d e f g"), (False, 7, None), (True, 0, "other text here")]
    assert near_dedup.near_classes(df.limit(0)).count() == 0 and near_dedup.keep_one(df.limit(0)).count() == 0


def test_only_hub_rounds_differ_in_cost(spark, monkeypatch):
    rng = random.Random(8)
    base = words(rng, 120)
    texts = []
    for _ in range(80):
        copy = list(base)
        for _ in range(4):
            copy[rng.randrange(120)] = f"y{rng.randrange(9)}"
        texts.append(" ".join(copy))
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    for rounds in (0, 1):
        monkeypatch.setattr(near_dedup, "HUB_ROUNDS", rounds)
        check(spark, texts + [" ".join(words(rng, 300)), "a b c"])


@pytest.mark.parametrize("weighted", [False, True])
def test_registers_agree_with_probability_jaccard(weighted):
    rng = np.random.default_rng(1)
    a, b = np.arange(0, 120), np.arange(40, 160)
    weight = rng.integers(1, 6, 160).astype(float) if weighted else np.ones(160)
    other = rng.permutation(weight) if weighted else weight
    names = near_dedup.mix(np.arange(160, dtype=np.uint64) + np.uint64(99))
    sig = [near_dedup.prob_min_hash(names[x], w[x], np.zeros(len(x), np.int64), 1, 8192)[0] for x, w in ((a, weight), (b, other))]
    wa, wb = np.zeros(160), np.zeros(160)
    wa[a], wb[b] = weight[a], other[b]
    both = np.flatnonzero((wa > 0) & (wb > 0))
    want = sum(1 / np.maximum(wa / wa[i], wb / wb[i]).sum() for i in both)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.02


def test_early_end_changes_nothing():
    """Registers are the first arrivals, also when all arrivals up to a late time are drawn."""
    names = near_dedup.mix(np.arange(30, dtype=np.uint64))
    weight = np.arange(1, 31) / 10
    got = near_dedup.prob_min_hash(names, weight, np.zeros(30, np.int64), 1, 16)[0]
    best = [(np.inf, 0)] * 16
    for e, w in zip(names, weight):
        t, step = 0.0, 0
        for _ in range(400):
            step = (step + 0x9E3779B97F4A7C15) % 2**64
            draw = near_dedup.mix(np.array([e]) + np.uint64(step))
            t += -np.log1p(-float(draw[0] >> np.uint64(11)) * 2.0**-53) / w
            k = int(near_dedup.mix(draw)[0] >> np.uint64(33)) % 16
            best[k] = min(best[k], (t, int(e)))
    assert [int(x) for x in got] == [b[1] for b in best]


def test_word_hashes_follow_words():
    texts = ["a b  a\tb", "", None, "  x ", "ab a b", "naïve ab"]
    h, first, start, end, data = word_hashes(pa.array(texts))
    said = [data[s:e].tobytes() for s, e in zip(start, end)]
    assert said == [w for t in texts for w in (t or "").encode().split()]
    assert list(first) == [0, 4, 4, 4, 5, 8, 10]
    assert len(set(said)) == len(set(h.tolist())) == len(set(zip(said, h.tolist())))
    sliced = word_hashes(pa.array(["zzz", *texts]).slice(1))[0]
    assert (sliced == h).all()
    low = word_hashes(pa.array(["Ab, “cd” É-x", "ab cd é x"]), letters=True)[0]
    assert (low[:4] == low[4:]).all()


def test_similarity_is_exact(spark):
    rows = [("a b c d e f", "a b c d e f g"), ("a b", "a b"), ("", "a"), ("a a a a a a", "a a a a a"), ("x " * 30, "x " * 30 + "y")]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("j", near_dedup.jaccard(F.col("a"), F.col("b")))
    for r in df.collect():
        assert abs(r.j - similar(shingle_set(r.a), shingle_set(r.b))) < 1e-12


def test_columns_without_an_order(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text, {"a": 2}, [{"x": 1}]), (1, text, {"a": 1}, None), (2, text + " more", None, None), (3, "other words entirely", {}, [])]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string, extra map<string,int>, nested array<map<string,int>>")
    kept = sorted(near_dedup.keep_one(df).collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r.extra) for r in kept] == [(1, {"a": 1}), (3, {})] and kept[0].asDict().keys() == set(df.columns)
