"""Rule counts next to plain loops, the forest, and both classifiers on labelled documents."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from pairloom.llm import compression_classifier as C
from pairloom.llm import quality_rules as Q

SF = "/root/testdata/sf0.01"
ODD = [None, "", " \n\t ", "one", "a b a b a b", "x y z", "x x x x", "a\nb\na\n\n a \nb", "#$ *% &| <> é ü", "w " * 60, "ß" * 3000,
       " ".join(f"w{i}" for i in range(70)), " ".join(f"w{i % 40}" for i in range(80)), "\x0bq\x0cr\x1cs"]


def plain(text):
    words, now = [], ""
    for ch in text or "":
        if ch == " " or "\t" <= ch <= "\r":
            words += [now] if now else []
            now = ""
        else:
            now += ch
    words += [now] if now else []
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(sum(c in "#*$%&|<>" for c in w) for w in words), dup, len(covered))


def test_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 6000").select("doc_id", "text")
    odd = spark.createDataFrame([(None, t) for t in ODD], "doc_id long, text string")
    for r in docs.unionAll(odd).withColumn("s", Q.rule_statistics(F.col("text"))).select("text", "s.*", Q.base_failed("s").alias("bad")).collect():
        want = plain(r.text)
        assert tuple(r[c] for c in Q.COUNTS) == want, r.text
        assert r.bad == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_many_distinct_words():
    words = [f"w{i}" for i in range(1 << 20)]
    assert Q._repeated([w.encode() for w in [*words, *words[:5]]]) == 10


def test_forest_isolates_outliers():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(2000, 4)), rng.normal(size=(20, 4)) + 9]).astype(np.float32)
    forest = Q.grow(x, trees=100)
    s = forest.scores(x)
    assert s[2000:].min() > np.quantile(s[:2000], 0.98) and 0 < s.min() < s.max() < 1
    t, rows = 3, x[:50]
    for r in rows[:10]:  # one path by hand
        node = 0
        while forest.column[t, node] >= 0:
            node = forest.child[t, node] + int(r[forest.column[t, node]] >= forest.value[t, node])
        one = Q.Forest(forest.column[t:t + 1], forest.value[t:t + 1], forest.child[t:t + 1], forest.length[t:t + 1], forest.depth, forest.scale)
        assert np.isclose(one.scores(r[None])[0], 2 ** (-forest.length[t, node] / forest.scale))
    same = Q.grow(np.ones((5, 3), np.float32))
    assert np.isfinite(same.scores(np.ones((2, 3), np.float32))).all()
    assert np.isfinite(Q.grow(np.zeros((0, 3), np.float32)).scores(np.ones((2, 3), np.float32))).all()


def test_rules_on_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rules = Q.fit(docs, labels)
    rows = Q.judged(docs.withColumn("kept", F.lit("clash")), rules).join(labels, "doc_id").collect()
    bad = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert all(r.kept == (not r.base_failed and r.anomaly < rules.threshold) for r in rows)
    kept = Q.keep_good(docs, rules)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {r.doc_id for r in rows if r.kept}
    again = Q.fit(docs.repartition(7), labels)
    assert again.threshold == rules.threshold and (again.forest.value == rules.forest.value).all()


def test_rules_without_labels(spark):
    docs = spark.createDataFrame([(1, "w " * 60), (None, " ".join(f"w{i}" for i in range(60))), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    rules = Q.fit(docs, none)
    assert {r.doc_id: r.kept for r in Q.judged(docs, rules).collect()} == {1: False, None: True, 2: False}
    assert Q.judged(docs.limit(0), rules).count() == 0


def test_compression_scores_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = C.fit(docs, labels)
    rows = C.scored(docs.withColumn("score", F.lit("clash")), model).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93
    # what the held-out rows are labelled changes nothing
    flipped = labels.withColumn("quality", F.when(C.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = C.fit(docs.repartition(5), flipped)
    assert other.good == model.good and other.bad == model.bad and np.allclose(other.weights, model.weights)


def test_compression_odd_rows(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(14)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = C.fit(docs, labels)
    got = C.scored(docs, model).collect()
    assert len(got) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in got)
    empty = C.fit(docs.limit(0), labels)
    assert {round(r.score, 3) for r in C.scored(docs, empty).collect()} == {0.5}
    assert C.scored(docs.limit(0), model).count() == 0


def test_measures_by_hand():
    import zstandard
    sizes = C.Sizes(b"", b"hello hello world")
    text = "hello world " * 300
    parts = [text.encode()[k:k + C.PART_BYTES] for k in range(0, len(text), C.PART_BYTES)]
    with_bad = zstandard.ZstdCompressor(level=C.LEVEL, dict_data=zstandard.ZstdCompressionDict(b"hello hello world"), write_content_size=False,
                                        write_dict_id=False)
    without = zstandard.ZstdCompressor(level=C.LEVEL, write_content_size=False)
    g, b = (sum(len(z.compress(p)) for p in parts) for z in (without, with_bad))
    assert sizes.of(text) == ((b - g) / (b + g), (b + g) / 2 / len(text))
    assert sizes.of("") == (0.0, 1.0)
