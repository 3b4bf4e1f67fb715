"""Quality scores from how well zstandard compresses a text with dictionaries of good and of bad texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import fresh, hash_sample, with_labels

#: labelled documents of each kind that a dictionary is built from at most, and the longest of them in bytes
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 16384
DICTIONARY_BYTES = 65536
#: texts are compressed in parts of so many bytes, else long texts would bring their own dictionary
PART_BYTES = 1024
LEVEL = 3
BINS = 64


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray


class Sizes:
    """Compressed sizes of texts with two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self.tools = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
                                               write_dict_id=False) if d else zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
                      for d in (good, bad)]

    def of(self, text: str) -> tuple[float, float]:
        """(difference, density): bytes that the dictionary of good texts saves against that of bad ones, as a share
        of both, and compressed bytes a byte. All parts of the text count; an empty text has (0, 1)."""
        data = text.encode()
        if not data:
            return 0.0, 1.0
        g, b = (sum([len(c.compress(data[k:k + PART_BYTES])) for k in range(0, len(data), PART_BYTES)]) for c in self.tools)
        return (b - g) / (b + g), min(2.0, (b + g) / 2 / len(data))


def compressed(text: Column, good: bytes, bad: bytes) -> Column:
    """Struct (difference, density) of every whole text; null counts as empty."""
    @F.pandas_udf("struct<difference:double,density:double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sizes = Sizes(good, bad)
        for s in batches:
            yield pd.DataFrame([sizes.of(t) for t in s], columns=["difference", "density"], dtype="float64")
    return measure(F.coalesce(text, F.lit("")))


def _terms(difference, density, least, most):
    """Inputs of the calibration: the difference, and how compressible a text is at all, which repetition raises.

    Both enter as straight pieces, so no value far out can outweigh the rest. ``least`` and ``most`` take two values.
    """
    d = least(most(difference, -0.4), 0.4) * 10
    c = least(density, 1.2) * 5
    hinges = [least(c, k) for k in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0)]
    return [1 + 0 * d, d, least(d, 0), least(d, -1), c, *hinges, d * least(c, 1.0), least(d, 0) * least(c, 2.0)]


def _dictionary(texts: list[str], size: int) -> bytes:
    import zstandard

    parts = [t.encode()[k:k + PART_BYTES] for t in texts for k in range(0, len(t.encode()), PART_BYTES)]
    if sum(map(len, parts)) < 8 * 1024 or len(parts) < 16:
        return b"\n".join(parts)[-size:]  # too little to select from: the text itself serves as the dictionary
    return zstandard.train_dictionary(min(size, sum(map(len, parts)) // 4), parts).as_bytes()


def _calibrate(x: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 100, ridge: float = 0.5) -> np.ndarray:
    """Logistic regression on weighted points by Newton steps, halved while they don't lower the loss."""
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6

    def loss(w):
        z = x @ w
        return float((n * (np.logaddexp(0, z) - y * z)).sum() + w @ penalty @ w / 2)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (n * (y - p)) - penalty @ w
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty, grad)
        while (new := loss(w + step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if now - new < 1e-9 * (1 + abs(now)):
            break
        w, now = w + step, new
    return w


def fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the key as text, modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string")) % folds


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Dictionaries from folds 1 and 2 of the labelled rows, the calibration from folds 3 and 4; fold 0 is held out.

    A dictionary is built from at most ``sample_rows`` documents of its kind of up to ``SAMPLE_BYTES`` bytes, those with
    the smallest hashes. The calibration uses all labelled rows of its folds, as counts per cell of the two
    measures. Rows without key or label do not take part; a key labelled twice is good only if all labels say so.
    With labels of one kind only, scores are that kind's rate.
    """
    good = (labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(key).alias("label_key"))
            .agg((F.min("quality") == 1).cast("int").alias("good")))
    known = docs.select(F.col(key).alias("label_key"), F.coalesce(F.col(text), F.lit("")).alias("t")).where(F.col(key).isNotNull())
    dictionaries = []
    for kind in (1, 0):
        keys = hash_sample(good.where((F.col("good") == kind) & fold(F.col("label_key")).isin(1, 2)), "label_key", sample_rows)
        rows = (known.where((F.octet_length("t") <= SAMPLE_BYTES) & (F.col("t") != "")).join(F.broadcast(keys), "label_key")
                .orderBy(F.xxhash64("label_key"), "label_key", "t").limit(sample_rows).select("t").collect())
        dictionaries.append(_dictionary([r.t for r in rows], DICTIONARY_BYTES))
    # only the two measures leave the scan of the texts
    measured = with_labels(known.where(fold(F.col("label_key")).isin(3, 4)), good, "label_key", lambda rows: rows.select(
        "label_key", compressed(F.col("t"), *dictionaries).alias("m")))
    cells = (measured
             .groupBy(F.round(F.col("m.difference") * BINS * 4).alias("difference"), F.round(F.col("m.density") * BINS * 4).alias("density"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")).orderBy("difference", "density").toPandas())
    x = np.stack(_terms(cells["difference"].to_numpy() / BINS / 4, cells["density"].to_numpy() / BINS / 4, np.minimum, np.maximum), axis=1)
    if not len(cells):
        return Model(*dictionaries, np.zeros(x.shape[1]))
    n, y = cells["n"].to_numpy(float), cells["good"].to_numpy(float) / cells["n"].to_numpy(float)
    return Model(*dictionaries, _calibrate(x, y, n))


def scored(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with score (0 to 1, higher for good texts) and predicted (1 from ``threshold`` on).

    Only the text is looked at, the whole of it. Null and empty texts get the score of the measures (0, 1). Rows are
    scored one by one, so repeated rows, null keys and empty tables need nothing special; input columns named score
    or predicted are replaced.
    """
    names = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    m = fresh(docs, "measures")
    measured = docs.select(*names, compressed(F.col(text), model.good, model.bad).alias(m))
    def bound(f):
        return lambda a, b: f(a, F.lit(float(b)))

    terms = _terms(F.col(f"{m}.difference"), F.col(f"{m}.density"), bound(F.least), bound(F.greatest))
    logit = sum((F.lit(float(w)) * t for w, t in zip(model.weights, terms)), F.lit(0.0))
    return (measured.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit))))).drop(m)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
