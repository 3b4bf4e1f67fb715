"""Rule statistics of documents and an isolation forest over them, with a threshold set by labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import fresh, hash_sample, stored, with_labels

#: labelled rows that the trees are grown from at most; all labelled rows set the threshold
SAMPLE_ROWS = 20_000
TREES = 200
TREE_ROWS = 256
BINS = 4096
RATES = 8
#: share of good labelled rows that the threshold may reject at most
MOST_LOST = 0.02
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = b"#*$%&|<>"
_COUNTED = ",".join(f"{c}:bigint" for c in COUNTS)


def _repeated(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    ids = dict.fromkeys(words)
    if len(ids) == n:
        return 0
    for k, w in enumerate(ids):
        ids[w] = k
    a = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    _, where, times = np.unique((a[:-2] << 40) ^ (a[1:-1] << 20) ^ a[2:], return_inverse=True, return_counts=True) \
        if len(ids) < 1 << 20 else np.unique(np.stack([a[:-2], a[1:-1], a[2:]]), axis=1, return_inverse=True, return_counts=True)
    found = (times[where.ravel()] > 1).astype(np.int64)
    edge = np.zeros(n + 1, np.int64)
    edge[:n - 2] += found
    edge[3:n + 1] -= found
    return int((np.cumsum(edge[:n]) > 0).sum())


def statistics(text: str) -> tuple[tuple[int, ...], list[float]]:
    """The counts of ``COUNTS`` and the rates that the forest sees.

    Rates do not grow with the length of a text. Their order: characters a word, symbols a word, share of repeated lines,
    of words in repeated windows, of words equal to the one before, of capital letters (A-Z), of words that end in
    ``!`` or ``?``, and of words without a letter or digit. Figures, brackets and the like are left out: clean texts
    hold addresses and dates.
    """
    data = text.encode()
    words = data.split()  # exactly \x20 and \x09-\x0D
    n = len(words)
    if not n:
        return (0,) * 5, [0.0] * RATES
    joined = b"".join(words)
    chars = len(joined.decode())
    symbols = len(joined) - len(joined.translate(None, _SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeated = _repeated(words)
    same = sum(map(bytes.__eq__, words, words[1:]))
    upper = len(joined) - len(joined.translate(None, _UPPER))
    excited = text.count("!") + text.count("?")
    bare = sum(1 for w in words if not w.translate(None, _ASCII_MARKS))
    stats = [chars / n, symbols / n, dup / max(1, len(lines)), repeated / n, same / n, upper / chars, excited / n, bare / n]
    return (n, chars, symbols, dup, repeated), stats


_UPPER = bytes(range(65, 91))
_ASCII_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def rule_statistics(text: Column, forest: Forest | None = None) -> Column:
    """Struct of the counts and the rates (``stats``) of every whole text, or with a forest of the counts and ``anomaly``.

    A null text has no words.
    """
    @F.pandas_udf(f"struct<{_COUNTED},{'stats:array<float>' if forest is None else 'anomaly:double'}>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = [statistics(t) for t in s]
            out = pd.DataFrame([r[0] for r in rows], columns=list(COUNTS), dtype="int64")
            rates = np.array([r[1] for r in rows], np.float32).reshape(-1, RATES)
            if forest is None:
                out["stats"] = list(rates)
            else:
                out["anomaly"] = forest.scores(rates)
            yield out
    return measure(F.coalesce(text, F.lit("")))


def base_failed(s: str) -> Column:
    return F.expr(f"{s}.n_words < 50 OR 100 * {s}.n_repeat_words > 50 * {s}.n_words")


# --- isolation forest -----------------------------------------------------------------------------

def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays of nodes: the column to split on (-1: a leaf), the value, the children, the path length of a leaf."""
    column: np.ndarray
    value: np.ndarray
    child: np.ndarray
    length: np.ndarray
    depth: int
    scale: float

    def scores(self, x: np.ndarray, part: int = 4096) -> np.ndarray:
        """Anomaly scores between 0 and 1, higher for rows that random splits isolate sooner."""
        if len(x) > part:
            return np.concatenate([self.scores(x[k:k + part]) for k in range(0, len(x), part)])
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.column)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                column = self.column[t, at]
                right = x[rows, np.maximum(column, 0)] >= self.value[t, at]
                at = np.where(column >= 0, self.child[t, at] + right, at)
            total += self.length[t, at]
        return np.exp2(-total / (len(self.column) * self.scale))


def grow(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """An isolation forest over the rows of ``x``; a table without rows gives trees of one leaf."""
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(x))
    depth = max(1, int(np.ceil(np.log2(max(2, size)))))
    nodes = 2 ** (depth + 1)
    f = Forest(np.full((trees, nodes), -1, np.int32), np.zeros((trees, nodes), np.float32), np.zeros((trees, nodes), np.int32),
               np.zeros((trees, nodes), np.float32), depth, float(max(_mean_path(size), 1.0)))
    for t in range(trees):
        todo, used = [(0, x[rng.choice(len(x), size, replace=False)] if size else x, 0)], 1
        while todo:
            node, part, level = todo.pop()
            low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(x.shape[1]),) * 2
            open_columns = np.flatnonzero(high > low)
            if level == depth or not len(open_columns):
                f.length[t, node] = level + _mean_path(len(part))
                continue
            c = int(rng.choice(open_columns))
            v = np.float32(rng.uniform(low[c], high[c]))
            if v <= low[c]:
                v = np.float32(high[c])
            f.column[t, node], f.value[t, node], f.child[t, node] = c, v, used
            right = part[:, c] >= v
            todo += [(used, part[~right], level + 1), (used + 1, part[right], level + 1)]
            used += 2
    return f


def anomaly(stats: Column, forest: Forest) -> Column:
    """Anomaly score (double) of the rates in ``stats``."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            x = np.stack(s.tolist()).astype(np.float32) if len(s) else np.zeros((0, RATES), np.float32)
            yield pd.Series(forest.scores(x))
    return score(stats)


@dataclass
class Rules:
    forest: Forest
    #: a document with a higher anomaly score is rejected
    threshold: float


def _good_labels(labels: DataFrame, key: str) -> DataFrame:
    return (labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col(key).alias("label_key")).agg((F.min("quality") == 1).alias("good")))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS,
        most_lost: float = MOST_LOST) -> Rules:
    """Grows the forest on labelled documents and sets the threshold that separates bad from good ones best.

    Trees see at most ``sample_rows`` labelled rows, those with the smallest hashes of their key. The threshold is
    searched over counts per score of **all** labelled rows: the best sum of the shares of good rows kept and bad
    rows rejected, among thresholds that reject at most ``most_lost`` of the good ones. Without rows of both
    kinds nothing is rejected by the forest. A key labelled twice counts as good only if all labels say so.
    """
    # only the rates leave the scan of the texts
    texts = docs.select(F.col(key).alias("label_key"), F.col(text).alias("t"))
    measured = stored(with_labels(texts, _good_labels(labels, key), "label_key", lambda rows: rows.select(
        "label_key", rule_statistics(F.col("t"))["stats"].alias("stats"))), "rule-stats")
    sample = hash_sample(measured, "label_key", sample_rows).toPandas()
    x = np.stack(sample["stats"].tolist()).astype(np.float32) if len(sample) else np.zeros((0, RATES), np.float32)
    forest = grow(x)
    counts = (measured.select("good", F.floor(anomaly(F.col("stats"), forest) * BINS).cast("int").alias("bin"))
              .groupBy("bin").agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
              .orderBy(F.desc("bin")).toPandas())
    good, bad = counts["good"].cumsum().to_numpy(), counts["bad"].cumsum().to_numpy()  # rejected down to each bin
    if not len(counts) or not good[-1] or not bad[-1]:
        return Rules(forest, float("inf"))
    gain = bad / bad[-1] - good / good[-1]
    gain[good > most_lost * good[-1]] = -1
    best = int(gain.argmax())
    return Rules(forest, float(counts["bin"].iloc[best]) / BINS if gain[best] > 0 else float("inf"))


def judged(docs: DataFrame, rules: Rules, text: str = "text") -> DataFrame:
    """``docs`` with the counts of ``COUNTS``, base_failed, anomaly and kept.

    A document is kept if it passes the base rules and its anomaly score is below the threshold. Null and empty texts
    have no words and fail. Every row is judged by itself, so repeated rows, null keys and very long texts need
    nothing special; input columns named like results are replaced. An empty table gives an empty table.
    """
    results = {*COUNTS, "base_failed", "anomaly", "kept"}
    names = [c for c in docs.columns if c.lower() not in results]
    s = fresh(docs, "rule_stats")
    with_stats = docs.select(*names, rule_statistics(F.col(text), rules.forest).alias(s))
    scored = with_stats.select(*names, *[F.col(f"{s}.{c}") for c in COUNTS], base_failed(s).alias("base_failed"), F.col(f"{s}.anomaly"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(rules.threshold)))


def keep_good(docs: DataFrame, rules: Rules, text: str = "text") -> DataFrame:
    """The documents that ``judged`` keeps, with their own columns."""
    s = fresh(docs, "rule_stats")
    with_stats = docs.withColumn(s, rule_statistics(F.col(text), rules.forest))
    return with_stats.where(~base_failed(s) & (F.col(f"{s}.anomaly") < F.lit(rules.threshold))).drop(s)
