"""Language of texts by a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

The bytes of a text go through the network in windows of ``WINDOW`` bytes, which all start from a zero state in both directions, in
training as in use. Every position of every window gets a probability per language from the two states that meet there; the
score of a text is the mean over all its positions. In training arrays hold units in rows and windows in columns, in use the other way
round and a gate at a time, so that each gate is one stretch of memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import pieces, uniform

WINDOW = 64
UNITS = 16
#: documents that training looks at at most, dealt evenly over the languages, and windows of each
SAMPLE_DOCS, SAMPLE_WINDOWS = 6000, 4
STEPS, BATCH, RATE = 400, 256, 0.01
#: more values of the language column than this are no languages
MOST_LANGUAGES = 500
#: windows that a worker turns at a time, and bytes of texts that it cuts into windows
BLOCK, SLICE_BYTES = 4096, 8 << 20
#: steps at the beginning of windows that those with equal bytes share (at most four)
OPENING = 4
UNKNOWN = "und"


@dataclass
class Opening:
    """States after the first steps of windows: for each step a row per distinct opening, and the opening of each window."""

    states: list[np.ndarray]
    which: np.ndarray

    def part(self, of: slice) -> Opening:
        return Opening(self.states, self.which[of])


@dataclass
class Direction:
    """A gated recurrent layer: one column of ``inputs`` per byte value, rows for update, reset and candidate."""

    inputs: np.ndarray
    recurrent: np.ndarray
    out: np.ndarray

    @staticmethod
    def drawn(rng: np.random.Generator, units: int, classes: int) -> Direction:
        return Direction(rng.normal(0, 0.3, (3 * units, 256)).astype(np.float32),
                         rng.normal(0, 0.7 / np.sqrt(units), (3 * units, units)).astype(np.float32),
                         rng.normal(0, 0.1, (classes, units)).astype(np.float32))

    def states(self, x: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each of the steps of ``x`` (steps, windows), and what the way back needs."""
        h = self.recurrent.shape[1]
        state, out, memory = np.zeros((h, x.shape[1]), self.inputs.dtype), [], []
        for t in range(len(x)):
            a, g = self.inputs[:, x[t]], self.recurrent @ state
            zr = 1 / (1 + np.exp(-(a[:2 * h] + g[:2 * h])))
            z, r = zr[:h], zr[h:]
            c = np.tanh(a[2 * h:] + r * g[2 * h:])
            memory.append((state, z, r, c, g[2 * h:]))
            state = (c + z * (state - c)) * valid[t]
            out.append(state)
        return np.stack(out), memory

    def gradients(self, x: np.ndarray, valid: np.ndarray, memory: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``inputs`` and ``recurrent`` by going back through time."""
        h = self.recurrent.shape[1]
        d_recurrent, d_later = np.zeros_like(self.recurrent), np.zeros_like(memory[0][0])
        d_inputs = np.empty((3 * h, x.size), self.inputs.dtype)
        n = x.shape[1]
        for t in range(len(x) - 1, -1, -1):
            state, z, r, c, g = memory[t]
            d = (d_states[t] + d_later) * valid[t]
            d_c = d * (1 - z) * (1 - c * c)
            d_z = d * (state - c) * z * (1 - z)
            d_r = d_c * g * r * (1 - r)
            d_inputs[:, t * n:(t + 1) * n] = np.concatenate([d_z, d_r, d_c])
            d_gates = np.concatenate([d_z, d_r, d_c * r])
            d_recurrent += d_gates @ state.T
            d_later = d * z + self.recurrent.T @ d_gates
        order = np.argsort(x.ravel(), kind="stable")
        values, first = np.unique(x.ravel()[order], return_index=True)
        by_byte = np.zeros_like(self.inputs)
        by_byte[:, values] = np.add.reduceat(d_inputs[:, order], first, axis=1)
        return by_byte, d_recurrent

    def by_gate(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Weights for states in rows, of update, reset and candidate: rows of the byte values, and matrices behind the states.

        The first two are halved, so that a gate is 0.5 * (tanh + 1). The candidate's matrix is halved for the reset, which is then tanh + 1;
        halving is exact.
        """
        h = self.recurrent.shape[1]
        half, one = self.inputs.dtype.type(0.5), self.inputs.dtype.type(1)
        parts = [slice(k * h, k * h + h) for k in range(3)]
        return ([np.ascontiguousarray(self.inputs[rows].T * scale) for rows, scale in zip(parts, (half, half, one))],
                [np.ascontiguousarray(self.recurrent[rows].T * half) for rows in parts])

    def opening(self, x: np.ndarray) -> Opening:
        """The steps from a zero state over ``x`` (``OPENING``, windows), each computed once for windows that have been equal so far."""
        half, one = self.inputs.dtype.type(0.5), self.inputs.dtype.type(1)
        (update, reset, candidate), (by_z, by_r, by_c) = self.by_gate()
        key = np.zeros(x.shape[1], np.uint32)
        for row in x:
            key = key << np.uint32(8) | row
        coded = pa.array(key).dictionary_encode()
        found = coded.dictionary.to_numpy()
        order = np.argsort(found)
        values, which = found[order], np.argsort(order)[coded.indices.to_numpy()]
        states = [np.zeros((len(values), len(by_z)), self.inputs.dtype)]
        for k in range(OPENING - 1, -1, -1):
            begun = values >> np.uint32(8 * k)
            first = np.ones(len(begun), bool)
            first[1:] = begun[1:] != begun[:-1]
            at, state = (begun[first] & np.uint32(255)).astype(np.intp), states[-1][first]
            z, r = np.tanh(update[at] + state @ by_z) + one, np.tanh(reset[at] + state @ by_r) + one
            c = np.tanh(state @ by_c * r + candidate[at])
            states.append(((state - c) * z * half + c)[np.cumsum(first) - 1])
        return Opening(states[1:], which)


@dataclass
class Network:
    languages: list[str]
    ahead: Direction
    back: Direction
    bias: np.ndarray

    @staticmethod
    def drawn(languages: list[str], units: int = UNITS, seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        return Network(languages, *(Direction.drawn(rng, units, len(languages)) for _ in range(2)), np.zeros(len(languages), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.inputs, self.ahead.recurrent, self.ahead.out, self.back.inputs, self.back.recurrent, self.back.out, self.bias]

    def loss(self, x: np.ndarray, valid: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions of windows ``x`` (positions, windows) of languages ``y``, and its gradients."""
        f, f_memory = self.ahead.states(x, valid)
        b, b_memory = self.back.states(x[::-1], valid[::-1])
        b = b[::-1]
        logits = self.ahead.out @ f + self.back.out @ b + self.bias[:, None]
        logits -= logits.max(1, keepdims=True)
        p = np.exp(logits)
        total = p.sum(1, keepdims=True)
        columns = np.arange(x.shape[1])
        n = max(1, int(valid.sum()))
        loss = float(((np.log(total[:, 0]) - logits[:, y, columns]) * valid).sum() / n)
        d = p / total
        d[:, y, columns] -= 1
        d *= (valid / n)[:, None, :]
        out = []
        for layer, states, memory, xs, vs, ds in ((self.ahead, f, f_memory, x, valid, d), (self.back, b, b_memory, x[::-1], valid[::-1], d)):
            d_states = layer.out.T @ ds
            out += [*layer.gradients(xs, vs, memory, d_states if layer is self.ahead else d_states[::-1]),
                    np.einsum("tcn,thn->ch", ds, states, optimize=True)]
        return loss, [*out, d.sum((0, 2))]

    def train(self, x: np.ndarray, valid: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE,
              seed: int = 4) -> None:
        """Adam on batches that hold all languages alike."""
        rng = np.random.default_rng(seed)
        of = [np.flatnonzero(y == c) for c in range(len(self.languages))]
        of = [rows for rows in of if len(rows)]
        mean, square = ([np.zeros_like(w) for w in self.weights()] for _ in range(2))
        for step in range(1, steps + 1):
            rows = np.concatenate([rng.choice(part, -(-batch // len(of))) for part in of])
            _, gradients = self.loss(x[:, rows], valid[:, rows], y[rows])
            norm = np.sqrt(sum(float((g * g).sum()) for g in gradients))
            now = rate * min(1.0, 2 - 2 * step / (steps + 1))
            for w, g, m, s in zip(self.weights(), gradients, mean, square):
                g = g * min(1.0, 1 / (norm + 1e-9))
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= (now / (1 - 0.9 ** step)) * m / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)

    def openings(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[Opening, Opening]:
        """The first steps of windows of ``data`` ahead, from their first bytes, and back, from their last."""
        at = np.arange(OPENING)[:, None]
        return (self.ahead.opening(data[np.minimum(start + at, len(data) - 1)]),
                self.back.opening(data[np.maximum(start + length - 1 - at, 0)]))

    def probabilities(self, x: np.ndarray, valid: np.ndarray, openings: tuple[Opening, Opening] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(position, probabilities (languages, windows)) from the last position of the windows to the first; zeros behind a window's end.

        Windows that come longest first are turned where they stand, so that those that reach a position are one stretch; others are brought
        into that order. ``openings`` are those of the windows, shared by more of them than are given here.
        """
        length = valid.sum(0).astype(np.intp)
        if (length[1:] > length[:-1]).any():
            order = np.argsort(-length, kind="stable")
            back_to = np.argsort(order)
            for t, p in self.probabilities(x[:, order], valid[:, order]):
                yield t, p[:, back_to]
            return
        n, last = x.shape[1], len(x)
        if openings is None:
            openings = self.openings(x.ravel(order="F"), last * np.arange(n), length)
        # windows longer than t, for t up to that of the last position and OPENING more
        reach = n - np.searchsorted(length[::-1], np.arange(last + OPENING + 1), side="right")
        half, one = self.bias.dtype.type(0.5), self.bias.dtype.type(1)
        units = self.ahead.recurrent.shape[1]
        # a gate's units of one window stand side by side: a byte's weights are then one copy, and each gate one stretch of memory
        room = [np.empty((2, n, units), np.float32) for _ in range(2)]
        lines = [np.empty((n, units), np.float32) for _ in range(3)]

        def step(inputs, recurrent, t, m):
            """The step of the first ``m`` windows at position ``t``."""
            at = x[t, :m].astype(np.intp)
            gates, more = (a[:, :m] for a in room)
            c, own, state = (a[:m] for a in lines)
            z, r = gates
            for table, matrix, out, product in zip(inputs, recurrent, (z, r, own), (*more, c)):
                np.take(table, at, axis=0, out=out, mode="clip")
                np.matmul(state, matrix, out=product)
            np.add(gates, more, out=gates)
            np.tanh(gates, out=gates)
            np.add(gates, one, out=gates)
            np.multiply(c, r, out=c)
            np.add(c, own, out=c)
            np.tanh(c, out=c)
            np.subtract(state, c, out=state)
            np.multiply(state, z, out=state)
            np.multiply(state, half, out=state)
            np.add(state, c, out=state)

        state = lines[2]
        bias = self.bias[:, None]
        logits = np.empty((last, len(self.bias), n), np.float32)
        other, line = np.empty((len(self.bias), n), np.float32), np.empty(n, np.float32)
        begin = openings[0]
        inputs, recurrent = self.ahead.by_gate()
        for t in range(last):
            m = reach[t]
            if t < OPENING:
                np.take(begin.states[t], begin.which[:m], axis=0, out=state[:m], mode="clip")
            else:
                step(inputs, recurrent, t, m)
            p = logits[t, :, :m]
            np.matmul(self.ahead.out, state[:m].T, out=p)
            p += bias
        begin = openings[1]
        inputs, recurrent = self.back.by_gate()
        for t in range(last - 1, -1, -1):
            m = reach[t]
            if reach[t + OPENING]:
                step(inputs, recurrent, t, reach[t + OPENING])
            for k in range(OPENING):  # windows whose last byte is k bytes on
                lo, hi = reach[t + k + 1], reach[t + k]
                if lo < hi:
                    np.take(begin.states[k], begin.which[lo:hi], axis=0, out=state[lo:hi], mode="clip")
            p, low = logits[t, :, :m], line[:m]
            p += np.matmul(self.back.out, state[:m].T, out=other[:, :m])
            p -= np.max(p, axis=0, out=low)
            np.exp(p, out=p)
            p /= np.sum(p, axis=0, out=low)
            logits[t, :, m:] = 0
            yield t, logits[t]


def windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, and start, length and text of each window; a null text has none."""
    texts = pa.concat_arrays([pc.fill_null(texts, "").cast(pa.large_string())])
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    count = -(-np.diff(bounds) // WINDOW)
    of = np.repeat(np.arange(len(texts)), count)
    start = bounds[of] + WINDOW * (np.arange(len(of)) - (np.cumsum(count) - count)[of])
    return data, start, np.minimum(WINDOW, bounds[of + 1] - start), of


def blocks(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """The windows in blocks: (which, bytes (positions, windows), whether a position lies in the text)."""
    at = np.arange(WINDOW)[:, None]
    every = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(WINDOW, np.uint8)]), WINDOW)
    for lo in range(0, len(start), BLOCK):
        which = slice(lo, min(lo + BLOCK, len(start)))
        yield which, np.ascontiguousarray(every[start[which]].T), (at < length[which]).astype(np.float32)


def pooled(network: Network, texts: pa.Array) -> np.ndarray:
    """Mean probabilities (texts, languages) over all positions of each text; zeros for a text without bytes."""
    data, start, length, of = windows(texts)
    order = np.argsort(-length, kind="stable")
    start, length, of = start[order], length[order], of[order]
    total = np.zeros((len(texts), len(network.bias)))
    ahead, back = network.openings(data, start, length)
    for which, x, valid in blocks(data, start, length):
        held = np.zeros((len(network.bias), x.shape[1]), np.float32)
        for _, p in network.probabilities(x, valid, (ahead.part(which), back.part(which))):
            held += p
        np.add.at(total, of[which], held.T)
    return total / np.maximum(1, np.bincount(of, weights=length, minlength=len(texts)))[:, None]


def position_labels(network: Network, text: str) -> np.ndarray:
    """The index of the likeliest language at each byte of ``text``."""
    data, start, length, _ = windows(pa.array([text], pa.large_string()))
    out = np.empty(len(data), np.int32)
    for which, x, valid in blocks(data, start, length):
        for t, p in network.probabilities(x, valid):
            inside = valid[t] > 0
            out[start[which][inside] + t] = p.argmax(0)[inside]
    return out


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", sample_docs: int = SAMPLE_DOCS, steps: int = STEPS) -> Network | None:
    """A network trained on windows of at most ``sample_docs`` distinct texts, as many of each language; None without any.

    ``docs`` are the rows to learn from; those without text or language do not take part. Which texts and which ``SAMPLE_WINDOWS`` windows of
    each are taken follows from the hash of the text, so copies count once and a recomputed task takes the same. More than
    ``MOST_LANGUAGES`` values of ``lang`` raise a ValueError.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("t")).where("lang IS NOT NULL AND t <> ''")
    counts = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("t")).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{lang} has more than {MOST_LANGUAGES} values")
    if not counts:
        return None
    languages = sorted(r.lang for r in counts)
    each = max(1, sample_docs // len(languages))
    share = F.create_map(*[F.lit(v) for r in counts for v in (r.lang, min(1.0, each / max(1, r.n)))])
    taken = rows.where(uniform(F.lit(12), F.col("t")) < F.element_at(share, F.col("lang")))
    n_windows = F.ceil(F.octet_length("t") / F.lit(WINDOW))
    data = F.col("t").cast("binary")
    cuts = [F.substring(data, (F.pmod(F.xxhash64(F.lit(k), F.col("t")), n_windows) * WINDOW + 1).cast("int"), F.lit(WINDOW))
            for k in range(SAMPLE_WINDOWS)]
    sample = (taken.select("lang", F.xxhash64("t").alias("h"), F.array(*cuts).alias("cuts")).groupBy("lang", "h").agg(F.first("cuts").alias("cuts"))
              .orderBy("h", "lang").limit(sample_docs).collect())
    parts = [(languages.index(r.lang), bytes(c)) for r in sample for c in r.cuts]
    x = np.zeros((WINDOW, len(parts)), np.uint8)
    valid = np.zeros((WINDOW, len(parts)), np.float32)
    for k, (_, c) in enumerate(parts):
        x[:len(c), k] = np.frombuffer(c, np.uint8)
        valid[:len(c), k] = 1
    network = Network.drawn(languages)
    network.train(x, valid, np.array([c for c, _ in parts], np.int64), steps)
    return network


def with_language(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score: the likeliest language over all positions of the whole text and its mean probability.

    A null text or one without a letter is ``und`` with score 0, as is every text if there is no network; equal probabilities go to the
    first language in alphabetical order. Rows are judged by their text alone and one by one, so repeated rows, null
    keys and empty tables need nothing special; very long texts are whole; input columns named like results are replaced.
    """
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    judged = F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}")
    if network is None:
        return docs.select(*names, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    found = _pooled_column(F.when(judged, F.col(text)), network)
    # the struct is computed once: generators keep Spark from writing the function out for each field
    return docs.select(*names, F.inline(F.array(found)))


def _pooled_column(text: Column, network: Network) -> Column:
    from pyspark.sql.pandas.functions import arrow_udf

    names = pa.array(network.languages)

    @arrow_udf("struct<lang_pred:string,score:double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [pa.array([], pa.struct([("lang_pred", pa.string()), ("score", pa.float64())]))]
            for lo, hi in pieces(batch, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                p = pooled(network, part)
                known = pc.is_valid(part)
                best = pa.array(p.argmax(1))
                out.append(pa.StructArray.from_arrays(
                    [pc.if_else(known, names.take(best), UNKNOWN), pc.if_else(known, pa.array(p.max(1)), 0.0)], ["lang_pred", "score"]))
            yield pa.concat_arrays(out)
    return judge(text)


def language_spans(docs: DataFrame, network: Network, text: str = "text", name: str = "spans") -> DataFrame:
    """``docs`` with ``spans``, the runs of bytes of one language: an array of (start, end, lang) that covers the whole text.

    Null and empty texts have none.
    """
    from pyspark.sql.pandas.functions import arrow_udf

    languages = network.languages

    @arrow_udf("array<struct<start:bigint,end:bigint,lang:string>>")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            out = []
            for t in batch.to_pylist():
                at = position_labels(network, t or "")
                cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)] if len(at) else [0]
                out.append([{"start": a, "end": b, "lang": languages[at[a]]} for a, b in zip(cuts[:-1], cuts[1:])])
            yield pa.array(out, kind)
    return docs.withColumn(name, label(F.col(text)))
