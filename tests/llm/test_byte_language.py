"""Gradients next to differences, scores next to a network written with plain loops, accuracy on held-out rows."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import byte_language as B
from pairloom.llm.queries import QUERIES
from test_tokens import ODD


def network(languages=("aa", "bb", "cc"), units=4, seed=1):
    return B.Network.drawn(list(languages), units, seed)


def sigmoid(v):
    return 1 / (1 + math.exp(-v))


def by_hand(net, text):
    """Mean probabilities over all bytes of a text and the probabilities of each byte, one unit at a time."""
    data, rows = text.encode(), []
    for lo in range(0, len(data), B.WINDOW):
        part = data[lo:lo + B.WINDOW]
        sides = []
        for layer, seq in ((net.ahead, part), (net.back, part[::-1])):
            n = layer.recurrent.shape[1]
            h, states = [0.0] * n, []
            for byte in seq:
                g = [sum(float(layer.recurrent[k, u]) * h[u] for u in range(n)) for k in range(3 * n)]
                a = [float(layer.inputs[k, byte]) for k in range(3 * n)]
                z = [sigmoid(a[u] + g[u]) for u in range(n)]
                r = [sigmoid(a[n + u] + g[n + u]) for u in range(n)]
                c = [math.tanh(a[2 * n + u] + r[u] * g[2 * n + u]) for u in range(n)]
                h = [(1 - z[u]) * c[u] + z[u] * h[u] for u in range(n)]
                states.append(h)
            sides.append(states)
        for f, b in zip(sides[0], sides[1][::-1]):
            logits = [float(net.bias[k]) + sum(float(net.ahead.out[k, u]) * f[u] + float(net.back.out[k, u]) * b[u] for u in range(len(f)))
                      for k in range(len(net.languages))]
            e = [math.exp(v) for v in logits]
            rows.append([v / sum(e) for v in e])
    return (np.mean(rows, axis=0) if rows else np.zeros(len(net.languages))), rows


def test_gradients_equal_differences():
    net = network()
    for d in (net.ahead, net.back):
        d.inputs, d.recurrent, d.out = (a.astype(np.float64) for a in (d.inputs, d.recurrent, d.out))
    net.bias = net.bias.astype(np.float64) + 0.1
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 103, (9, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    valid = np.ones((9, 5))
    valid[6:, 1] = valid[1:, 3] = 0
    _, gradients = net.loss(x, valid, y)
    for w, g in zip(net.weights(), gradients):
        for _ in range(12):
            at = tuple(rng.integers(0, k) for k in w.shape)
            if w.ndim == 2 and w.shape[1] == 256:
                at = (at[0], int(rng.integers(97, 103)))
            keep, e = w[at], 1e-6
            w[at] = keep + e
            up = net.loss(x, valid, y)[0]
            w[at] = keep - e
            down = net.loss(x, valid, y)[0]
            w[at] = keep
            assert abs((up - down) / (2 * e) - g[at]) < 1e-7


def test_scores_equal_plain_loops():
    net = network(units=5)
    texts = [t if t is None or len(t) < 700 else t[:700] for t in ODD] + ["b" * 64, "c" * 65, "ñ" * 40]
    got = B.pooled(net, pa.array(texts, pa.string()))
    for t, p in zip(texts, got):
        want, rows = by_hand(net, t or "")
        assert np.abs(p - want).max() < 1e-5
        if t:
            assert (B.position_labels(net, t) == np.array(rows).argmax(1)).mean() > 0.99


def test_blocks_do_not_matter(monkeypatch):
    net, texts = network(), pa.array([t for t in ODD] * 3, pa.string())
    want = B.pooled(net, texts)
    monkeypatch.setattr(B, "BLOCK", 7)
    assert np.abs(B.pooled(net, texts) - want).max() < 1e-6
    assert np.abs(B.pooled(net, texts.slice(3, 5)) - want[3:8]).max() < 1e-6


def test_operator_on_odd_rows(spark):
    net = network(("de", "en"))
    rows = [(i, t, "clash", {"x": 1}) for i, t in enumerate([*ODD, "123 ...", "é", "the same", "the same"])] + [(None, "the same", "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Score string, extra map<string,int>").repartition(3)
    got = B.with_language(df, net).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "extra", "lang_pred", "score"}
    for r in got:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            p = B.pooled(net, pa.array([r.text]))[0]
            assert r.lang_pred == net.languages[p.argmax()] and abs(r.score - p.max()) < 1e-6 and 0 <= r.score <= 1
    assert B.with_language(df.limit(0), net).count() == 0
    assert {r.lang_pred for r in B.with_language(df, None).collect()} == {"und"}
    for r in B.language_spans(df, net).collect():
        assert [s.start for s in r.spans] == [0, *[s.end for s in r.spans]][:-1] if r.spans else not r.text
        assert not r.spans or r.spans[-1].end == len(r.text.encode())


def test_fit_on_odd_tables(spark):
    schema = "text string, lang string"
    assert B.fit(spark.createDataFrame([("x", None), (None, "de"), ("", "en")], schema)) is None
    one = B.fit(spark.createDataFrame([("nur eine Sprache", "de")] * 5, schema), steps=3)
    assert one.languages == ["de"] and B.pooled(one, pa.array(["x"]))[0].tolist() == [1.0]
    with pytest.raises(ValueError):
        B.fit(spark.range(600).selectExpr("'text' AS text", "cast(id AS string) AS lang"))


def test_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op12_byte_language"](spark, folder).collect()
    assert len(rows) == len(langs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    right = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert len(right) > 150 and np.mean(right) > 0.97


def test_scoring_by_rows_is_the_forward_pass_of_training():
    """Windows of every length, of all byte values: the states of ``by_gate`` are those of ``states``."""
    import numpy as np

    rng = np.random.default_rng(5)
    network = B.Network.drawn(["a", "b", "c"])
    length = np.concatenate([np.arange(1, B.WINDOW + 1), np.full(20, B.WINDOW)])
    x = rng.integers(0, 256, (B.WINDOW, len(length))).astype(np.uint8)
    valid = (np.arange(B.WINDOW)[:, None] < length).astype(np.float32)
    for layer in (network.ahead, network.back):
        (update, *_, candidate), _ = layer.by_gate()
        first = (1 - (np.tanh(update) + 1) / 2) * np.tanh(candidate)
        every = np.arange(256)[None]
        assert np.allclose(first.T, layer.states(every, np.ones((1, 256), np.float32))[0][0], atol=1e-6)
    f, _ = network.ahead.states(x, np.ones_like(valid))
    b, _ = network.back.states(x[::-1], valid[::-1])
    logits = network.ahead.out @ f + network.back.out @ b[::-1] + network.bias[:, None]
    want = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    for t, p in network.probabilities(x, valid):
        inside = valid[t] > 0
        assert np.allclose(p[:, inside], want[t][:, inside], atol=1e-5)


def test_openings_are_the_first_steps_once_for_equal_bytes():
    rng = np.random.default_rng(7)
    network = B.Network.drawn(["a", "b", "c"])
    x = rng.integers(97, 101, (B.OPENING, 400)).astype(np.uint8)
    x[:, :9] = rng.integers(0, 256, (B.OPENING, 9))
    for layer in (network.ahead, network.back):
        opening = layer.opening(x)
        assert len(opening.states[0]) == len(np.unique(x, axis=1).T) < x.shape[1]
        want, _ = layer.states(x, np.ones(x.shape, np.float32))
        for states, step in zip(opening.states, want):
            assert np.allclose(states[opening.which].T, step, atol=1e-6)
    # windows that share openings with others, longest first, and the same in any order
    data, start, length, _ = B.windows(pa.array(["abcdefgh" * k + "xyz"[:k % 4] for k in range(40)] + ["", None, "a", "ab"]))
    assert (np.diff(length) > 0).any()
    order = np.argsort(-length, kind="stable")
    every = network.openings(data, start[order], length[order])
    (_, x, valid), = B.blocks(data, start, length)
    mixed = [(t, p.copy()) for t, p in network.probabilities(x, valid)]
    for (t, p), (s, q) in zip(mixed, network.probabilities(x[:, order], valid[:, order], every)):
        assert t == s and np.allclose(p[:, order], q, atol=1e-6) and not p[:, valid[t] == 0].any()
