"""Piece tables next to slices of Python strings, and back from the outputs."""

import hashlib

import pytest
from pyspark.sql import functions as F

from pairloom.llm import fill_in_middle as M
from pairloom.llm.queries import QUERIES

ODD = ["", None, "a", "ab", "plain words here\nand there", "has <P> inside", "x<S>", "<M>", "< P> <P", "日本語のテキスト 🙂🙃", "é" * 40,
       "🙂", "ñ" * 70000, "word " * 300000, "\x00\n\t", "<", "S>x<"]


def draws(key):
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    return [int(h[8 * k:8 * k + 8], 16) for k in range(4)]


def by_hand(key, text):
    t, (h1, h2, h3, h4) = text or "", draws(key)
    n = len(t)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark):
    rows = [(i * 10 + k, t, "clash", {"a": 1}) for i, t in enumerate(ODD) for k in range(3)]
    rows += [(None, "the same row", "x", None)] * 2 + [(7, "the same row", "x", None)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, Form string, extra map<string,int>").repartition(3)


def test_outputs_and_the_way_back(spark):
    out = M.fill_in_middle(frame(spark))
    rows = out.select("*", M.original(F.col("output"), F.col("form")).alias("back"),
                      M.original_sha256(F.col("output"), F.col("form")).alias("back_sha")).collect()
    assert len(rows) == 3 * len(ODD) + 4 and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(r.doc_id, r.text)
        assert (r.output_sha256, r.back, r.back_sha) == (sha(r.output), r.text or "", sha(r.text or ""))


def test_parts_can_be_empty():
    whole, buffers = (M.TEXT, 0, 6), M.Buffers(memoryview("añ🙂".encode()[:6] + b"rest"))
    for form in M.ARRANGED:
        for a in (0, 1, 3, 6):
            for b in (0, 1, 3, 6):
                if a <= b:
                    out = buffers.joined(M.arranged(whole, a, b, form))
                    found = [out.index(x) for x in ((b"<S>", b"<P>", b"<M>") if form == "spm" else (b"<P>", b"<S>", b"<M>"))]
                    made = M.Buffers(memoryview(out))
                    assert made.joined(M.restored((M.TEXT, 0, len(out)), found, form)) == buffers.view(whole)


def test_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(None, "psm"), ("x", None)], "output string, form string")
    assert [tuple(r) for r in df.select(M.original(F.col("output"), F.col("form")), M.original_sha256(F.col("output"), F.col("form"))).collect()] == [(None, None)] * 2
    assert M.fill_in_middle(frame(spark).limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_fill_in_middle"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, form, a, m, output = by_hand(r.doc_id, texts[r.doc_id])
        assert tuple(r) == (r.doc_id, n, form, a, m, sha(output), sha(texts[r.doc_id] or ""))
