"""Recurring lines against a plain version of the tree."""

import random
import re
from collections import defaultdict

from pairloom.llm import line_dedup as L


def tokens(line):
    return re.sub("[\t\x0b\x0c\r]", " ", line).strip(" ").split()


def brute(docs, min_docs=3, similarity=0.75):
    rows = sorted({(d is None, d or 0, t or "") for d, t in docs})
    where = defaultdict(set)
    for r in rows:
        for line in r[2].split("\n"):
            if tokens(line):
                where[line].add(r)
    leaves = defaultdict(list)
    for line in where:
        t = tokens(line)
        leaves[len(t), tuple("<*>" if re.search("[0-9]", x) else x for x in t[:2])].append(line)
    template = {}
    for leaf, lines in leaves.items():
        support = defaultdict(int)
        for line in lines:
            for place in enumerate(tokens(line)):
                support[place] += len(where[line])
        for line in lines:
            if len(where[line]) >= min_docs:
                template[line] = ("line", line)
                continue
            if sum(len(where[x]) for x in lines) < min_docs:
                continue
            t = tokens(line)
            fixed = [support[p] >= min_docs for p in enumerate(t)]
            figures = sum(not f and bool(re.search("[0-9]", x)) for f, x in zip(fixed, t))
            if 0 < sum(fixed) < len(t) and sum(fixed) + figures >= similarity * len(t):
                template[line] = (leaf, tuple(x if f else "<*>" for f, x in zip(fixed, t)))
    docs_of = defaultdict(set)
    for line, k in template.items():
        docs_of[k] |= where[line]
    first = {k: min(v) for k, v in docs_of.items() if len(v) >= min_docs}
    out = []
    for d, t in docs:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        r = (d is None, d or 0, t)
        lines = t.split("\n")
        keep = [x for x in lines if not (x in template and template[x] in first and first[template[x]] != r)]
        out.append((d, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


def check(spark, docs):
    df = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, n_lines string")
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in L.without_recurring_lines(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert sorted(got, key=key) == sorted(brute(docs), key=key)
    return got


def test_templates(spark):
    rng = random.Random(2)
    prose = lambda: " ".join(rng.choice("abcdefghij") + str(rng.choice("klmnop")) for _ in range(rng.randrange(1, 12)))
    long_passage = " ".join(f"p{i}" for i in range(60))
    docs = []
    for d in range(40):
        lines = [prose() for _ in range(rng.randrange(0, 6))]
        if d % 4 == 0:
            lines.append(f"Page {d} of 40")
        if d % 5 == 0:
            lines.append(f"Posted by {rng.choice(['Ann', 'Bob', 'Eve', 'Dan', 'Kim', 'Lou', 'Max', 'Ned', 'Pat'])} in the forum today")
        if d % 6 == 0:
            lines.append("All rights reserved.")
        if d % 13 == 0:
            lines += [long_passage, "  ", ""]
        rng.shuffle(lines)
        docs.append((d, "\n".join(lines)))
    docs += [(50, "same\nlines only here 1\nsame"), (50, "same\nlines only here 1\nsame"), (51, docs[1][1]), (52, docs[1][1]), (None, docs[1][1]),
             (None, None), (53, None), (54, ""), (55, "x" * 20000 + " y" * 20000), (56, "tab\tsep\r"), (57, "tab sep"), (58, "\n\n")]
    got = check(spark, docs)
    by = {r[0]: r for r in got if r[0] is not None and r[0] < 50}
    assert "Page 0 of 40" in by[0][1] and "Page 4 of 40" not in by[4][1]
    assert long_passage in by[0][1] and all(long_passage not in by[d][1] for d in (13, 26, 39))


def test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in rows])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.without_recurring_lines(df).count() == 0


def test_long_passage_in_two_documents(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    other = " ".join(f"q{i}" for i in range(49))
    docs = [(1, f"one\n{passage}"), (2, f"{passage}\ntwo\n{other}"), (3, f"three\n{other}\nshort one"), (4, "short one"),
            (5, " ".join(f"r{i}" for i in range(60))), (5, " ".join(f"r{i}" for i in range(60)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r.text, r.n_dropped) for r in L.without_recurring_lines(df, long_words=50).collect())
    assert got == sorted([(1, docs[0][1], 0), (2, f"two\n{other}", 1)] + [(d, t, 0) for d, t in docs[2:]])


def test_long_passage_keeps_its_template(spark):
    body = " ".join(f"p{i}" for i in range(60))
    docs = [(1, f"{body} no 1"), (2, f"{body} no 2"), (3, f"{body} no 2")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.without_recurring_lines(df, long_words=50).collect()}
    assert got == {1: f"{body} no 1", 2: "", 3: ""}


def test_documents_of_many_dropped_lines(spark):
    """Every third line is the document's own; the others recur and leave all documents but the first."""
    def text(d):
        return "\n".join(f"own {d} line {i}x{d}y" if i % 3 == 0 else f"shared line {i * 7919 % 9973} stays" for i in range(6000))

    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in L.without_recurring_lines(
        spark.createDataFrame([(d, text(d)) for d in range(4)], "doc_id long, text string"), similarity=1.0).collect()}
    assert got[0] == (text(0), 6000, 0)
    for d in (1, 2, 3):
        assert got[d] == ("\n".join(line for line in text(d).split("\n") if line.startswith("own")), 6000, 4000)
