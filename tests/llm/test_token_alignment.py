"""Alignments next to the libraries on whole texts, and corpus counts next to Python dictionaries."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pairloom.llm import token_alignment as A
from pairloom.llm.queries import QUERIES
from pairloom.llm.token_counts import byte_characters
from test_tokens import ODD

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MORE = ["under▁score ▁", "<s> </s> <unk> <0x41>", "ﬁne ﬀ", "a  b   c", "\t\ttabs\r\n\r\nlines", "naïve café naïve", "x", "  ", "the the the"]


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 60), st.data())
def test_runs_equal_set_operations(n, data):
    cuts = st.sets(st.integers(1, n), max_size=n)
    a, b = (sorted(data.draw(cuts) | {n}) for _ in range(2))
    links_a, links_b, groups_a, groups_b = A.alignment(np.array(a), np.array(b))
    common = sorted(set(a) & set(b))
    assert [a[k - 1] for k in groups_a] == common == [b[k - 1] for k in groups_b]
    spans = [list(zip([0, *x[:-1]], x)) for x in (a, b)]
    overlap = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
    assert sorted(zip(links_a.tolist(), links_b.tolist())) == overlap


def test_long_diagonals():
    a = np.arange(1, 5001)
    b = a[~np.isin(a, (1700, 1701, 4000))]
    first_a, first_b, lengths, *_ = A.runs(a.tolist(), b.tolist())
    assert (first_a, first_b, lengths) == ([0, 1702, 4001], [0, 1700, 3998], [1699, 2297, 999])
    links_a, _, groups_a, groups_b = A.alignment(a, b)
    assert len(groups_a) == len(b) and len(links_a) == len(a) and (groups_b == np.arange(1, len(b) + 1)).all()
    assert all(len(x) == 0 for x in A.alignment(a[:0], b[:0]))


def by_hand(texts):
    """Rows without keys for every text, from the whole texts and all pairs of spans by their bounds."""
    library, model = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    library.encode_special_tokens = True
    byte_of = {c: b for b, c in byte_characters().items()}
    rows, held = [], []
    for text in texts:
        text = text or ""
        e = library.encode(" " + text, add_special_tokens=False)
        a, b = e.ids, model.encode(text)
        parts_a = [bytes(byte_of[c] for c in t) for t in e.tokens]
        parts_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in
                   ((i, model.id_to_piece(i)) for i in b)]
        if not text or b"".join(parts_a) != (" " + text).encode() or b"".join(parts_b) != (" " + text).encode():
            rows.append((0, 0, 0, 0, ""))
            held.append(Counter())
            continue
        ends_a, ends_b = ([sum(map(len, p[:k + 1])) for k in range(len(p))] if len(p) < 300 else None for p in (parts_a, parts_b))
        if ends_a is None or ends_b is None:
            ends_a, ends_b = [], []
            for p, out in ((parts_a, ends_a), (parts_b, ends_b)):
                at = 0
                for x in p:
                    at += len(x)
                    out.append(at)
        common = sorted(set(ends_a) & set(ends_b))
        at_a, at_b = {x: k + 1 for k, x in enumerate(ends_a)}, {x: k + 1 for k, x in enumerate(ends_b)}
        groups, i, j = [], 0, 0
        for c in common:
            groups.append(",".join(map(str, a[i:at_a[c]])) + "|" + ",".join(map(str, b[j:at_b[c]])))
            i, j = at_a[c], at_b[c]
        # every stretch between neighbouring ends of either side is the overlap of one token of each
        of_a, of_b = ([k for k, p in enumerate(parts) for _ in p] for parts in (parts_a, parts_b))
        links = Counter((a[of_a[x - 1]], b[of_b[x - 1]]) for x in set(ends_a) | set(ends_b))
        rows.append((len(a), len(b), len(common), sum(links.values()), ";".join(groups)))
        held.append(links)
    docs = Counter(p for links in held for p in links)
    top = Counter()
    for (x, _), n in docs.items():
        top[x] = max(top[x], n)
    return [(*r[:4], sum(n for p, n in links.items() if docs[p] == top[p[0]]), sum(n * docs[p] for p, n in links.items()),
             hashlib.sha256(r[4].encode()).hexdigest() if r[0] else "") for r, links in zip(rows, held)]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_operator_on_odd_texts(spark):
    texts = [*ODD, *MORE, "the same row", "the same row"]
    df = spark.createDataFrame([(None if i % 5 == 0 else i, t, i, {"x": i}) for i, t in enumerate(texts)],
                               "doc_id long, text string, N_A int, at map<string,int>").repartition(3)
    df = df.selectExpr("doc_id", "text", "N_A", "at", "at['x'] AS row_id")
    want = by_hand(texts)
    assert want[texts.index("under▁score ▁")] == (0, 0, 0, 0, 0, 0, "")
    for most in (A.MOST_PAIRS, 40, 1):  # all pairs broadcast, the frequent ones, hardly any
        got = {r.row_id: tuple(r[c] for c in NAMES) for r in A.with_alignment(df, PATH_A, PATH_B, most=most).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_counts_in_small_parts(spark):
    rows = spark.createDataFrame([([1, 2, 3],), ([2, 3],), ([3],), ([],), ([(5 << 32) + 1],)] * 30, "pairs array<long>").repartition(2)
    for held in (2, 1 << 20):
        got = {r.pair: (r.docs, r.best) for r in A.pair_counts(rows, held).collect()}
        assert got == {1: (30, False), 2: (60, False), 3: (90, True), (5 << 32) + 1: (30, True)}


def test_groups_and_empty_table(spark):
    df = spark.createDataFrame([(1, "naïve words")], "doc_id long, text string")
    r = A.aligned(df, PATH_A, PATH_B, with_groups=True).first()
    assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 and r.groups.count(";") == r.n_groups - 1
    assert A.with_alignment(df.limit(0), PATH_A, PATH_B).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in NAMES) for r in QUERIES["op11_token_alignment"](spark, folder).collect()}
    assert got == dict(zip([r.doc_id for r in docs], by_hand([r.text for r in docs])))
