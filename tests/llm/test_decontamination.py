"""Passages against a comparison of all places with all items."""

import random
import re

import numpy as np

from pairloom.llm import decontamination as D


def norm(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def distance(item, words, most):
    """Fewest edits between the item and any part of the words."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def brute(docs, items):
    out = {}
    for d, t in docs:
        w = norm(t)
        for i, s in items:
            x = norm(s)
            most = int(0.2 * len(x) + 1e-9)
            if x and len(w) >= len(x) - most:
                e = distance(x, w, most)
                if e <= most:
                    out[d, i] = e
    return out


def make(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "in"]) if rng.random() < 0.4 else f"w{rng.randrange(3000)}"
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([5, 6, 9, 12, 14, 20, 25, 33, 40, 55, 80, 200])]
    items += [(100, "too short"), (101, None), (102, ""), (103, items[4][1])]
    docs = []
    for d in range(150):
        w = [word() for _ in range(rng.randrange(0, 150))]
        if d % 3 == 0:
            k = rng.randrange(12)
            x = norm(items[k][1])
            for _ in range(rng.randrange(0, int(0.2 * len(x) + 1e-9) + 2)):
                p, kind = rng.randrange(len(x)), rng.randrange(3)
                x[p:p + (kind != 0)] = [f"new{rng.randrange(99)}"] if kind != 2 else []
            at = rng.randrange(len(w) + 1)
            joiner = rng.choice([" ", ", ", "\n", " - "])
            w[at:at] = [joiner.join(x).upper() if d % 2 else joiner.join(x)]
        docs.append((d, " ".join(w)))
    docs += [(200, None), (201, ""), (202, items[5][1] + " " + items[6][1]), (203, (items[7][1] + " ") * 400), (None, items[8][1]), (None, items[8][1])]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, node string"),
            spark.createDataFrame(items, "item_id long, text string"))


def test_against_all_places(spark):
    docs, items = make()
    df, bench = frames(spark, docs, items)
    got = D.find_passages(df, bench).collect()
    want = brute([d for d in docs if d[0] is not None and d[0] != 203], items)
    found = {(r.doc_id, r.item): r.edits for r in got if r.doc_id is not None and r.doc_id != 203}
    assert found.keys() <= want.keys()
    assert all(found[k] >= want[k] for k in found)
    missing = [k for k in want if k not in found]
    assert len(missing) <= 0.1 * len(want), missing
    assert not [k for k in missing if want[k] == 0]
    assert sorted(r.item for r in got if r.doc_id is None) == [8, 8]
    assert (203, 7, 0) in {(r.doc_id, r.item, r.edits) for r in got}
    kept = D.drop_contaminated(df, bench)
    assert {r.doc_id for r in kept.collect()} == {d[0] for d in docs} - {r.doc_id for r in got}
    assert kept.columns == df.columns


def test_filters_lose_nothing(spark, monkeypatch):
    docs, items = make(2)
    df, bench = frames(spark, docs[:60] + docs[150:153], items)
    key = lambda rows: sorted((r.doc_id, r.item, r.edits) for r in rows)
    with_filters = key(D.find_passages(df, bench).collect())
    monkeypatch.setattr(D, "HELD", 0)
    assert key(D.find_passages(df, bench).collect()) == with_filters


def test_documents_and_empty_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = {(r.doc_id, r["item"]) for r in D.find_passages(docs, bench).collect()}
    texts = {r.doc_id: " ".join(norm(r.text)) for r in docs.collect()}
    exact = {(d, r.item_id) for r in bench.collect() for d, t in texts.items() if " ".join(norm(r.text)) in t}
    assert exact and exact <= found
    assert D.find_passages(docs.limit(0), bench).count() == 0
    assert D.find_passages(docs, bench.limit(0)).count() == 0
    assert D.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_edit_distance():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64), rng.integers(0, 4, rng.integers(0, 14)).astype(np.uint64)
        full = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                full[i][j] = i + j if not i or not j else min(full[i - 1][j] + 1, full[i][j - 1] + 1, full[i - 1][j - 1] + int(a[i - 1] != b[j - 1]))
        most = int(rng.integers(0, 6))
        assert D.edit_distance(a, b, most) == min(min(full[len(a)]), most + 1)


def test_embedding_keeps_close_windows_close():
    rng = np.random.default_rng(4)
    a = rng.integers(1, 2**63, 60).astype(np.uint64)
    b = a.copy()
    b[20] = 5
    c = np.delete(a, 10)
    other = rng.integers(1, 2**63, 60).astype(np.uint64)
    keys = [D.embed(x, np.array([0]), np.array([len(x)]), 50, 64)[0] for x in (a, b, c, other)]
    assert (keys[0] == keys[1]).mean() > 0.3 and (keys[0] == keys[2]).mean() > 0.2 and not (keys[0] == keys[3]).any()
    shifted = D.embed(np.concatenate([other, a]), np.array([60]), np.array([120]), 50, 64)[0]
    assert (shifted == keys[0]).all()


def edited(rng, words, edits):
    x = list(words)
    for _ in range(edits):
        p, kind = rng.randrange(len(x)), rng.randrange(3)
        x[p:p + (kind != 0)] = [f"new{rng.randrange(10**9)}"] if kind != 2 else []
    return x


def test_recall_of_each_size(spark):
    rng = random.Random(3)
    sizes = (5, 9, 15, 30, 59, 100, 200, 300)
    items = {100 * n + k: [f"w{rng.randrange(10**9)}" for _ in range(n)] for n in sizes for k in range(100)}
    docs = [(i, " ".join([f"a{rng.randrange(10**9)}" for _ in range(20)] + edited(rng, w, int(0.2 * len(w) + 1e-9))
                         + [f"z{rng.randrange(10**9)}" for _ in range(20)])) for i, w in items.items()]
    df, bench = frames(spark, docs, [(i, " ".join(w)) for i, w in items.items()])
    found = {(r.doc_id, r.item) for r in D.find_passages(df, bench).collect()}
    recall = {n: sum((i, i) in found for i in items if i // 100 == n) / 100 for n in sizes}
    assert all(r >= 0.93 for r in recall.values()), recall
    assert len(found) == sum((i, i) in found for i in items)


def test_segments_stand_unchanged():
    rng = random.Random(6)
    for n in (5, 9, 10, 14, 15, 40, 200):
        words = list(range(1, n + 1))
        most = int(0.2 * n + 1e-9)
        length = n // (most + 1)
        want = D.segments(np.array(words, np.uint64), length, 7)
        assert len(want) == most + 1
        for _ in range(20):
            x = np.array([w if isinstance(w, int) else 1000 + int(w[3:]) for w in edited(rng, words, most)], np.uint64)
            assert np.isin(want, D.grams(x, length, 7)).any()


def test_slices_change_nothing(spark, monkeypatch):
    rng = random.Random(8)
    items = [(k, " ".join(f"w{rng.randrange(2000)}" for _ in range(n))) for k in range(200) for n in (15 + k % 3,)]
    items += [(0, items[1][1]), (0, items[2][1]), (500, " ".join(f"v{k}" for k in range(120)))]
    docs = [(k, " ".join([f"w{rng.randrange(2000)}" for _ in range(9)] + edited(rng, t.split(), int(0.2 * len(t.split()) + 1e-9)) + ["end"] * 9))
            for k, t in items]
    df, bench = frames(spark, docs, items)
    key = lambda rows: sorted((r.doc_id, r.item, r.edits) for r in rows)
    whole, scans = key(D.find_passages(df, bench).collect()), []
    monkeypatch.setattr(D, "HELD", 1500)
    search = getattr(D, "_search", None)
    monkeypatch.setattr(D, "_search", lambda *a: scans.append(search(*a)) or scans[-1], raising=False)
    assert key(D.find_passages(df, bench).collect()) == whole
    assert len(scans) > 2 and all(len(s.known.values) < 3000 for s in scans)


CHINESE = "中文基准测试题目需要在长文档里面被逐字找到即使整段文字没有任何空格也不能漏掉这一个句子因为它来自公开的评测集合"
JAPANESE = "これは公開された評価用の問題文であり、カタカナとひらがなと漢字を含みますが、単語の間に空白はありません。"
THAI = "นี่คือข้อสอบภาษาไทยที่ไม่มีช่องว่างระหว่างคำเลยและต้องหาให้พบในเอกสาร"


def test_words_of_all_scripts():
    def count(text):
        return len(D._words([text])[0])

    assert count("naïve Straße ÀÉ 3½") == 4 and count("e\u0301a b") == 2 and count("→ ・ 🙂 × ÷ — «»") == 0
    assert count("中文 abc中d") == 5 and count("カタカナ") == 4 and count("हिन्दी भाषा") == 2 and count("กำลัง") == 4 and count("한국어 단어") == 2
    one, two = D._words(["中文测试 naïve", "中 文, 测-试 (NAÏVE)"])
    assert (one == two).all()
    texts = [CHINESE, "", "a", JAPANESE + THAI, "x" * 70]
    apart, together = [D._words([t])[0] for t in texts], D._words(texts)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(apart, together))


def test_scripts_without_spaces(spark):
    rng = random.Random(4)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 800)]
    noise = ["".join(rng.choice(letters) for _ in range(200)) for _ in range(30)]
    items = [(1, CHINESE), (2, JAPANESE), (3, THAI)]
    docs = [(k, n) for k, n in enumerate(noise)]
    for i, t in items:
        edited = t[:10] + "换" + t[11:30] + t[31:]
        docs += [(100 + i, noise[i] + t + noise[i + 1]), (200 + i, noise[i] + "。" + edited + noise[i + 2]), (300 + i, t.replace("่", "่\u200b") if i == 3 else "\n".join(t))]
    df, bench = frames(spark, docs, items)
    found = {(r.doc_id, r.item) for r in D.find_passages(df, bench).collect()}
    assert found == {(base + i, i) for base in (100, 200, 300) for i, _ in items}


def test_short_items_word_for_word(spark):
    items = [(1, "Zugspitze"), (2, "forty two"), (3, "one, two three"), (4, "alpha beta gamma delta"), (5, "東京"), (6, "..."), (7, "nowhere at all")]
    docs = [(1, "on the ZUGSPITZE today"), (2, "zugspitzen forty-two"), (3, "two three one two\nThree"), (4, "alpha beta gamma delt alpha beta gamma delta"),
            (5, "去東京"), (6, "京東 one two"), (7, "forty two " * 3000), (8, None), (9, "")]
    df, bench = frames(spark, docs, items)
    got = sorted((r.doc_id, r.item, r.edits) for r in D.find_passages(df, bench).collect())
    assert got == [(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 0), (7, 2, 0)]
    assert D.find_passages(df, bench, short_items=False).count() == 0 and D.drop_contaminated(df, bench).count() == len(docs)
    assert sorted(r.doc_id for r in D.drop_contaminated(df, bench, short_items=True).collect()) == [6, 8, 9]
    one = spark.createDataFrame([(1, "Zugspitze")], "item_id long, text string")
    assert [r.doc_id for r in D.find_passages(df, one).collect()] == [1]
