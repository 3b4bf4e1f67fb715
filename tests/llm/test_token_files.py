"""Packed blocks there and back; ids next to the library."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pairloom.llm import token_files as T
from test_tokens import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 200), st.integers(0, 2**32 - 1), st.integers(49000, 49407)), max_size=700))
def test_round_trip(values):
    ids = np.array(values, np.uint32)
    payload = T.pack(ids)
    assert (T.unpack(payload) == ids).all() and len(T.unpack(payload)) == len(ids)
    for k in range(-(-len(ids) // T.BLOCK)):  # any block by its start
        assert (T.unpack(payload, slice(k, k + 1)) == ids[k * T.BLOCK:(k + 1) * T.BLOCK]).all()


def test_sizes():
    rng = np.random.default_rng(0)
    small = rng.integers(1000, 1100, T.BLOCK * 50).astype(np.uint32)
    small[::40] = 45000  # outliers go to the exception lists
    assert len(T.pack(small)) < 50 * (10 + 16 * 7 + 4 * 5 + 4) + 20
    assert len(T.pack(np.full(T.BLOCK * 10, 7, np.uint32))) == 12 + 11 * 4 + 10 * 6
    assert T.unpack(T.pack(np.empty(0, np.uint32))).size == 0


def check(spark, docs, tmp, monkeypatch=None):
    path = str(tmp / "files")
    T.write_token_files(docs, path, PATH, end_id=2)
    library = Tokenizer.from_file(PATH)
    got = T.read_token_files(spark, path).orderBy("start").collect()
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect()))
    assert [r.key for r in got] == [k if some else None for some, k, _ in rows]
    at = 0
    texts = {}
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 2
        texts.setdefault(r.key, []).append(list(r.ids[:-1]))
        at += r.n_tokens
    want = {}
    for some, k, t in rows:
        want.setdefault(k if some else None, []).append(library.encode(t, add_special_tokens=False).ids)
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}
    crc = {(r.key, r.start): r.ids for r in T.documents_of(spark, path, "bigint", T.crc32_of).collect()}
    assert crc == {(r.key, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}


def test_odd_rows(spark, tmp_path):
    rows = [(i * 7 % 20, t, "clash") for i, t in enumerate(ODD)] + [(None, "null key", ""), (None, "null key", ""), (3, "again", ""), (3, "again", "")]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string, ids string"), tmp_path)


def test_documents_in_small_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "SEGMENT_IDS", 500)
    check(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), tmp_path)


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    T.write_token_files(docs, str(tmp_path / "none"), PATH, end_id=2)
    assert T.read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_bits_of_every_width_are_packed_as_planes():
    rng = np.random.default_rng(6)
    for width in range(1, 33):
        values = rng.integers(0, 1 << 32, (3, T.BLOCK), dtype=np.uint64).astype(np.uint32)
        low = values & np.uint32((1 << width) - 1)
        planes = (low[:, :, None] >> np.arange(width, dtype=np.uint32) & 1).astype(np.uint8).reshape(3, -1)
        packed = T._pack_bits(values, width)
        assert np.array_equal(packed, np.packbits(planes, axis=1, bitorder="little"))
        assert np.array_equal(T._unpack_bits(packed, width), low)


def test_chunks_come_back_as_strings_and_with_their_values_from_every_generation():
    import pyarrow as pa

    from pairloom.llm import chunks as C

    odd = pa.array(["", "a", "ñandú", "漢字", "a\0b", "x" * 300, "😀"], pa.large_string())
    assert C._strings(odd) == odd.to_pylist() and C._strings(odd[:0]) == []
    asked = []

    def spell(todo):
        asked.extend(todo)
        return [np.array([ord(x) for x in c], np.uint32).tobytes() for c in todo]

    texts = ["one two, two. (three) one,", "two! four " + "y" * 300 + " one", "", " ", "five, six. one two,"]
    cut = C.Chunks(spell, keep_space=False)
    small = C.Chunks(spell, keep_space=False, kept=600)  # a generation holds two or three chunks
    for chunks in (cut, small):
        for part in (texts, texts[::-1], texts[1:], texts):
            assert [[chr(i) for i in got] for got in chunks.joined(part)] == [list(t.replace(" ", "")) for t in part]
    asked.clear()
    cut.joined(texts)
    assert asked == ["y" * 300]
