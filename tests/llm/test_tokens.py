"""Token counts, encoding and decoding next to the libraries themselves."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pairloom.llm import byte_bpe, token_counts, token_files

ODD = [
    "", None, " ", "  a  b ", "It's we'll they'd 12345 ...!!! don't", "a\n\n b \t c\u00a0d\u2003e", "naïve Straße ÀÉ ΣΑΣ ſ",
    "<|endoftext|>", "x<|endoftext|> y <|endoftext|>z <|startoftext|>", "日本語のテキスト 🙂🙃 👨‍👩‍👧", "e\u0301 combining \x1c\x1d\x85 end\n",
    "a" * 5000, "ab" * 3000 + " " + "word " * 2000, "\x00\x01\x7f", "trailing space ", "\nleading", "one, two., three,.,", "ÉCOLE. éà, ñ.",
    "abc <|ENDOFTEXT|> İstanbul ΟΔΟΣ. Kelvin \u212a Å \u1e9e", "#$%&* | |x| ### word###",
]


def frame(spark, texts=ODD):
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "same row", "x"), (None, "same row", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_counts_equal_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = token_counts.with_token_counts(frame(spark), path, 1024).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        want = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (want, len((r.text or "").encode()), want > 1024), r.text


def test_counts_on_documents(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = token_counts.with_token_counts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), path, 1024).collect()
    assert [r.n_tokens for r in rows] == [len(library.encode(r.text, add_special_tokens=False).ids) for r in rows]


def tiktoken_encoder():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("documents", [False, True])
def test_ids_equal_tiktoken_and_decode(spark, documents):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet") if documents else frame(spark).withColumn("ids", F.lit(1))
    own = tiktoken_encoder()
    rows = byte_bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN).collect()
    for r in rows:
        assert r.ids == own.encode_ordinary(r.text or ""), r.text
        assert bytes(r.decoded) == (r.text or "").encode()


def test_offsets_follow_characters(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    df = frame(spark).select("text", byte_bpe.encoded(F.col("text"), path, public_tokenizers.PATTERN).alias("ids"))
    own = tiktoken_encoder()
    for r in df.select("*", byte_bpe.starts(F.col("text"), F.col("ids"), path, public_tokenizers.PATTERN).alias("at")).collect():
        at = 0
        for i, start in zip(r.ids, r.at):
            done = (r.text or "").encode()[:at]
            assert start == len(done.decode(errors="ignore")), r.text
            at += len(own.decode_single_token_bytes(i))


def test_null_ids_and_empty_table(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    df = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    got = df.select(byte_bpe.decoded(F.col("ids"), path, public_tokenizers.PATTERN).alias("b")).collect()
    assert [bytes(r.b) for r in got] == [b"", b""]
    none = frame(spark).limit(0)
    assert byte_bpe.encode_and_decode(none, path, public_tokenizers.PATTERN).count() == 0
    assert token_counts.with_token_counts(none, public_tokenizers.path("byte_bpe_50k.json"), 5).count() == 0


def test_cache_generations_do_not_change_results():
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter = token_counts.MergeCounter(path)
    want = counter.of_texts([t or "" for t in ODD])
    counter.chunks.kept = 3
    for _ in range(3):
        for t, n in zip(ODD, want):
            assert counter.of_texts([t or ""]) == [n]


def test_query_returns_offsets(spark, tmp_path):
    from pairloom.llm.queries import QUERIES
    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    own, want = tiktoken_encoder(), []
    for t in [t or "" for t in ODD] + ["same row"] * 2:
        at, starts = 0, []
        for i in own.encode_ordinary(t):
            starts.append(len(t.encode()[:at].decode(errors="ignore")))
            at += len(own.decode_single_token_bytes(i))
        want.append(hashlib.sha256(",".join(map(str, starts)).encode()).hexdigest())
    assert sorted(r.starts_sha256 for r in QUERIES["op5_byte_bpe"](spark, str(tmp_path)).collect()) == sorted(want)


def test_cache_is_bounded_in_bytes():
    """Chunks without spaces, each distinct and long, leave nothing behind; short ones at most two generations."""
    bpe = byte_bpe.ByteBpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    own = tiktoken_encoder()
    long = ["".join(chr(0x4E00 + (i * 37 + k * k) % 5000) for k in range(600)) for i in range(200)]
    assert [x.tolist() for x in bpe.encode(long)] == [own.encode_ordinary(t) for t in long]
    assert sum(len(c) for c in (*bpe.chunks.young, *bpe.chunks.old)) < 1000
    bpe.chunks.kept = 20_000
    for i in range(50):
        texts = [f"word{i}x{k} und{k}" for k in range(40)]
        assert [x.tolist() for x in bpe.encode(texts)] == [own.encode_ordinary(t) for t in texts]
        assert len(bpe.chunks.young) + len(bpe.chunks.old) < 600


def test_other_files_and_patterns():
    """A file that the quick paths are not made for is refused (counts) or goes to the library whole (ids)."""
    words, plain = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
    with pytest.raises(ValueError):
        token_counts.MergeCounter(words)
    texts = [t or "" for t in ODD] + ["Hello World"]
    for path in (words, plain):
        library, encoder = Tokenizer.from_file(path), token_files.WordEncoder(path)
        assert [x.tolist() for x in encoder.ids(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), r"\p{L}+\s?|\s|[^\s\p{L}]"
    own = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    assert [x.tolist() for x in byte_bpe.ByteBpe(path, pattern).encode(texts)] == [own.encode_ordinary(t) for t in texts]
