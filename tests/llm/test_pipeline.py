"""Every stage of the pipeline on the output of the one before it."""

import sys

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import corpus_pipeline as P  # noqa: E402
import test_decontamination  # noqa: E402
import test_line_dedup  # noqa: E402
import test_near_dedup  # noqa: E402
import tiktoken  # noqa: E402
from test_quality import plain  # noqa: E402
from test_tokens import tiktoken_encoder  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = before.collect(), docs.collect()
        if name != "byte_bpe":
            assert docs.columns == columns
    before, after = kept["quality_rules"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in after}
    for r in before:
        n, _, _, _, repeated = plain(r.text)
        if n < 50 or 100 * repeated > 50 * n:
            assert r.doc_id not in ids
    fine = [r for r in before if labels.get(r.doc_id) == 1 and plain(r.text)[0] >= 50]
    assert sum(r.doc_id in ids for r in fine) >= 0.97 * len(fine)
    before, after = kept["line_dedup"]
    want = {d: t for d, t, _, _ in test_line_dedup.brute([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)
    before, after = kept["near_dedup"]
    before = sorted(before, key=lambda r: r.doc_id)
    roots = {before[k].doc_id for k in test_near_dedup.brute_classes([r.text for r in before])}
    assert {r.doc_id for r in after} == roots
    before, after = kept["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, _ in test_decontamination.brute([(r.doc_id, r.text) for r in before if len(r.text) < 4000], items)}
    assert not leaks & {r.doc_id for r in after}
    own = tiktoken_encoder()
    assert isinstance(own, tiktoken.Encoding)
    before, after = kept["byte_bpe"]
    assert {r.doc_id: r.ids for r in after} == {r.doc_id: own.encode_ordinary(r.text) for r in before}
    assert all(r.round_trip for r in after)
    assert P.run(spark, SF).count() == len(after)
