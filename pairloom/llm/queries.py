"""One query per text operator with its production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import (
    byte_bpe,
    byte_language,
    compression_classifier,
    decontamination,
    fill_in_middle,
    line_dedup,
    near_dedup,
    quality_rules,
    sharding,
    token_alignment,
    token_counts,
    token_files,
    url_filters,
)
from pairloom.llm.common import read, text_or_empty, work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts.with_token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


OP2 = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
l AS (SELECT *, string_split_regex(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[ \t\x0B\f\r]+') AS t
      FROM lines WHERE regexp_matches(line, '[^ \t\x0B\f\r]')),
k AS (SELECT doc_id, line, t, concat(len(t), chr(10), CASE WHEN regexp_matches(t[1], '[0-9]') THEN '<*>' ELSE t[1] END, chr(10),
             CASE WHEN regexp_matches(t[2], '[0-9]') THEN '<*>' ELSE t[2] END) AS leaf FROM l),
kinds AS (SELECT leaf, line, any_value(t) AS t, count(DISTINCT doc_id) AS docs FROM k GROUP BY leaf, line),
mixed AS (SELECT leaf FROM kinds GROUP BY leaf HAVING sum(docs) >= 3 AND count(*) > 1 AND min(docs) < 3),
tok AS (SELECT leaf, line, docs, unnest(t) AS token, generate_subscripts(t, 1) AS place FROM kinds JOIN mixed USING (leaf)),
sup AS (SELECT leaf, place, token, sum(docs) AS support FROM tok GROUP BY ALL),
spelled AS (SELECT leaf, line, any_value(docs) AS docs, count(*) AS n, sum(CASE WHEN support >= 3 THEN 1 ELSE 0 END) AS fixed,
                   sum(CASE WHEN support < 3 AND regexp_matches(token, '[0-9]') THEN 1 ELSE 0 END) AS figures,
                   string_agg(CASE WHEN support >= 3 THEN token ELSE '<*>' END, ' ' ORDER BY place) AS template
            FROM tok JOIN sup USING (leaf, place, token) GROUP BY leaf, line),
known AS (SELECT line, 'line ' || line AS template FROM kinds WHERE docs >= 3
          UNION ALL SELECT line, 'leaf ' || leaf || chr(10) || template FROM spelled
          WHERE docs < 3 AND fixed > 0 AND fixed < n AND fixed + figures >= 0.75 * n),
used AS (SELECT DISTINCT template, doc_id, line FROM k JOIN known USING (line)),
firsts AS (SELECT template, min(doc_id) AS first_id FROM used GROUP BY template HAVING count(DISTINCT doc_id) >= 3),
dropped AS (SELECT DISTINCT doc_id, line, true AS gone FROM used JOIN firsts USING (template) WHERE doc_id <> first_id),
kept AS (SELECT doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
                coalesce(string_agg(lines.line, chr(10) ORDER BY pos) FILTER (WHERE gone IS NULL), '') AS text
         FROM lines LEFT JOIN dropped USING (doc_id, line) GROUP BY doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, CAST(length(text) AS BIGINT) AS n_chars_kept,
       md5(text) AS text_md5 FROM kept
"""


@query("op2_line_dedup", OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.without_recurring_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars_kept"), F.md5("text").alias("text_md5"))


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.fit(docs, read(spark, sf_dir, "labels"))
    out = quality_rules.judged(docs, rules)
    return out.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "anomaly")


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    token_files.write_token_files(read(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    out = token_files.documents_of(spark, path, "bigint", token_files.crc32_of)
    return out.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.col("ids").alias("ids_crc32"))


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = byte_bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                                     keep=["doc_id"], offsets=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"),
                      F.sha2(F.array_join(F.col("starts").cast("array<string>"), ","), 256).alias("starts_sha256"))


@query("op6_compression_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = compression_classifier.fit(docs, read(spark, sf_dir, "labels"))
    out = compression_classifier.scored(docs, model)
    return out.select("doc_id", (compression_classifier.fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


@query("op7_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_classes(docs).select("doc_id", "class_id", "class_size")


OP8 = """
WITH rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
    ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT page_id, url, coalesce(url, '') AS s FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(s, '(?s)^.*?://([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(s, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM u),
fit AS (SELECT p.host, p.path, r.host || r.path AS rule, r.verdict,
               row_number() OVER (PARTITION BY p.host, p.path ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
        FROM (SELECT DISTINCT host, path FROM p) p JOIN rules r
          ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path AND fit.k = 1
"""


@query("op8_url_filters", OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    out = url_filters.judge(pages, url_filters.rule_frame(spark))
    return out.select("page_id", "host", "path", "rule", "verdict")


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty()
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    out = sharding.shuffle_into_shards(docs, shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query("op10_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_passages(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("item").alias("item_id"), "edits")


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_alignment.with_alignment(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
                                         public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query("op12_byte_language")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = docs.where(compression_classifier.fold(F.col("doc_id")) != 0)
    out = byte_language.with_language(docs.select("doc_id", "text"), byte_language.fit(learned))
    return out.select("doc_id", (compression_classifier.fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


OP13 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
o AS (SELECT *, CASE form WHEN 'plain' THEN t
                          WHEN 'psm' THEN '<P>' || t[1:a] || '<S>' || t[b + 1:n] || '<M>' || t[a + 1:b]
                          ELSE '<S>' || t[b + 1:n] || '<P>' || t[1:a] || '<M>' || t[a + 1:b] END AS output FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN a END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN b - a END AS BIGINT) AS middle_chars, sha256(output) AS output_sha256, sha256(t) AS restored_sha256
FROM o
"""


@query("op13_fill_in_middle", OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = fill_in_middle.fill_in_middle(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                      fill_in_middle.original_sha256(F.col("output"), F.col("form")).alias("restored_sha256"))
