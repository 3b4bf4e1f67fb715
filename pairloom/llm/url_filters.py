"""Allow and block rules on host suffixes and path prefixes, looked up by short hash prefixes of full digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: hexadecimal digits of a digest that the join compares
SHORT = 8


def rule_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; only A-Z is lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    A rule (verdict, host, path) fits its host and every subdomain when the path of the url starts with the path of
    the rule. The longest fitting rule wins; of rules equal in host and path, block wins. A url without
    ``://`` or a null url has empty host and path, fits no rule and gets ``default``; empty rule hosts and nulls
    in rules are ignored. Repeated rows stay. Input columns named like results are replaced; an empty table of
    pages or rules is fine.

    Each distinct (host, path) is expanded into the host suffixes that start at a label and the path
    prefixes, of the lengths that rules have. Expressions meet rules on the first digits of their digest; the
    whole digest is compared after that. Rules and matches join by Catalyst's choice: they are broadcast only
    when small, and large skewed keys are split by adaptive execution.
    """
    names = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    known = (rules.where("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL")
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))  # block > allow
    # the lengths in use: as many as urls have characters at most, whatever the number of rules
    lengths = known.agg(F.collect_set(F.length("host")).alias("hosts"), F.collect_set(F.length("path")).alias("paths")).first()
    at = pages.select(*names, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    seen = at.select("host", "path").where("host <> ''").distinct()
    whole = F.length("host")
    suffixes = F.transform(
        F.filter(F.array(*[F.lit(int(x)) for x in sorted(lengths["hosts"])]).cast("array<int>"),
                 lambda n: (n == whole) | ((n < whole) & (F.substring("host", whole - n, F.lit(1)) == "."))),
        lambda n: F.substring("host", whole - n + 1, n))
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(int(x)) for x in sorted(lengths["paths"])]).cast("array<int>"),
                 lambda n: n <= F.length("path")),
        lambda n: F.substring("path", F.lit(1), n))
    spread = (seen.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
              .withColumn("digest", _expression(F.col("suffix"), F.col("prefix"))))
    listed = known.select(_expression(F.col("host"), F.col("path")).alias("listed"), "verdict",
                          F.concat("host", "path").alias("rule"), F.length("host").alias("labels"))
    hits = (spread.withColumn("short", F.left("digest", F.lit(SHORT)))
            .join(listed.withColumn("short", F.left("listed", F.lit(SHORT))), "short")
            .where(F.col("digest") == F.col("listed")))
    best = (hits.groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("n"), "labels", "rule", "verdict")).alias("best"))
            .select("host", "path", "best.rule", "best.verdict"))
    return (at.join(best, ["host", "path"], "left")
            .select(*names, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))


def keep_allowed(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """The pages whose verdict is not block, with their own columns."""
    return judge(pages, rules, default, url).where("verdict <> 'block'").select(
        *[c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")])
