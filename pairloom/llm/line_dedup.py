"""Recurring lines by a log-template tree: token count, leading tokens, then templates with variable fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import fresh, stored

#: leading tokens that the tree branches on below the token count; tokens with digits share one branch
DEPTH = 2
#: documents that a template, or a token at its place in a leaf, must occur in
MIN_DOCS = 3
#: share of a line's tokens that must be constant in its leaf, or fields with digits, for a template
SIMILARITY = 0.75
FIELD = "<*>"
#: what separates tokens inside a line
SPACE = " \t\x0b\x0c\r"


def tokens(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(SPACE)), f"[{SPACE}]+")


def _leaf(line: Column) -> Column:
    """Hash of the path down the tree: token count and leading tokens."""
    t = tokens(line)
    lead = [F.get(t, F.lit(i)) for i in range(DEPTH)]
    return F.xxhash64(F.size(t), *[F.when(x.rlike("[0-9]"), F.lit(FIELD)).otherwise(x) for x in lead])


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, key, pos, line) of all lines with a token; ``doc`` is a hash of key and text, so equal rows are one document."""
    plain = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cut = plain.select(F.xxhash64("key", "text").alias("doc"), "key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return cut.where(F.col("line").rlike(f"[^{SPACE}]"))


def recurring_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                    similarity: float = SIMILARITY, long_words: int | None = None) -> DataFrame:
    """(doc, pos) of the lines to drop: all lines of a recurring template but those of the first document that has it.

    Lines with the same token count and the same leading tokens share a leaf. A token is constant if it stands at its place in
    lines of ``min_docs`` documents of the leaf (a document counts once for each of its distinct lines); other tokens are variable
    fields. The line's template is its constant tokens with a mark for each field. It recurs if it occurs in ``min_docs``
    documents and at least one token is constant and at most 1 - ``similarity`` of the tokens are fields without
    a digit. A line that recurs as it is needs no fields. A line of ``long_words`` tokens or more, which chance does not repeat, recurs
    as it is from two documents on; it can share a template with others besides. Without ``long_words`` no line does.

    Order and place of rows don't matter: every step is a count by key, with map-side sums, so one line that all
    documents have costs no task more than others.
    """
    lines = _lines(docs, key, text)
    long = [] if long_words is None else [(F.size(tokens(F.col("line"))) >= long_words).alias("long")]
    narrow = stored(lines.select("doc", "key", "pos", _leaf(F.col("line")).alias("leaf"), F.xxhash64("line").alias("lh"), *long), "lines")
    kinds = stored(narrow.select("leaf", "lh", "doc", *["long" for _ in long]).distinct().groupBy("leaf", "lh")
                   .agg(F.count(F.lit(1)).alias("docs"), *[F.max("long").alias("long") for _ in long]), "line-kinds")
    exact = kinds.where(F.col("docs") >= min_docs).select("lh", F.col("lh").alias("template"))
    # leaves in which rarer lines may share a template
    mixed = (kinds.groupBy("leaf").agg(F.sum("docs").alias("n"), F.count(F.lit(1)).alias("kinds"), F.min("docs").alias("least"))
             .where((F.col("n") >= min_docs) & (F.col("kinds") > 1) & (F.col("least") < min_docs)).select("leaf"))
    inside = kinds.join(mixed, "leaf").select("lh", "leaf", "docs")
    # each distinct line once, reduced before the shuffle
    told = lines.groupBy(F.xxhash64("line").alias("lh")).agg(F.min("line").alias("line")).join(inside, "lh")
    placed = stored(told.select("lh", "leaf", "docs", F.posexplode(tokens(F.col("line"))).alias("at", "token")), "tokens")
    support = placed.groupBy("leaf", "at", "token").agg(F.sum("docs").alias("support"))
    shown = F.when(F.col("support") >= min_docs, F.col("token")).otherwise(F.lit(FIELD))
    spelled = (placed.join(support, ["leaf", "at", "token"]).groupBy("lh", "leaf")
               .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("support") >= min_docs).cast("long")).alias("fixed"),
                    F.sum(((F.col("support") < min_docs) & F.col("token").rlike("[0-9]")).cast("long")).alias("figures"),
                    F.array_sort(F.collect_list(F.struct("at", shown.alias("shown")))).alias("parts")))
    templates = (spelled.where((F.col("fixed") > 0) & (F.col("fixed") < F.col("n")) & (F.col("fixed") + F.col("figures") >= F.lit(similarity) * F.col("n")))
                 .select("lh", F.xxhash64("leaf", F.transform("parts", lambda p: p["shown"])).alias("template")))
    known = exact.unionAll(templates.join(exact.select("lh"), "lh", "left_anti"))
    need = F.lit(min_docs)
    if long_words is not None:
        # a passage by a mark of its own, so that its two documents don't count for the template it may have besides
        passage = F.xxhash64(F.lit("passage"), "lh")
        rare = kinds.where(F.col("long") & (F.col("docs") >= 2) & (F.col("docs") < min_docs))
        known = known.select("*", F.lit(False).alias("passage")).unionAll(rare.select("lh", passage.alias("template"), F.lit(True).alias("passage")))
        need = F.when(F.max("passage"), 2).otherwise(min_docs)
    known = stored(known, "templates")
    marks = known.columns[2:]
    used = narrow.join(known, "lh").select("template", "doc", "key", "pos", *marks)
    none = F.col("key").isNull()
    # stored, so that the join below is one of two plain shuffles and adaptive execution can split a template that many lines have
    first = stored(used.groupBy("template", "doc", "key", *marks).agg(F.lit(1).alias("one")).groupBy("template")
             .agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct(none.alias("none"), "key", "doc")).alias("first"), need.alias("need"))
             .where(F.col("docs") >= F.col("need")).select("template", F.col("first.doc").alias("first")), "first-documents")
    return used.join(first, "template").where("doc <> first").select("doc", "pos").distinct()


def without_recurring_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                            similarity: float = SIMILARITY, long_words: int | None = None) -> DataFrame:
    """``docs`` with n_lines, n_dropped and the text without its recurring lines.

    The first document of a template, by key (nulls last) and then by hash, keeps its lines, so groups of copies don't
    lose their only text. Lines are what ``\\n`` separates; lines without a token are never dropped and the order of the rest
    stays. A null text stays null and has no lines. Equal rows are one document and change alike. Input columns of
    the same names are replaced; an empty table gives an empty table.
    """
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    doc, drops, parts = fresh(docs, "doc"), fresh(docs, "drops"), fresh(docs, "parts")
    dropped = (recurring_lines(docs, key, text, min_docs, similarity, long_words).groupBy(F.col("doc").alias(doc))
               .agg(F.sort_array(F.collect_list("pos")).alias(drops)))
    marked = docs.select(*names, F.xxhash64(F.col(key), F.coalesce(F.col(text), F.lit(""))).alias(doc)).join(dropped, doc, "left")
    cut = marked.withColumn(parts, F.split(text, "\n", -1))
    # the stretches between dropped lines: a step a dropped line, and no line is looked up
    edges = F.arrays_zip(F.concat(F.array(F.lit(-1)), drops).alias("a"), F.concat(drops, F.array(F.size(parts))).alias("b"))
    kept = F.array_join(F.flatten(F.transform(edges, lambda x: F.slice(parts, x["a"] + 2, x["b"] - x["a"] - 1))), "\n")
    out = F.when(F.col(drops).isNull() | F.col(text).isNull(), F.col(text)).otherwise(kept)
    return cut.select(*[out.alias(c) if c == text else F.col(c) for c in names],
                      F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
                      F.coalesce(F.size(drops), F.lit(0)).cast("long").alias("n_dropped"))
