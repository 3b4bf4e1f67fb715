"""Upserts, replacements and versioned dimensions on plain columnar tables.

Each operator returns the new content (or the part of it to overwrite) as a DataFrame; the
``write_*`` functions store it. Writes replace whole partitions, so running one twice is safe.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pairloom.functions.columns import any_null, normal_name, surrogate_key
from pairloom.session import path_exists

SCD_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def normalise_names(df: DataFrame, date: str = "date") -> DataFrame:
    """Stored form: upper-case names without blanks, dates as text."""
    if date in df.columns:
        df = df.withColumn(date, F.col(date).cast("string"))
    return df.toDF(*[normal_name(c) for c in df.columns])


def new_rows(incoming: DataFrame, stored: DataFrame, keys: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Rows whose key is not stored yet."""
    return incoming.join(stored.select(*keys), list(keys), "left_anti").select(*incoming.columns)


def guarded_append(incoming: DataFrame, stored: DataFrame, required: Sequence[str],
                   keys: Sequence[str] = ("symbol", "date"), incomplete: str = "reject") -> DataFrame:
    """Stored rows plus the new rows of a batch; repeating a batch changes nothing.

    A batch with a null in a required column is rejected as a whole; ``incomplete="skip"`` leaves out just those rows. Of
    new rows with one key the smallest is taken.
    """
    if incomplete not in ("reject", "skip"):
        raise ValueError(f"incomplete: {incomplete}")
    if incomplete == "reject":
        n_bad = incoming.agg(F.count(F.when(any_null(required), 1))).scalar()
        incoming = incoming.where(n_bad == 0)
    else:
        incoming = incoming.where(~any_null(required))
    values = [c for c in stored.columns if c not in keys]
    fresh = new_rows(incoming, stored, keys).groupBy(*keys).agg(F.min(F.struct(*values)).alias("_r"))
    return stored.unionByName(fresh.select(*keys, *[F.col("_r").getField(c).alias(c) for c in values]))


@dataclass(frozen=True)
class GateVerdict:
    """What the one pass over a batch found: rows, rows with a null in a required column, nulls by column."""

    n_rows: int
    n_bad: int
    nulls: dict[str, int]

    @property
    def accepted(self) -> bool:
        return self.n_bad == 0


def gated_append(batch: DataFrame, path: str, staging: str, required: Sequence[str], keys: Sequence[str] = ("symbol", "date"),
                 by: str = "date") -> GateVerdict:
    """Appends the new rows of a batch to the table at ``path``, stored by day; a batch with a null in a required column leaves it untouched.

    The batch is read once: while its rows are written to ``staging`` (a folder of its own for each attempt), the gate's counts are
    observed. Only then the verdict falls. An accepted batch is published from the staged files, whose days are read next to the
    same days of the table; of new rows with one key the smallest is taken. A repeated batch, or one whose publication broke off,
    appends what is missing.
    """
    spark, columns = batch.sparkSession, batch.columns
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count(F.when(any_null(required), 1)).alias("n_bad"),
              *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{i}") for i, c in enumerate(columns)]]
    batch.observe(seen, *counts).write.partitionBy(by).parquet(staging)
    found = seen.get
    verdict = GateVerdict(found["n_rows"], found["n_bad"], {c: found[f"null_{i}"] for i, c in enumerate(columns)})
    if not verdict.accepted or not verdict.n_rows:
        return verdict
    staged = spark.read.schema(batch.schema).parquet(staging)
    fresh = staged
    if path_exists(spark, path):
        # days are folders of both tables: only those of the batch are read
        stored = spark.read.schema(batch.schema).parquet(path).join(staged.select(by).distinct(), by, "left_semi")
        fresh = new_rows(staged, stored, keys)
    values = [c for c in columns if c not in keys]
    rows = fresh.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_r"))
    rows.select(*keys, *[F.col("_r").getField(c).alias(c) for c in values]).select(*columns).write.mode("append").partitionBy(by).parquet(path)
    return verdict


def rejection_report(incoming: DataFrame, stored: DataFrame, required: Sequence[str],
                     keys: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """How many rows of a batch are new, already stored, or incomplete."""
    known = stored.select(*keys).distinct().withColumn("_known", F.lit(True))
    marked = incoming.join(known, list(keys), "left").select(
        F.col("_known").isNotNull().alias("known"), any_null(required).alias("incomplete"))
    status = F.when(F.col("incomplete"), "incomplete").when(F.col("known"), "stored").otherwise("new")
    return marked.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n_rows"))


def replace_day(stored: DataFrame, fresh: DataFrame, day: str) -> DataFrame:
    """Stored rows of all other days plus the fresh rows of ``day``, if ``day`` is the newest."""
    today = F.lit(day).cast("date")
    newest = stored.agg(F.max("date")).scalar()
    kept = stored.where(F.coalesce((F.col("date") != today) | (newest != today), F.lit(True)))
    added = fresh.where((F.col("date") == today) & (newest == today))
    return kept.unionByName(added)


def write_days(df: DataFrame, path: str) -> None:
    """Overwrite only the day partitions that ``df`` holds."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path))


def upsert(stored: DataFrame, fresh: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """Full outer join on ``keys``; ``update`` columns take the fresh value, others keep the stored."""
    k = list(keys)
    s = stored.select(*k, F.struct(*stored.columns).alias("_s"))
    f = fresh.select(*k, F.struct(*fresh.columns).alias("_f"))
    out: list[Column] = []
    for c in stored.columns:
        old, new = F.col(f"_s.{c}"), F.col(f"_f.{c}")
        if c in k:
            out.append(F.col(c))
        elif c in update:
            out.append(F.when(F.col("_f").isNotNull(), new).otherwise(old).alias(c))
        else:
            out.append(F.when(F.col("_s").isNotNull(), old).otherwise(new).alias(c))
    return s.join(f, k, "full").select(*out)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact ordered projection, names matched without case."""
    have = {c.lower(): c for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(have[c.lower()]).alias(c) for c in columns])


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).format("parquet").saveAsTable(name)


def drop_table(df_or_spark, name: str) -> None:
    df_or_spark.sql(f"DROP TABLE IF EXISTS {name}")


def first_snapshot(staged: DataFrame, key: str, diff: str, run_ts: str) -> DataFrame:
    """Open versions for every staged row."""
    ts = F.lit(run_ts).cast("timestamp_ntz")
    return staged.select(
        *staged.columns, surrogate_key(F.col(key), ts).alias("scd_id"), ts.alias("updated_at"),
        ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))


def scd2_merge(snapshot: DataFrame, staged: DataFrame, key: str, diff: str, run_ts: str) -> DataFrame:
    """Next state of a versioned dimension.

    A key whose ``diff`` changed gets its open version closed and a new one; new keys get a
    version; vanished keys stay open. Closed versions pass through untouched. One outer join of
    the open versions with the staged rows yields both the closed and the new versions.
    """
    ts = F.lit(run_ts).cast("timestamp_ntz")
    attributes = staged.columns
    closed = snapshot.where(F.col("valid_to").isNotNull())
    opened = snapshot.where(F.col("valid_to").isNull()).select(F.col(key), F.struct(*snapshot.columns).alias("_o"))
    fresh = staged.select(F.col(key), F.struct(*attributes).alias("_n"))
    joined = opened.join(fresh, key, "full")
    changed = F.col("_n").isNotNull() & (F.col("_o").isNull() | (F.col(f"_o.{diff}") != F.col(f"_n.{diff}")))
    old = F.when(F.col("_o").isNotNull(), F.struct(*[
        (F.when(changed, ts).otherwise(F.col("_o.valid_to")) if c == "valid_to" else F.col(f"_o.{c}")).alias(c)
        for c in snapshot.columns]))
    versioned = {"scd_id": surrogate_key(F.col(key), ts), "updated_at": ts, "valid_from": ts,
                 "valid_to": F.lit(None).cast("timestamp_ntz")}
    new = F.when(changed, F.struct(*[
        (versioned[c] if c in versioned else F.col(f"_n.{c}")).alias(c) for c in snapshot.columns]))
    versions = joined.select(F.explode(F.array_compact(F.array(old, new))).alias("_v")).select("_v.*")
    return closed.unionByName(versions)


def current_versions(snapshot: DataFrame, load_ts: bool = True) -> DataFrame:
    """Open versions without the version columns, optionally with their load stamp."""
    current = snapshot.where(F.col("valid_to").isNull())
    if load_ts:
        current = current.withColumn("snsh_load_ts_utc", F.col("updated_at"))
    return current.drop(*SCD_COLUMNS)


def prediction_messages(df: DataFrame, date: str = "date") -> DataFrame:
    """One JSON message per scored row: direction and confidence keyed by the date text."""
    day = F.col(date).cast("string")
    body = F.struct(
        F.create_map(day, F.col("direction").cast("int")).alias("direction"),
        F.create_map(day, F.col("confidence").cast("double")).alias("confidence"),
        day.alias("date"), F.col("mu"), F.col("std"), F.col("spread"))
    return df.select(date, F.to_json(body).alias("body"))


def write_split(df: DataFrame, path: str, split: str, ts: str = "date") -> None:
    """Train rows up to ``split`` and test rows after it, as CSV."""
    at = F.lit(split).cast("date")
    for name, part in (("train", df.where(F.col(ts) <= at)), ("test", df.where(F.col(ts) > at))):
        part.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
