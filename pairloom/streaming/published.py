"""Several tables that a micro-batch publishes at once."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.session import path_exists

COMMIT = "run string, batch_id long, attempt string"


def _record(path: str, run: str, batch_id: int) -> str:
    return f"{path}/commits/run={run}/batch_id={batch_id}"


def is_published(spark: SparkSession, path: str, run: str, batch_id: int) -> bool:
    return path_exists(spark, f"{_record(path, run, batch_id)}/_SUCCESS")


def publish(spark: SparkSession, path: str, run: str, batch_id: int, tables: Mapping[str, DataFrame]) -> None:
    """Writes a batch's rows of all ``tables`` and then one commit record, which makes them visible.

    An attempt writes under a name of its own and the record, written last, names the attempt. Readers follow the records
    (``read_published``), so a failure between the writes shows the batch in no table, and files that a reader uses are never
    written again. A batch that has a record is left as it is. Batch numbers start at 0 with every new checkpoint: give each
    checkpoint a ``run`` of its own.
    """
    if is_published(spark, path, run, batch_id):
        return
    attempt = uuid.uuid4().hex
    for name, rows in tables.items():
        rows.write.parquet(f"{path}/{name}/run={run}/batch_id={batch_id}/attempt={attempt}")
    spark.createDataFrame([(attempt,)], "attempt string").coalesce(1).write.mode("overwrite").parquet(_record(path, run, batch_id))


def read_published(spark: SparkSession, path: str, name: str, schema: str | None = None) -> DataFrame:
    """The published rows of a table with run and batch_id; ``schema`` of its own columns is needed only before the first commit."""
    if not path_exists(spark, f"{path}/commits"):
        own = f"{schema}, " if schema else ""
        return spark.createDataFrame([], f"{own}run string, batch_id long")
    commits = spark.read.schema(COMMIT).parquet(f"{path}/commits")
    rows = spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")
    rows = rows.withColumns({c.split()[0]: F.col(c.split()[0]).cast(c.split()[1]) for c in COMMIT.split(", ")})
    return rows.join(commits, [c.split()[0] for c in COMMIT.split(", ")], "left_semi").drop("attempt")
