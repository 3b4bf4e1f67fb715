"""File sources with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom import schemas

_CORRUPT = "_corrupt_record"


def copy_csv(spark: SparkSession, path: str, schema: T.StructType, skip_file: bool = True) -> DataFrame:
    """Bulk CSV load with header and quotes.

    One unreadable row rejects its whole file; with ``skip_file=False`` only the row.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("dateFormat", "yyyy-MM-dd")
    if not skip_file:
        return reader.schema(schema).option("mode", "DROPMALFORMED").csv(path)
    marked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = (
        reader.schema(marked).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path).withColumn("_file", F.col("_metadata.file_path"))
    )
    bad = _bad_rows(rows, schema, "_file").select("_file")
    return rows.join(bad, "_file", "left_anti").drop("_file", _CORRUPT)


def rejected_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that ``copy_csv`` skips, with their number of unreadable rows."""
    marked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = (
        spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd").schema(marked)
        .option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )
    return _bad_rows(rows, schema, "file")


def _bad_rows(rows: DataFrame, schema: T.StructType, file: str) -> DataFrame:
    """Files with unreadable rows. The digest makes the reader parse every column: it would
    otherwise judge a row only by the columns a query uses."""
    digest = F.max(F.xxhash64(*schema.fieldNames())).alias("_digest")
    counts = rows.groupBy(file).agg(F.count(_CORRUPT).alias("bad_rows"), digest)
    return counts.where((F.col("bad_rows") > 0) & F.col("_digest").isNotNull()).drop("_digest")


def stamp_load(df: DataFrame, run_ts: str, column: str = "load_ts") -> DataFrame:
    """Fill missing load stamps with the start time of the run."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(run_ts).cast("timestamp_ntz")))


def load_seed(spark: SparkSession, path: str, schema: T.StructType, run_ts: str) -> DataFrame:
    return stamp_load(spark.read.option("header", True).schema(schema).csv(path), run_ts)


def read_series(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a date column and value columns."""
    return spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd").schema(schema).csv(path)


def read_accounts(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Stored account states, one JSON object per line (or per file with ``multi_line``)."""
    return spark.read.schema(schemas.ACCOUNT).option("multiLine", multi_line).json(path)
