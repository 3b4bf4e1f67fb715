"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def builder(app_name: str = "pairloom") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    for key, value in SESSION_CONF.items():
        b = b.config(key, value)
    return b


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the workers this package, once per application: they need it to run functions defined in it.

    Spark sends the file from the driver to every executor, also to those that join later.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="pairloom-"), "pairloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only a local session that names no such folder falls back to a temporary one; elsewhere executors could not
    see each other's files, so that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    else:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        path = tempfile.mkdtemp(prefix=f"{label}-")
    _made.setdefault(getattr(spark.sparkContext, "applicationId", None), []).append(path)
    return path


_made: dict[str, list[str]] = {}


def remove_work(spark: SparkSession) -> int:
    """Deletes the folders that ``work_dir`` has named in this application, and only those; returns how many were there.

    Frames that were built on them can't be read afterwards: call it when the results of a run are stored elsewhere.
    """
    gone = 0
    for path in _made.pop(spark.sparkContext.applicationId, []):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return gone


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written under the shared folder and read back: later uses neither run nor plan its lineage again."""
    path = work_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reaches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
