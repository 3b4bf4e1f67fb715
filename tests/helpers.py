"""Small frames with gaps, and sorting back to pandas."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from pairloom.operators.series import SeriesSpec

SPEC = SeriesSpec(("k",), "date", bucket_days=50, chunk_rows=64)
START = dt.date(2000, 1, 1)


def walk(n=300, keys=("a", "b"), nulls=(), seed=0, start=100.0):
    """Random walks; ``nulls`` are row positions without a value; every 17th day is missing."""
    rng = np.random.default_rng(seed)
    days = [START + dt.timedelta(days=i) for i in range(2 * n) if i % 17][:n]
    out = []
    for k in keys:
        v = start + rng.normal(size=n).cumsum()
        v[list(nulls)] = np.nan
        out.append(pd.DataFrame({"k": k, "date": days, "v": v}))
    return pd.concat(out, ignore_index=True)


def to_spark(spark, pdf):
    df = spark.createDataFrame(pdf)
    for f in df.schema.fields:
        if f.dataType.simpleString() == "double":
            df = df.withColumn(f.name, F.when(~F.isnan(f.name), F.col(f.name)))
    return df


def back(df, *order):
    return df.toPandas().sort_values(list(order or ("k", "date"))).reset_index(drop=True)


def close(a, b, tol=1e-9):
    a, b = pd.Series(a, dtype=float).to_numpy(), pd.Series(b, dtype=float).to_numpy()
    assert (np.isnan(a) == np.isnan(b)).all(), (np.flatnonzero(np.isnan(a) != np.isnan(b))[:5])
    ok = ~np.isnan(a)
    assert np.allclose(a[ok], b[ok], rtol=tol, atol=tol), np.abs(a[ok] - b[ok]).max()
