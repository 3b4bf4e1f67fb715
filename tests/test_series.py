import numpy as np
import pytest
from helpers import SPEC, back, close, to_spark, walk
from pyspark.sql import functions as F

from pairloom.operators import series as s


def test_running_kinds(spark):
    pdf = walk(nulls=(0, 1, 60, 61, 62))
    out = back(s.running(to_spark(spark, pdf), SPEC, sums={"s": F.col("v")}, lasts={"l": F.col("v")},
                         prevs={"p": F.col("v")}, maxes={"m": F.col("v")}))
    g = pdf.groupby("k").v
    close(out.s, g.transform(lambda x: x.cumsum().ffill()))
    close(out.l, g.ffill())
    close(out.p, g.transform(lambda x: x.ffill().shift()))
    close(out.m, g.transform(lambda x: x.cummax().ffill()))


@pytest.mark.parametrize("chunk", [7, 64, 5000])
def test_sliding_does_not_depend_on_chunks(spark, chunk):
    pdf = walk()
    out = back(s.sliding(to_spark(spark, pdf), SPEC.with_(chunk_rows=chunk), 20, lambda d, w: d.withColumn(
        "m", F.max("v").over(w.rowsBetween(-20, 0))).withColumn("n", F.lead("v", 3).over(w)), ahead=3))
    close(out.m, pdf.groupby("k").v.transform(lambda x: x.rolling(21, min_periods=1).max()))
    close(out.n, pdf.groupby("k").v.shift(-3))
    assert "_ord" not in out.columns and len(out) == len(pdf)


@pytest.mark.parametrize("shape", [dict(rows=8, fan=3, levels=4), dict(rows=50, fan=4, levels=2), dict()])
def test_affine_scan_is_the_recursion(spark, shape):
    pdf = walk()
    df = s.with_ordinal(to_spark(spark, pdf), SPEC)
    out = back(s.affine_scan(df, SPEC, {"y": (0.5 + F.abs(F.sin("v")) / 2, F.col("v")), "n": (F.lit(1.0), F.lit(1.0))}, **shape))
    want = []
    for _, x in pdf.groupby("k").v:
        y = 0.0
        for v in x:
            y = (0.5 + abs(np.sin(v)) / 2) * y + v
            want.append(y)
    close(out.y, want, 1e-8)
    assert (out.n == out._ord + 1).all()


def test_affine_scan_starts_anew_where_nothing_is_left(spark):
    pdf = walk(n=200)
    df = s.with_ordinal(to_spark(spark, pdf), SPEC)
    a = F.when(F.col(s.ORD) % 7 == 3, 0.0).when(F.col(s.ORD) % 11 == 5, 1e-30).otherwise(0.4)
    for shape in (dict(rows=16, fan=4, levels=4), dict()):
        out = back(s.affine_scan(df, SPEC, {"y": (a, F.col("v"))}, **shape))
        want = []
        for _, x in pdf.groupby("k").v:
            y = 0.0
            for i, v in enumerate(x):
                y = (0.0 if i % 7 == 3 or i % 11 == 5 else 0.4) * y + v
                want.append(y)
        close(out.y, want, 1e-8)


def test_time_sliding_reaches_over_slices(spark):
    pdf = walk(n=120)
    spec = SPEC.with_(bucket_days=10)

    def fn(d, w):
        by_day = s.Window.partitionBy("k", "_chunk").orderBy(F.unix_date("date"))
        return d.withColumn("c", F.count("v").over(by_day.rangeBetween(1, 6)))

    out = back(s.time_sliding(to_spark(spark, pdf), spec, fn, ahead_days=6))
    want = [sum(1 for e in x.date if 0 < (e - d).days <= 6) for _, x in pdf.groupby("k") for d in x.date]
    assert out.c.tolist() == want
