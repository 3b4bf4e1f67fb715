import datetime as dt

import numpy as np
import pandas as pd
import pytest
from helpers import SPEC, back, close, to_spark, walk
from pyspark.sql import functions as F

from pairloom.operators import labels


def test_golden_barriers(spark):
    z = [-0.23413695694918055, 1.5792128155073915, 0.7674347291529088, -0.4694743859349521, 0.5425600435859647]
    pdf = pd.DataFrame({"k": "p", "date": [dt.date(2019, 12, 20 + i) for i in range(5)], "z": z})
    out = back(labels.triple_barrier(spark.createDataFrame(pdf), SPEC, "z", 0.1, 0.1, 2))
    assert out.label.tolist() == [1, -1, -1, 1, 0]
    assert [t.day for t in out.t1] == [21, 22, 23, 24, 26]


def barriers(pdf, tp, sl, h):
    out = []
    for _, x in pdf.groupby("k"):
        d, v = x.date.tolist(), x.v.to_numpy()
        for i in range(len(d)):
            label, t1 = 0, d[i] + dt.timedelta(days=h)
            for j in range(i + 1, len(d)):
                if (d[j] - d[i]).days > h:
                    break
                if abs(v[j]) >= abs(v[i]) * (1 + tp):
                    label, t1 = 1, d[j]
                    break
                if abs(v[j]) <= abs(v[i]) * (1 - sl):
                    label, t1 = -1, d[j]
                    break
            out.append((label, t1))
    return out


def test_barriers_on_minutes(spark):
    rng = np.random.default_rng(3)
    n = 6000
    pdf = pd.DataFrame({"k": "a", "date": pd.date_range("2020-01-01", periods=n, freq="min"), "v": rng.normal(size=n).cumsum() + 50})
    pdf.loc[100:130, "v"] = np.nan
    spec = SPEC.with_(bucket_days=1 / 24)
    out = back(labels.triple_barrier(to_spark(spark, pdf), spec, "v", 0.1, 0.1, 2))
    v, t = pdf.v.to_numpy(), pdf.date.to_numpy()
    for i in range(0, n, 37):
        later = np.flatnonzero((t > t[i]) & (t <= t[i] + np.timedelta64(2, "D")))
        with np.errstate(invalid="ignore"):
            hit = later[(np.abs(v[later]) >= abs(v[i]) * 1.1) | (np.abs(v[later]) <= abs(v[i]) * 0.9)]
        want = (0, t[i] + np.timedelta64(2, "D")) if not len(hit) else (1 if abs(v[hit[0]]) >= abs(v[i]) * 1.1 else -1, t[hit[0]])
        assert (out.label[i], out.t1.to_numpy()[i]) == want


@pytest.mark.parametrize("h", [2, 9])
def test_barriers_against_loops(spark, h):
    pdf = walk(n=200, start=0.0)
    out = back(labels.triple_barrier(to_spark(spark, pdf), SPEC.with_(bucket_days=20), "v", 0.3, 0.2, h))
    assert list(zip(out.label, out.t1)) == barriers(pdf, 0.3, 0.2, h)


def test_sweep_agrees_with_single_runs(spark):
    pdf = walk(n=120, start=0.0)
    grid = [(0.3, 0.2, 2), (0.5, 0.5, 6)]
    out = labels.barrier_sweep(to_spark(spark, pdf), SPEC, "v", grid).groupBy("holding_days").agg(
        F.sum("n_profit").alias("p"), F.sum("n_stop").alias("s"), F.sum("n_timeout").alias("t")).toPandas().set_index("holding_days")
    for tp, sl, h in grid:
        lab = [x[0] for x in barriers(pdf, tp, sl, h)]
        assert [lab.count(1), lab.count(-1), lab.count(0)] == out.loc[h].tolist()


def test_relabel(spark):
    df = spark.createDataFrame([(1,), (0,), (-1,)], "label int")
    assert sorted(r.label for r in labels.relabel(df).collect()) == [0, 1]


def spans(n=200, seed=1):
    pdf = walk(n=n, keys=("a", "b"), seed=seed)
    days = np.random.default_rng(seed).integers(0, 12, len(pdf))
    pdf["t1"] = [d + dt.timedelta(days=int(x)) for d, x in zip(pdf.date, days)]
    return pdf


def test_concurrency_counts_covering_spans(spark):
    pdf = spans()
    df = spark.createDataFrame(pdf)
    out = back(labels.label_concurrency(df.select("k", "date"), df.withColumnRenamed("date", "t0"), SPEC))
    want = [int(((x.date <= d) & (x.t1 >= d)).sum()) for _, x in pdf.groupby("k") for d in x.date]
    assert out.concurrency.tolist() == want


def test_open_spans_last_to_the_end(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, i), None if i == 2 else dt.date(2020, 1, i)) for i in range(1, 6)],
                               "k string, date date, t1 date")
    out = back(labels.label_concurrency(df.select("k", "date"), df.withColumnRenamed("date", "t0"), SPEC))
    assert out.concurrency.tolist() == [1, 1, 2, 2, 2]


def test_purge_removes_every_overlap(spark):
    pdf = spans().rename(columns={"date": "t0"}).drop(columns="v")
    test = pdf.iloc[[20, 21, 90, 260]]
    train = pdf.drop(index=test.index)
    out = labels.purge_train(spark.createDataFrame(train), spark.createDataFrame(test), SPEC.with_(ts="t0")).toPandas()
    want = [(r.k, r.t0) for r in train.itertuples()
            if not any(r.k == t.k and r.t0 <= t.t1 and r.t1 >= t.t0 for t in test.itertuples())]
    assert sorted(zip(out.k, out.t0)) == sorted(want)


@pytest.mark.parametrize("k,embargo", [(3, 0.0), (7, 0.03)])
def test_purged_folds(spark, k, embargo):
    pdf = spans(n=100)
    out = labels.purged_kfold(spark.createDataFrame(pdf), SPEC, "t1", k, embargo).toPandas()
    for key, x in pdf.groupby("k"):
        t0, t1, n = x.date.to_numpy(), x.t1.to_numpy(), len(x)
        for fold, test in enumerate(np.array_split(np.arange(n), k)):
            got = out[(out.k == key) & (out.fold == fold)]
            resume = np.searchsorted(t0, t1[test].max())
            train = set(t0[t1 <= t0[test[0]]]) | (set(t0[resume + int(n * embargo):]) if resume < n else set())
            assert set(got[got.role == "test"].date) == set(t0[test])
            assert set(got[got.role == "train"].date) == train - set(t0[test])
            assert len(got) == n


def test_embargo(spark):
    pdf = walk(n=120)
    out = back(labels.embargo_times(spark.createDataFrame(pdf), SPEC, 0.05))
    for _, x in out.groupby("k"):
        d = x.date.tolist()
        assert x.embargo.tolist() == d[6:] + [d[-1]] * 6
    same = back(labels.embargo_times(spark.createDataFrame(pdf), SPEC, 0.0))
    assert (same.embargo == same.date).all()


def test_forward_candidates(spark):
    pdf = walk(n=90)
    out = back(labels.forward_candidates(to_spark(spark, pdf), SPEC.with_(bucket_days=10), "v", 4), "k", "t0")
    want = [sum(1 for e in x.date if 0 < (e - d).days <= 4) for _, x in pdf.groupby("k") for d in x.date]
    assert out.n_candidates.tolist() == want


def test_start_uniqueness(spark):
    pdf = pd.DataFrame({"k": "a", "date": [dt.date(2020, 1, i) for i in (1, 2, 3, 9)], "t1": [dt.date(2020, 1, i) for i in (3, 3, 4, 9)]})
    out = back(labels.start_uniqueness(spark.createDataFrame(pdf), SPEC))
    assert out.weight.round(6).tolist() == [1.0, 0.5, round(1 / 3, 6), 1.0]


def test_average_uniqueness_over_the_whole_life(spark):
    rng = np.random.default_rng(5)
    pdf = walk(n=60)
    bars = to_spark(spark, pdf).select("k", F.col("date").alias("ts"))
    rows = []
    for i, r in enumerate(pdf.itertuples()):
        if i % 3:
            end = None if i % 17 == 0 else r.date + dt.timedelta(days=int(rng.integers(0, 25)))
            rows.append((r.k, i, r.date, end))
    rows.append(("a", 999, pdf.date.iloc[0] - dt.timedelta(days=9), pdf.date.iloc[0] - dt.timedelta(days=2)))  # no bar in it
    spans = spark.createDataFrame(rows, "k string, id int, t0 date, t1 date").repartition(3)
    out = labels.average_uniqueness(bars, spans, SPEC.with_(ts="ts"), out="w").toPandas().set_index("id").w
    far = dt.date(2100, 1, 1)
    for k, i, t0, t1 in rows:
        held = [d for d in pdf[pdf.k == k].date if t0 <= d <= (t1 or far)]
        shares = [1 / sum(q == k and a <= d <= (b or far) for q, _, a, b in rows) for d in held]
        close([out[i]], [np.mean(shares) if shares else np.nan])
    assert len(out) == len(rows)
