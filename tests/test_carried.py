"""Recursive features of several batches equal those of one run over all bars."""

import numpy as np
import pandas as pd
import pytest
from helpers import SPEC, back, close, to_spark, walk

from pairloom.operators import features as f
from pairloom.streaming import carried
from pairloom.streaming.predictions import run_once

MEANS = {"ma_3": ("v", 3), "ma_9": ("v", 9)}


def bars(n=90):
    pdf = walk(n=n, nulls=(0, 5, 6, 7, 40, 41))
    rng = np.random.default_rng(3)
    pdf["close"] = 100 + rng.normal(size=len(pdf)).cumsum()
    pdf["high"], pdf["low"] = pdf.close + rng.random(len(pdf)), pdf.close - rng.random(len(pdf))
    pdf["volume"] = rng.integers(1, 50, len(pdf)).astype(float)
    return pdf


def whole(spark, pdf):
    df = to_spark(spark, pdf)
    out = back(f.ema(df, SPEC, MEANS)).rename(columns=str)
    out["rsi"] = back(f.rsi(df, SPEC, "close")).rsi
    out["atr"] = back(f.atr(df, SPEC, "high", "low", "close")).atr
    out["vwap"] = back(f.vwap(df, SPEC)).vwap
    return out


def same(got, want):
    assert got[["k", "date"]].values.tolist() == want[["k", "date"]].values.tolist()
    for c in (*MEANS, "rsi", "atr", "vwap"):
        close(got[c], want[c], 1e-8)


@pytest.mark.parametrize("cuts", [(1, 14, 60)])
def test_batches_equal_one_run(spark, cuts):
    pdf = bars()
    days = sorted(pdf.date.unique())
    edges = [days[0], *[days[c] for c in cuts], days[-1] + pd.Timedelta(days=1).to_pytimedelta()]
    carry, parts = None, []
    for lo, hi in zip(edges, edges[1:]):
        part = to_spark(spark, pdf[(pdf.date >= lo) & (pdf.date < hi)])
        carry = carry if carry is not None else carried.empty_carry(part, SPEC, MEANS)
        features, carry, late = carried.continued(part, carry, SPEC.with_(chunk_rows=16), MEANS)
        parts.append(features.toPandas())
        assert late.count() == 0
    same(pd.concat(parts).sort_values(["k", "date"]).reset_index(drop=True), whole(spark, pdf))


def test_series_that_rest_and_late_bars(spark):
    pdf = bars(50)
    days = sorted(pdf.date.unique())
    first, second = pdf[pdf.date <= days[19]], pdf[(pdf.date > days[19]) & (pdf.k == "a")]
    features, carry, _ = carried.continued(to_spark(spark, first), carried.empty_carry(to_spark(spark, first), SPEC, MEANS), SPEC, MEANS)
    again = pd.concat([second, first[first.date == days[10]]])
    features2, carry2, late = carried.continued(to_spark(spark, again), carry, SPEC, MEANS)
    assert late.count() == 2 and carry2.count() == 2
    third = pdf[(pdf.date > days[19]) & (pdf.k == "b")]
    features3, _, _ = carried.continued(to_spark(spark, third), carry2, SPEC, MEANS)
    got = pd.concat([x.toPandas() for x in (features, features2, features3)]).sort_values(["k", "date"]).reset_index(drop=True)
    same(got, whole(spark, pdf))
    none = to_spark(spark, first).limit(0)
    features, kept, _ = carried.continued(none, carry, SPEC, MEANS)
    assert features.count() == 0 and sorted(map(str, kept.collect())) == sorted(map(str, carry.collect()))


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    pdf = bars(60)
    schema = to_spark(spark, pdf).schema
    days = sorted(pdf.date.unique())
    for lo, hi in ((0, 20), (20, 60)):
        to_spark(spark, pdf[pdf.date.isin(days[lo:hi])]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        sink = carried.carry_sink(spark, str(tmp_path / "out"), SPEC, MEANS)

        def twice(batch, batch_id):
            for _ in range(2):
                sink(batch, batch_id)
        run_once(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "", str(tmp_path / "ckpt"), foreach=twice)
    got = spark.read.parquet(str(tmp_path / "out" / "features"))
    assert got.select("batch_id").distinct().count() == 2
    same(back(got.drop("batch_id")), whole(spark, pdf))
