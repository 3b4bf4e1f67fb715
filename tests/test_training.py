"""The search and the scores of folds next to plain loops."""

import math

import numpy as np
import pytest
from helpers import SPEC, to_spark, walk
from pyspark.sql import functions as F

from pairloom.plans import training


@pytest.mark.parametrize("keep", [0.5, 0.34])
def test_halving_against_a_loop(keep):
    rng = np.random.default_rng(2)
    table = rng.random((9, 4)).round(1)
    table[3, 0] = math.nan
    settings, rungs = [{"i": i} for i in range(9)], (1, 2, 4, 8)
    rows = training.successive_halving(settings, rungs, lambda budget, i: table[i, rungs.index(budget)], keep, workers=2)
    alive, want = list(range(9)), []
    for r, budget in enumerate(rungs):
        best = sorted(alive, key=lambda i: (math.isnan(table[i, r]), table[i, r], i))[:1 if r == 3 else max(1, math.ceil(keep * len(alive)))]
        want += [(i, r, budget, i in best) for i in alive]
        alive = sorted(best)
    assert [(x["setting"], x["rung"], x["budget"], x["kept"]) for x in rows] == want
    assert sum(x["kept"] for x in rows if x["rung"] == 3) == 1


def test_side_by_side_keeps_order_and_errors():
    assert training.side_by_side([lambda k=k: k * k for k in range(20)], 4) == [k * k for k in range(20)]
    with pytest.raises(ZeroDivisionError):
        training.side_by_side([lambda: 1, lambda: 1 // 0], 2)


def test_scores_of_folds_equal_plain_formulas(spark):
    """Log loss and accuracy of every fold from the fitted model's own probabilities."""
    pdf = walk(n=120, keys=("a",), start=0.0)
    rng = np.random.default_rng(0)
    pdf["x"] = rng.normal(size=len(pdf))
    pdf["label"] = (pdf.x + rng.normal(size=len(pdf)) > 0).astype(int)
    pdf["weight"] = rng.random(len(pdf)) + 0.5
    pdf["i"] = np.arange(len(pdf))
    df = to_spark(spark, pdf)
    folds = [df.withColumns({"fold": F.lit(k), "role": F.when(F.col("i") % 2 == k, "test").otherwise("train")}) for k in (0, 1)]
    out = {r.fold: r for r in training.scores_of_folds(folds, ["x"], SPEC, workers=2, iterations=2, depth=2).collect()}
    for k, part in enumerate(folds):
        model = training.classifier(["x"], iterations=2, depth=2).fit(part.where("role = 'train'"))
        t = model.transform(part.where("role = 'test'")).toPandas()
        p = np.array([v[1] for v in t.probability])
        loss = -np.where(t.label == 1, np.log(p), np.log(1 - p))
        assert abs(out[k].log_loss - (loss * t.weight).sum() / t.weight.sum()) < 1e-9
        assert abs(out[k].accuracy - ((p > 0.5) == (t.label == 1)).mul(t.weight).sum() / t.weight.sum()) < 1e-9
