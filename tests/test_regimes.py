import itertools

import numpy as np
import pandas as pd
import pytest
from helpers import SPEC, back, close, to_spark, walk

from pairloom.operators import regimes as r

MODEL = r.Regimes((0.6, 0.4), ((0.9, 0.1), (0.3, 0.7)), (-1.0, 1.5), (1.0, 2.0))


def density(x):
    mu, var = np.array(MODEL.means), np.array(MODEL.variances)
    return np.exp(-((x[:, None] - mu) ** 2) / (2 * var)) / np.sqrt(var)


def test_decode_against_all_paths(spark):
    pdf = walk(n=9, keys=("a",), start=0.0)
    out = back(r.decode(to_spark(spark, pdf), SPEC.with_(chunk_rows=4), "v", MODEL))
    e, a = density(pdf.v.to_numpy()), np.array(MODEL.transition)
    weight = {}
    for path in itertools.product((0, 1), repeat=9):
        p = MODEL.start[path[0]] * e[0, path[0]]
        for t in range(1, 9):
            p *= a[path[t - 1], path[t]] * e[t, path[t]]
        weight[path] = p
    assert tuple(out.state) == max(weight, key=weight.get)
    total = sum(weight.values())
    close(out.p1, [sum(w for p, w in weight.items() if p[t] == 1) / total for t in range(9)])


@pytest.mark.parametrize("mode", ["smooth", "filter"])
def test_decode_does_not_depend_on_chunks(spark, mode):
    pdf = walk(n=200, nulls=(3, 90), start=0.0)
    one = back(r.decode(to_spark(spark, pdf), SPEC.with_(chunk_rows=10_000), "v", MODEL, mode))
    many = back(r.decode(to_spark(spark, pdf), SPEC.with_(chunk_rows=13), "v", MODEL, mode))
    assert one.state.tolist() == many.state.tolist() and len(one) == 396
    close(one.p0, many.p0)
    close(one.p0 + one.p1, np.ones(len(one)))


def test_fit_finds_two_regimes_in_the_tail(spark):
    pdf = walk(n=200)
    rng = np.random.default_rng(0)
    pdf["v"] = np.where(pdf.index % 40 < 20, -3.0, 4.0) + rng.normal(size=len(pdf)) / 4
    out = back(r.fit(to_spark(spark, pdf), SPEC, "v", roll=40), "k")
    close(out.mean0, [-3.0, -3.0], 0.1)
    close(out.mean1, [4.0, 4.0], 0.1)
    close(out.p00 + out.p01, [1.0, 1.0])
    assert (out.steps <= 3000).all()


def test_transitions(spark):
    df = spark.createDataFrame([(0.25, 0.75)], "p0 double, p1 double")
    row = r.next_state(r.transition_probs(df, MODEL.transition, 2), MODEL.transition, 2).first()
    close([row.transition_1_0, row.transition_2_0], [0.25 * 0.9 + 0.75 * 0.3, 0.25 * 0.84 + 0.75 * 0.48])
    assert (row.next_state_1, row.next_state_2) == (1, 0)
    row = r.transition_probs(df, MODEL.transition, 2, power="elementwise").first()
    close([row.transition_2_0], [0.25 * 0.81 + 0.75 * 0.09])


def two_pairs(n=160):
    pdf = walk(n=n)
    rng = np.random.default_rng(0)
    level = np.where(pdf.k == "a", 1.0, 50.0)
    pdf["v"] = np.where(pdf.index % 40 < 20, -level, level) + rng.normal(size=len(pdf)) / 4
    return pdf


def test_every_series_is_decoded_with_its_own_model(spark):
    df = to_spark(spark, two_pairs())
    models = r.fit(df, SPEC, "v", roll=40).cache()
    both = back(r.decode(df, SPEC.with_(chunk_rows=17), "v", models, mode="filter"))
    for m in models.collect():
        one = r.Regimes((m.start0, m.start1), ((m.p00, m.p01), (m.p10, m.p11)), (m.mean0, m.mean1), (m.var0, m.var1))
        alone = back(r.decode(df.where(f"k = '{m.k}'"), SPEC, "v", one, mode="filter"))
        mine = both[both.k == m.k].reset_index(drop=True)
        assert mine.state.tolist() == alone.state.tolist()
        close(mine.p0, alone.p0)
        ahead = back(r.next_state_by_row(r.decode(df.where(f"k = '{m.k}'"), SPEC, "v", models, mode="filter"), 2))
        by_model = back(r.next_state(r.decode(df.where(f"k = '{m.k}'"), SPEC, "v", one, mode="filter"), one.transition, 2))
        assert ahead.next_state_2.tolist() == by_model.next_state_2.tolist() and ahead.next_state_1.tolist() == by_model.next_state_1.tolist()


def test_filtered_states_do_not_look_ahead(spark):
    pdf = two_pairs()
    early = pdf[pdf.date < pdf.date.iloc[100]]
    model = r.Regimes((0.5, 0.5), ((0.9, 0.1), (0.2, 0.8)), (-1.0, 1.0), (1.0, 1.0))
    whole = back(r.decode(to_spark(spark, pdf), SPEC.with_(chunk_rows=13), "v", model, mode="filter"))
    part = back(r.decode(to_spark(spark, early), SPEC.with_(chunk_rows=13), "v", model, mode="filter"))
    same = whole.merge(part, on=["k", "date"])
    assert len(same) == len(part) and (same.state_x == same.state_y).all()
    close(same.p0_x, same.p0_y)


def test_regimes_of_folds_join_by_key(spark):
    from pairloom.plans import training
    pdf = two_pairs().rename(columns={"v": "standardized_spread"})
    pdf["role"] = np.where(pdf.index % 160 < 110, "train", "test")
    df = to_spark(spark, pdf)
    out = training.with_regimes(df, df.where("role = 'train'"), SPEC, parts=("role",)).toPandas()
    assert len(out) == len(pdf) and {"state", "next_state_1", "next_state_2"} <= set(out.columns)
    high = out[out.standardized_spread > 0]
    assert (high.state == 1).mean() > 0.9 and (out[out.standardized_spread < 0].state == 0).mean() > 0.9


def test_whole_series_fit_equals_the_window_fit(spark):
    """The same model, likelihood and number of steps as on one window, whatever the groups; series of one and of equal values too."""
    pdf = two_pairs(90)
    more = pd.DataFrame({"k": ["one"] + ["same"] * 4 + ["none"], "date": list(pdf.date[:1]) + list(pdf.date[:4]) + list(pdf.date[:1]),
                         "v": [3.0] + [2.0] * 4 + [np.nan]})
    both = pd.concat([pdf, more], ignore_index=True)
    df = to_spark(spark, both)
    for chunk in (13, 512):
        out = back(r.fit(df, SPEC.with_(chunk_rows=chunk), "v", roll=None, n_iter=6), "k")
        assert out.k.tolist() == ["a", "b", "one", "same"]
        for row in out.itertuples():
            x = both[(both.k == row.k) & both.v.notna()].sort_values("date").v.to_numpy()
            m, ll, steps = r.fit_window(x, 6)
            o = [0, 1] if m.means[0] <= m.means[1] else [1, 0]
            want = [m.start[o[0]], m.start[o[1]], *np.array(m.transition)[np.ix_(o, o)].ravel(), m.means[o[0]], m.means[o[1]],
                    m.variances[o[0]], m.variances[o[1]], ll]
            close([getattr(row, c) for c in r.FIT_COLUMNS], want, 1e-7)
            assert row.steps == steps


def test_start_of_the_whole_fit_is_the_best_split(spark, monkeypatch):
    monkeypatch.setattr(r, "CUTS", 5)
    pdf = walk(n=150, start=0.0)
    pdf["v"] = pdf.v.round(1)
    out = back(r.two_groups(to_spark(spark, pdf), SPEC, "v"), "k")
    for row in out.itertuples():
        x = pdf[pdf.k == row.k].v.to_numpy()
        close([row.mean0, row.mean1], r._two_means(x))
        close([row.var], [x.var(ddof=1) + r.MIN_VARIANCE])
