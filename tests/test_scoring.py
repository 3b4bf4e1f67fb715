"""Scoring by batches: the version of a batch stays with it, both tables appear together."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pairloom import schemas
from pairloom.streaming import published, scoring

ONE, TWO = scoring.LinearModel("one", 0.5, {"x": 2.0}), scoring.LinearModel("two", -1.0, {"x": -1.0, "y": 0.1})


def features(spark, days, x=1.0):
    rows = [(dt.date(2020, 1, day), 0.0, 1.0, 0.5, None if day == 13 else x * day, 2.0) for day in days]
    return spark.createDataFrame(rows, "date date, mu double, std double, spread double, x double, y double")


def chance(model, day, x=1.0):
    p = 1 / (1 + math.exp(-(model.intercept + model.weights["x"] * x * day + model.weights.get("y", 0.0) * 2)))
    return (1, p) if p >= 0.5 else (0, 1 - p)


def test_versions_change_only_later_batches(spark, tmp_path):
    out, registry = str(tmp_path / "out"), str(tmp_path / "models")
    sink = scoring.score_sink(spark, out, registry)
    assert scoring.current_predictions(spark, out).count() == 0
    scoring.publish_model(spark, registry, ONE, "2024-01-01")
    sink(features(spark, range(1, 15)), 0)
    scoring.publish_model(spark, registry, TWO, "2024-01-02")
    sink(features(spark, range(1, 15)), 0)  # comes again and changes nothing
    assert {r.model_id for r in scoring.current_predictions(spark, out).collect()} == {"one"}
    sink(features(spark, range(10, 20), 2.0), 1)
    got = {r.date.day: r for r in scoring.current_predictions(spark, out).collect()}
    assert sorted(got) == [d for d in range(1, 20) if d != 13]
    for day, r in got.items():
        model, x = (ONE, 1.0) if day < 10 else (TWO, 2.0)
        assert (r.model_id, r.prediction) == (model.model_id, chance(model, day, x)[0]) and abs(r.confidence - chance(model, day, x)[1]) < 1e-12
    sent = published.read_published(spark, out, "messages").withColumn("m", F.from_json("body", schemas.MESSAGE)).collect()
    assert len(sent) == 13 + 9 and all(r.m.direction[str(r.date)] == chance(ONE if r.batch_id == 0 else TWO, r.date.day, 1.0 + r.batch_id)[0] for r in sent)


def test_a_failed_batch_keeps_its_version(spark, tmp_path, monkeypatch):
    out, registry = str(tmp_path / "out"), str(tmp_path / "models")
    sink = scoring.score_sink(spark, out, registry)
    scoring.publish_model(spark, registry, ONE, "2024-01-01")
    with monkeypatch.context() as m:
        m.setattr(scoring, "prediction_messages", lambda df: df.where(F.raise_error(F.lit("down")).isNull()))
        with pytest.raises(Exception, match="down"):
            sink(features(spark, range(1, 5)), 0)
    assert scoring.current_predictions(spark, out).count() == 0
    scoring.publish_model(spark, registry, TWO, "2024-01-02")
    sink(features(spark, range(1, 5)), 0)
    sink(features(spark, range(5, 7)), 1)
    assert {r.date.day: r.model_id for r in scoring.current_predictions(spark, out).collect()} == {**dict.fromkeys(range(1, 5), "one"), 5: "two", 6: "two"}
