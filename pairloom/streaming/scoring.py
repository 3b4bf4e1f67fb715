"""Continuous scoring: features in, predictions and messages out, with the model version as a slowly changing side input."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.tables import prediction_messages
from pairloom.session import path_exists
from pairloom.streaming.published import is_published, publish, read_published

REGISTRY = "model_id string, published_at timestamp, intercept double, weights map<string, double>"


@dataclass(frozen=True)
class LinearModel:
    """Probability of direction 1 from a weighted sum; a missing input gives no prediction."""

    model_id: str
    intercept: float
    weights: Mapping[str, float]

    def score(self, features: DataFrame) -> DataFrame:
        """``features`` with direction, confidence (probability of the direction) and model_id."""
        z = sum((F.col(c) * F.lit(float(w)) for c, w in sorted(self.weights.items())), F.lit(float(self.intercept)))
        p = 1 / (1 + F.exp(-z))
        return features.withColumns({"direction": (p >= 0.5).cast("int"), "confidence": F.when(p >= 0.5, p).otherwise(1 - p),
                                     "model_id": F.lit(self.model_id)})


def publish_model(spark: SparkSession, registry: str, model: LinearModel, published_at: str) -> None:
    """A new version of the model, one small file; batches that start later use the one published last."""
    row = (model.model_id, model.intercept, dict(model.weights))
    df = spark.createDataFrame([row], "model_id string, intercept double, weights map<string, double>")
    df.select("model_id", F.lit(published_at).cast("timestamp").alias("published_at"), "intercept", "weights").coalesce(1).write.mode(
        "append").parquet(registry)


def _model(spark: SparkSession, registry: str, model_id: str | None = None) -> LinearModel:
    """The model of a name, or the one published last (ties: the greatest name)."""
    versions = spark.read.schema(REGISTRY).parquet(registry)
    if model_id is not None:
        versions = versions.where(F.col("model_id") == model_id)
    r = versions.agg(F.max_by(F.struct("model_id", "intercept", "weights"), F.struct("published_at", "model_id")).alias("m")).first().m
    return LinearModel(r.model_id, r.intercept, r.weights)


def score_sink(spark: SparkSession, path: str, registry: str, run: str = "0"):
    """``foreachBatch`` function that scores feature rows and publishes ``predictions`` and ``messages`` together.

    A batch takes the version that is published last when it starts, and writes its name down before anything else, so a batch that
    is repeated after a failure is scored by the same version, whatever was published in between. Features need date, mu, std and spread
    besides the inputs; rows without a prediction are left out.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if is_published(session, path, run, batch_id):
            return
        chosen = f"{path}/versions/run={run}/batch_id={batch_id}"
        if not path_exists(session, f"{chosen}/_SUCCESS"):
            session.createDataFrame([(_model(session, registry).model_id,)], "model_id string").coalesce(1).write.mode("overwrite").parquet(chosen)
        model = _model(session, registry, session.read.schema("model_id string").parquet(chosen).first().model_id)
        scored = model.score(batch).where("direction IS NOT NULL").persist()  # read once a table; rebuilt if an executor is lost
        try:
            publish(session, path, run, batch_id, {
                "predictions": scored.select("date", F.col("direction").alias("prediction"), "confidence", "model_id"),
                "messages": prediction_messages(scored.select("date", "direction", "confidence", "mu", "std", "spread"))})
        finally:
            scored.unpersist()
    return write


def current_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Per date the prediction of the newest batch that had the date."""
    rows = read_published(spark, path, "predictions", "date date, prediction int, confidence double, model_id string")
    newest = F.max_by(F.struct("prediction", "confidence", "model_id"), F.struct("batch_id", "confidence"))
    return rows.groupBy("date").agg(newest.alias("_r")).select("date", "_r.*")
