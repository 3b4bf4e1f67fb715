"""Labelled training set, purged cross-validation and scoring with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators import regimes
from pairloom.operators.features import PAIR, technical_features
from pairloom.operators.labels import purged_kfold, relabel, start_uniqueness, triple_barrier
from pairloom.operators.metrics import weighted_scores
from pairloom.operators.series import SeriesSpec
from pairloom.session import work_dir

MODEL_INPUTS = (
    "mu", "std", "standardized_spread", "close_direction_eth_entropy", "close_direction_btc_entropy",
    "bid_ask_spread_close_change_eth", "bid_ask_spread_close_change_btc", "close_btc_coint", "ma_5", "ma_20",
    "vwap_btc", "vwap_eth", "ma_upper_co", "ma_lower_co", "rsi", "atr_btc", "atr_eth",
)

# Take profit, stop loss and holding days of the labels.
TAKE_PROFIT, STOP_LOSS, HOLDING_DAYS = 0.662016, 0.220194, 2


def labelled_set(pair: DataFrame, spec: SeriesSpec = PAIR, until: str | None = None) -> DataFrame:
    """Features, label and label end of every complete row, up to a split date."""
    return labelled_features(technical_features(pair, spec), spec, until)


def labelled_features(features: DataFrame, spec: SeriesSpec = PAIR, until: str | None = None) -> DataFrame:
    """Label and label end of every complete feature row, up to a split date."""
    df = features.where(F.col("standardized_spread").isNotNull())
    df = triple_barrier(df, spec, "standardized_spread", TAKE_PROFIT, STOP_LOSS, HOLDING_DAYS).dropna("any")
    return df if until is None else df.where(F.col(spec.ts) <= F.lit(until).cast("date"))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that several jobs read to the shared folder and read it back."""
    path = work_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(f"{path}/data")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")


def align_columns(test: DataFrame, train_columns: Sequence[str]) -> DataFrame:
    """The train columns in train order; columns the test frame lacks become 0."""
    return test.select(*[F.col(c) if c in test.columns else F.lit(0).alias(c) for c in train_columns])


class ColumnPass(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Identity step over named columns, cast to double, for use between other ML steps."""

    def __init__(self, inputCols: Sequence[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: F.col(c).cast("double") for c in self.getInputCols()})


def classifier(inputs: Sequence[str], iterations: int = 5, depth: int = 3, scaling: bool = True) -> Pipeline:
    """Boosted trees on the assembled inputs."""
    assembled = VectorAssembler(inputCols=list(inputs), outputCol="_raw", handleInvalid="skip")
    stages = [ColumnPass(inputs), assembled]
    if scaling:
        stages.append(StandardScaler(inputCol="_raw", outputCol="features", withMean=True))
    else:
        assembled.setOutputCol("features")
    stages.append(GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=iterations,
                                maxDepth=depth, seed=7))
    return Pipeline(stages=stages)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Direction and probability of the predicted class for feature rows."""
    out = model.transform(df).withColumn("_p", vector_to_array("probability"))
    return (
        out.withColumns({"direction": F.col("prediction").cast("int"), "p_one": F.get("_p", F.lit(1))})
        .withColumn("confidence", F.get("_p", F.col("direction")))
        .drop("_p", "_raw", "features", "rawPrediction", "probability", "prediction")
    )


def with_regimes(df: DataFrame, train: DataFrame, spec: SeriesSpec, ahead: int = 2, parts: Sequence[str] = ()) -> DataFrame:
    """State and next states by a model per series, fitted on the end of its ``train`` rows.

    A row sees only rows before it, and only those of the same ``parts`` (columns such as the role in a fold).
    """
    models = materialise(regimes.fit(train, spec, "standardized_spread"), "regimes")
    series = spec.with_(keys=(*spec.keys, *parts))
    states = regimes.decode(df, series, "standardized_spread", models, mode="filter", model_keys=spec.keys)
    states = regimes.next_state_by_row(states, ahead).drop("standardized_spread", "p0", "p1", *regimes.PARAMETERS)
    return df.join(states, [*series.keys, spec.ts])


def side_by_side(tasks: Sequence[Callable], workers: int) -> list:
    """Results of the tasks in their order; at most ``workers`` of them submit jobs at a time, with the caller's job properties."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(task)) for task in tasks]]


def fold_tables(labelled: DataFrame, spec: SeriesSpec = PAIR, k: int = 3, embargo: float = 0.01, inputs: Sequence[str] = MODEL_INPUTS,
                use_regimes: bool = True, workers: int = 3) -> tuple[list[DataFrame], list[str]]:
    """Stored train and test rows of every purged fold, which all fits share, and the columns of their models.

    ``labelled`` is written once and read by every fold. A row weighs one over the number of labels that cover its start.
    """
    rows = start_uniqueness(relabel(labelled), spec)
    folded = materialise(purged_kfold(rows, spec, "t1", k, embargo).where(F.col("role").isin("train", "test")), "folds")

    def table(fold: int) -> DataFrame:
        part = folded.where(F.col("fold") == fold)
        return materialise(with_regimes(part, part.where("role = 'train'"), spec, parts=("role",)), "regime-rows") if use_regimes else part

    return (side_by_side([lambda fold=fold: table(fold) for fold in range(k)], workers),
            [*inputs, *(("state", "next_state_1", "next_state_2") if use_regimes else ())])


def scores_of_folds(folds: Sequence[DataFrame], columns: Sequence[str], spec: SeriesSpec, workers: int = 3,
                    make: Callable[..., Pipeline] = classifier, **model) -> DataFrame:
    """Scores of one setting in every fold; the folds are fitted side by side."""
    def scored(part: DataFrame) -> DataFrame:
        fitted = make(columns, **model).fit(part.where("role = 'train'"))
        return score(fitted, part.where("role = 'test'")).select("fold", spec.ts, "label", "p_one", "weight")

    parts = side_by_side([lambda part=part: scored(part) for part in folds], workers)
    return weighted_scores(reduce(DataFrame.unionByName, parts), "fold", "label", "p_one", "weight")


def cross_validate(labelled: DataFrame, spec: SeriesSpec = PAIR, k: int = 3, embargo: float = 0.01,
                   inputs: Sequence[str] = MODEL_INPUTS, use_regimes: bool = True, workers: int = 3, **model) -> DataFrame:
    """Scores of every purged fold (``fold_tables``, ``scores_of_folds``)."""
    folds, columns = fold_tables(labelled, spec, k, embargo, inputs, use_regimes, workers)
    return scores_of_folds(folds, columns, spec, workers, **model)


def successive_halving(settings: Sequence[Mapping], rungs: Sequence[int], evaluate: Callable[..., float], keep: float = 0.5,
                       workers: int = 3) -> list[dict]:
    """A search over ``settings``: all of them get the first budget of ``rungs``, the better part of each rung the next budget.

    ``evaluate(budget, **setting)`` gives a loss. ``keep`` of the settings of a rung go on, rounded up, one at least; of equal losses the
    earlier setting does, and a loss that is no number is the worst. Returns a row per setting and rung: setting (its number), rung,
    budget, loss, kept (goes on, or is the winner of the last rung).
    """
    alive, out = list(range(len(settings))), []
    for rung, budget in enumerate(rungs):
        losses = side_by_side([lambda i=i: float(evaluate(budget, **settings[i])) for i in alive], workers)
        ranked = sorted(zip(alive, losses), key=lambda x: (math.isnan(x[1]), x[1], x[0]))
        n = 1 if rung == len(rungs) - 1 else max(1, math.ceil(keep * len(alive)))
        better = {i for i, _ in ranked[:n]}
        out += [{"setting": i, "rung": rung, "budget": budget, "loss": loss, "kept": i in better} for i, loss in zip(alive, losses)]
        alive = sorted(better)
    return out


def grid_search(labelled: DataFrame, settings: Sequence[Mapping], rungs: Sequence[int], spec: SeriesSpec = PAIR, k: int = 3,
                embargo: float = 0.01, inputs: Sequence[str] = MODEL_INPUTS, use_regimes: bool = True, workers: int = 3) -> DataFrame:
    """Successive halving of boosted models over purged folds: the budget is the number of trees, the loss the mean log loss of the folds.

    All fits share the stored fold tables; ``workers`` fits run side by side. Only a loss per setting and rung comes to the driver.
    """
    folds, columns = fold_tables(labelled, spec, k, embargo, inputs, use_regimes, workers)

    def loss(budget: int, **setting) -> float:
        return scores_of_folds(folds, columns, spec, 1, iterations=budget, **setting).agg(F.avg("log_loss")).first()[0]

    rows = successive_halving(settings, rungs, loss, workers=workers)
    names = [tuple(r[c] for c in ("setting", "rung", "budget", "loss", "kept")) for r in rows]
    return labelled.sparkSession.createDataFrame(names, "setting int, rung int, budget int, loss double, kept boolean")
