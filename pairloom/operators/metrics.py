"""Portfolio and classifier metrics as mergeable aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions.columns import pct_change, ratio
from pairloom.operators.series import SeriesSpec, running, sliding


def portfolio_metrics(equity: DataFrame, spec: SeriesSpec, value: str) -> DataFrame:
    """Final over first value, summed return, Sharpe ratio, deepest drawdown and their weighting."""
    keys = list(spec.keys)
    df = sliding(equity, spec, 1, lambda d, w: d.withColumn("_ret", pct_change(F.col(value), w)))
    df = running(df, spec, maxes={"_peak": F.col(value)})
    fall = 1 - ratio(F.col(value), F.col("_peak"))
    out = df.groupBy(*keys).agg(
        F.min_by(value, spec.ts).alias("_first"), F.max_by(value, spec.ts).alias("final_value"),
        F.sum("_ret").alias("cumulative_return"), F.avg("_ret").alias("_mean"), F.stddev_samp("_ret").alias("_dev"),
        F.max(fall).alias("drawdown"), F.max(F.col("_peak") - F.col(value)).alias("drawdown_cash"))
    return out.select(
        *keys, "final_value", ratio(F.col("final_value"), F.col("_first")).alias("profit_ratio"), "cumulative_return",
        (ratio(F.col("_mean"), F.col("_dev")) * F.sqrt(F.lit(252.0))).alias("sharpe"), "drawdown", "drawdown_cash",
        # fixed values: the weights of the score
        (0.3 * F.col("cumulative_return") - 0.7 * F.col("drawdown")).alias("weighted"))


def correlation(df: DataFrame, keys: Sequence[str], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.corr(a, b).alias(name) for name, (a, b) in pairs.items()])


def weighted_scores(df: DataFrame, fold: str, label: str, prob: str, weight: str, slices: int = 1024) -> DataFrame:
    """Log loss, accuracy, class-weighted F1 and area under the ROC curve per fold.

    Loss, accuracy and F1 use the sample weights; the ROC area does not. Its rank sums come
    from counts per distinct score, cumulated in slices of the score range.
    """
    p = F.least(F.greatest(F.col(prob), F.lit(1e-15)), F.lit(1 - 1e-15))
    y, w = F.col(label), F.col(weight).cast("double")
    guess = F.when(F.col(prob) > 0.5, 1).otherwise(0)
    part = df.select(F.col(fold), y.alias("_y"), w.alias("_w"), guess.alias("_g"), p.alias("_p"))
    sums = part.groupBy(fold).agg(
        F.sum("_w").alias("_all"),
        F.sum(F.col("_w") * -F.when(F.col("_y") == 1, F.log("_p")).otherwise(F.log(1 - F.col("_p")))).alias("_loss"),
        *[F.sum(F.when((F.col("_y") == a) & (F.col("_g") == b), F.col("_w")).otherwise(0.0)).alias(f"_c{a}{b}")
          for a in (0, 1) for b in (0, 1)])

    def f1(k: int):
        hit, miss, false = F.col(f"_c{k}{k}"), F.col(f"_c{k}{1 - k}"), F.col(f"_c{1 - k}{k}")
        score = F.coalesce(ratio(2 * hit, 2 * hit + miss + false), F.lit(0.0))
        return score * (hit + miss)

    by_score = df.groupBy(fold, F.col(prob).alias("_p")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).alias("_pos"), F.sum(F.when(y == 1, 0).otherwise(1)).alias("_neg"))
    spec = SeriesSpec((fold,), "_p", bucket=lambda c: F.floor(c * slices))
    ranked = running(by_score, spec, sums={"_below": F.col("_neg")})
    auc = ranked.groupBy(fold).agg(
        F.sum(F.col("_pos") * (F.col("_below") - F.col("_neg") / 2)).alias("_wins"),
        F.sum("_pos").alias("_np"), F.sum("_neg").alias("_nn"))
    return sums.join(auc, fold).select(
        fold, ratio(F.col("_loss"), F.col("_all")).alias("log_loss"),
        ratio(F.col("_c00") + F.col("_c11"), F.col("_all")).alias("accuracy"),
        ratio(f1(0) + f1(1), F.col("_all")).alias("f1"),
        ratio(F.col("_wins"), F.col("_np") * F.col("_nn")).alias("roc_auc"))
