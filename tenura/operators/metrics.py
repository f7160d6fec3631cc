"""Classifier metrics over a label and a score column, keyed by optional groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.operators.ranking import running_totals

# Default decision cuts of the threshold table.
THRESHOLDS = (0.2, 0.3, 0.35, 0.4, 0.5)
RECALL_FLOOR = 0.80


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _confusion(y: Column, said: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if(said & (y == 1)),
        "fp": F.count_if(said & (y == 0)),
        "fn": F.count_if(~said & (y == 1)),
        "tn": F.count_if(~said & (y == 0)),
    }


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    return {
        "accuracy": ratio_or_zero(tp + tn, tp + fp + fn + tn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }


def confusion_metrics(
    df: DataFrame, label: str = "y", score: str = "score", cut: float = 0.5, groups: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts with accuracy, precision, recall and F1 at one cut."""
    counts = df.groupBy(*groups).agg(
        *[e.cast("long").alias(n) for n, e in _confusion(F.col(label), F.col(score) >= cut).items()]
    )
    rates = _rates(*map(F.col, ("tp", "fp", "fn", "tn")))
    return counts.select("*", *[e.alias(n) for n, e in rates.items()])


def threshold_metrics(
    df: DataFrame, label: str = "y", score: str = "score", thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Precision, recall and F1 for each cut, all from one pass over the scores."""
    per_cut = [
        F.struct(F.lit(float(t)).alias("threshold"),
                 *[e.alias(n) for n, e in _confusion(F.col(label), F.col(score) >= t).items()])
        for t in sorted(thresholds)
    ]
    counts = df.agg(F.array(*per_cut).alias("cuts")).select(F.inline("cuts"))
    rates = _rates(*map(F.col, ("tp", "fp", "fn", "tn")))
    return counts.select("threshold", *[rates[n].alias(n) for n in ("precision", "recall", "f1")]).orderBy(
        "threshold"
    )


def precision_at_recall_floor(
    df: DataFrame, label: str = "y", score: str = "score", cut: float = 0.5,
    floor: float = RECALL_FLOOR, groups: Sequence[str] = (),
) -> DataFrame:
    """Precision if the recall reaches the floor, else zero."""
    base = confusion_metrics(df, label, score, cut, groups)
    value = F.when(F.col("recall") < floor, 0.0).otherwise(F.col("precision"))
    return base.select(*groups, "recall", value.alias("prec_at_recall"))


def minmax_scores(df: DataFrame, column: str, out: str = "scaled", eps: float = 1e-12) -> DataFrame:
    """Scale raw scores to [0, 1]."""
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    return df.withColumn(out, (F.col(column) - ends["lo"]) / (ends["hi"] - ends["lo"] + F.lit(eps)))


def _steps(df: DataFrame, label: str, score: str, groups: Sequence[str]) -> DataFrame:
    """Running positives and negatives from the highest score down, one row per distinct score."""
    y = F.col(label)
    per_score = df.groupBy(*groups, F.col(score).cast("double").alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    return running_totals(per_score, "score", ["pos", "neg"], groups, descending=True)


def ranking_metrics(
    df: DataFrame, label: str = "y", score: str = "score", groups: Sequence[str] = ()
) -> DataFrame:
    """ROC-AUC (tied scores count half) and step-wise average precision per group."""
    steps = _steps(df, label, score, list(groups))
    pos, neg, cum_pos, cum_neg = (F.col(c).cast("double") for c in ("pos", "neg", "cum_pos", "cum_neg"))
    all_pos, all_neg = F.max("all_pos").cast("double"), F.max("all_neg").cast("double")
    # Negatives below a positive count one, negatives at the same score one half.
    below = F.sum(pos * (F.col("all_neg") - cum_neg + neg / 2))
    precision_steps = F.sum(pos * cum_pos / (cum_pos + cum_neg))
    return steps.groupBy(*groups).agg(
        F.try_divide(below, all_pos * all_neg).alias("roc_auc"),
        F.try_divide(precision_steps, all_pos).alias("average_precision"),
    )


def roc_auc(df: DataFrame, label: str = "y", score: str = "score", groups: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, label, score, groups).select(*groups, "roc_auc")


def average_precision(
    df: DataFrame, label: str = "y", score: str = "score", groups: Sequence[str] = ()
) -> DataFrame:
    return ranking_metrics(df, label, score, groups).select(*groups, "average_precision")


METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")


def all_metrics(df: DataFrame, groups: Sequence[str], label: str = "y", score: str = "score") -> DataFrame:
    """The six metrics per group."""
    keys = list(groups)
    return (
        confusion_metrics(df, label, score, groups=keys)
        .join(ranking_metrics(df, label, score, keys), keys)
        .select(*keys, *METRICS)
    )


def cv_summary(per_fold: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation over folds, long form ``(keys, metric, mean, std)``."""
    names = [m for m in METRICS if m in per_fold.columns]
    return (
        per_fold.unpivot(list(keys), names, "metric", "value")
        .groupBy(*keys, "metric")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
        .orderBy(*keys, "metric")
    )
