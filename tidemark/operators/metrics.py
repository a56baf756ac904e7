"""Evaluation of scored customers, as aggregates over the scored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import durable
from tidemark.operators.ordering import global_running

# Distinct scores of all groups up to which a group is put in order by one task
FEW_SCORES = 1_000_000


def score_curve(scored: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """One row per distinct score, from the highest: rows and positives at it and down to it.

    Counting per score comes first, so a score shared by very many rows is one row before anything is sorted.
    """
    counted = scored.groupBy(F.col(score_col).alias("threshold")).agg(
        F.sum(F.col(label_col).cast("long")).alias("positives"), F.count(F.lit(1)).alias("cases")
    )
    return global_running(counted, [F.desc("threshold")], ["positives", "cases"])


def _average_precision() -> Column:
    step = F.col("positives").cast("double") * F.col("running_positives") / F.col("running_cases")
    return F.try_divide(F.sum(step), F.max("total_positives"))


def _roc_auc() -> Column:
    negatives = F.col("cases") - F.col("positives")
    area = F.sum(negatives * (F.col("running_positives") - F.col("positives") / 2))
    return F.try_divide(area, F.max(F.col("total_positives").cast("double") * (F.col("total_cases") - F.col("total_positives"))))


def _f_beta(beta: float) -> Column:
    precision = F.col("running_positives") / F.col("running_cases")
    recall = F.coalesce(F.try_divide("running_positives", "total_positives"), F.lit(0.0))
    weight = beta * beta
    # fixed value: the small term that keeps the division defined
    return (1 + weight) * precision * recall / (weight * precision + recall + 1e-9)


def average_precision(scored: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """Sum of precision times recall step over the distinct scores (not the trapezoid area)."""
    return score_curve(scored, label_col, score_col).agg(_average_precision().alias("average_precision"))


def average_precisions(scored: DataFrame, by: str, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """``average_precision`` of each group of ``by``.

    Distinct scores are counted first. If they are few (``FEW_SCORES``), each group is put in order by a task of its own. Otherwise
    all groups share one sort: running totals go on from group to group, so each group takes off what came before it.
    """
    counted = durable(
        scored.groupBy(F.col(by).alias("_by"), F.col(score_col).alias("threshold")).agg(
            F.sum(F.col(label_col).cast("long")).alias("positives"), F.count(F.lit(1)).alias("cases")
        )
    )
    if counted.count() <= FEW_SCORES:
        down_to = Window.partitionBy("_by").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = counted.select("_by", "positives", *[F.sum(c).over(down_to).alias(f"_{c}") for c in ("positives", "cases")])
        step = F.col("positives").cast("double") * F.col("_positives") / F.col("_cases")
        return placed.groupBy(F.col("_by").alias(by)).agg(F.try_divide(F.sum(step), F.sum("positives")).alias("average_precision"))
    placed = global_running(counted, ["_by", F.desc("threshold")], ["positives", "cases"])
    own = placed.groupBy("_by").agg(
        F.sum("positives").alias("_all"),
        *[F.min(F.col(f"running_{c}") - F.col(c)).alias(f"_{c}_before") for c in ("positives", "cases")],
    )
    hits = F.col("running_positives") - F.col("_positives_before")
    step = F.col("positives").cast("double") * hits / (F.col("running_cases") - F.col("_cases_before"))
    found = placed.join(own, "_by").groupBy(F.col("_by").alias(by))
    return found.agg(F.try_divide(F.sum(step), F.max("_all")).alias("average_precision"))


def roc_auc(scored: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    return score_curve(scored, label_col, score_col).agg(_roc_auc().alias("roc_auc"))


def f_beta_threshold(
    scored: DataFrame, beta: float = 2.0, label_col: str = "label", score_col: str = "score"
) -> DataFrame:
    """The score with the best F-beta as decision threshold; the lowest one if several are equally good."""
    graded = score_curve(scored, label_col, score_col).withColumn("f_beta", _f_beta(beta))
    best = F.max_by("threshold", F.struct("f_beta", -F.col("threshold")))
    return graded.agg(best.alias("threshold"), F.max("f_beta").alias("f_beta"))


def binary_report(
    scored: DataFrame,
    threshold: float | None = None,
    beta: float = 2.0,
    label_col: str = "label",
    score_col: str = "score",
) -> DataFrame:
    """Average precision, ROC area, and precision and recall at ``threshold`` (by default the F-beta optimum).

    All from one curve and one aggregate; rounded to four places.
    """
    curve = score_curve(scored, label_col, score_col)
    if threshold is None:
        at = F.max_by(
            F.struct("threshold", "running_positives", "running_cases"),
            F.struct(_f_beta(beta).alias("f"), -F.col("threshold")),
        )
        used, hits, called = at["threshold"], at["running_positives"], at["running_cases"]
    else:
        called_here = F.col("threshold") >= F.lit(float(threshold))
        used = F.lit(float(threshold))
        hits = F.coalesce(F.max(F.when(called_here, F.col("running_positives"))), F.lit(0))
        called = F.coalesce(F.max(F.when(called_here, F.col("running_cases"))), F.lit(0))
    measures = {
        "pr_auc": _average_precision(),
        "roc_auc": _roc_auc(),
        "precision": hits / F.greatest(called, F.lit(1)),
        "recall": F.try_divide(hits, F.max("total_positives")),
        "threshold": used,
    }
    return curve.agg(*[F.round(measure, 4).alias(name) for name, measure in measures.items()])


def confusion(
    predicted: DataFrame, label_col: str = "label", prediction_col: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return predicted.groupBy(*by, label_col, prediction_col).agg(F.count(F.lit(1)).alias("rows"))


def tier_report(
    predicted: DataFrame,
    tiers: Sequence[str] = ("low", "mid", "high"),
    label_col: str = "label",
    prediction_col: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Weighted F1 and the F1 of every tier (0 for a tier that neither occurs nor is predicted), for each group of ``by``."""
    counted = confusion(predicted, label_col, prediction_col, by)
    scores, weighted, support_sum = [], F.lit(0.0), F.lit(0)
    for number, name in enumerate(tiers):
        is_label, is_called = F.col(label_col) == number, F.col(prediction_col) == number
        hits, support, called = (
            F.coalesce(F.sum(F.when(match, F.col("rows"))), F.lit(0)) for match in (is_label & is_called, is_label, is_called)
        )
        score = F.coalesce(F.try_divide(2 * hits, support + called), F.lit(0.0))
        scores.append(F.round(score, 4).alias(f"f1_{name}"))
        weighted, support_sum = weighted + score * support, support_sum + support
    return counted.groupBy(*by).agg(F.round(F.try_divide(weighted, support_sum), 4).alias("weighted_f1"), *scores)


