"""Boosted-tree training, search and persistence on Spark ML."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from itertools import chain
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import checkpoint_root
from tidemark.operators.boosting import fitted_flat, fitted_models, vector_width
from tidemark.operators.metrics import average_precisions, tier_report
from tidemark.operators.ordering import stratified_folds, time_series_folds
from tidemark.operators.prefixes import FlatTrees, staged_margins
from tidemark.operators.profile import class_balance
from tidemark.operators.selection import exact_lower_medians
from tidemark.settings import SearchSpace

T = TypeVar("T")
WEIGHT = "row_weight"
# Rows of a task while models are fitted: at first, and at most once there are as many tasks as run at once
ROWS_PER_TASK, MOST_ROWS_PER_TASK = 50_000, 400_000


@dataclass(frozen=True)
class TreeParams:
    trees: int = 100
    depth: int = 4
    step_size: float = 0.1
    row_fraction: float = 1.0
    column_fraction: float = 1.0
    min_leaf_rows: int = 1
    seed: int = 42


def aligned(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and exactly ``features`` as doubles; a feature that ``df`` lacks is NULL."""
    present = set(df.columns)
    return df.select(
        *keep,
        *[(F.col(c) if c in present else F.lit(None)).cast("double").alias(c) for c in features],
    )


def encoder_stages(train: DataFrame, features: Sequence[str], prefix: str) -> list:
    """Stages that turn features into ``<prefix>_features``: the value or else the median, and a missing flag each.

    The medians are exact, so a model does not depend on how its rows are partitioned; a feature without any value is
    filled with 0.
    """
    medians = [0.0 if median is None else float(median) for median in exact_lower_medians(train, features)]
    filled = [f"coalesce(`{c}`, {m!r}D) AS `{prefix}_{c}`" for c, m in zip(features, medians, strict=True)]
    flags = [f"CAST(`{c}` IS NULL AS DOUBLE) AS `{prefix}_{c}_missing`" for c in features]
    vector = [f"{prefix}_{c}" for c in features] + [f"{prefix}_{c}_missing" for c in features]
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(filled + flags)} FROM __THIS__"),
        VectorAssembler(inputCols=vector, outputCol=f"{prefix}_features"),
    ]


def boosted_trees(
    params: TreeParams, label_col: str, prefix: str, weight_col: str | None = None, vector_of: str | None = None
) -> GBTClassifier:
    model = GBTClassifier(
        featuresCol=f"{vector_of or prefix}_features",
        labelCol=label_col,
        predictionCol=f"{prefix}_prediction",
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.step_size,
        subsamplingRate=params.row_fraction,
        featureSubsetStrategy=str(float(params.column_fraction)),
        minInstancesPerNode=params.min_leaf_rows,
        seed=params.seed,
    )
    model.setRawPredictionCol(f"{prefix}_raw").setProbabilityCol(f"{prefix}_probability")
    return model.setWeightCol(weight_col) if weight_col else model


def train_model(
    train: DataFrame,
    features: Sequence[str],
    label_col: str,
    params: TreeParams,
    objective: str = "binary",
    prefix: str = "s1",
    classes: int = 3,
) -> PipelineModel:
    """Fit the encoder and a classifier.

    ``binary``: boosted trees, positives weighted by negatives / positives. ``multi``: one boosted classifier per
    class, because Spark's boosting is binary; see ``predicted_class``.
    """
    rows = aligned(train, features, [label_col])
    encoder = encoder_stages(rows, features, prefix)
    marked = with_class_marks(rows, label_col, objective, classes)
    marks = [c for c in marked.columns if c not in features]
    encoded = fitted_on(PipelineModel(encoder).transform(marked).select(*marks, f"{prefix}_features"))
    try:
        return PipelineModel([*encoder, *fitted(encoded, classifiers(params, label_col, objective, prefix, classes))])
    finally:
        encoded.unpersist()


def sized(rows: DataFrame) -> DataFrame:
    """``rows`` in as many partitions as their number asks for, never in more than they have.

    Each tree runs a job a level over the rows, so on few rows tasks cost more than what they do. Once all cores have one,
    more rows make tasks longer before they make more tasks.
    """
    count, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    wanted, least = (-(-count // most) for most in (ROWS_PER_TASK, MOST_ROWS_PER_TASK))
    return rows.coalesce(max(1, least, min(wanted, cores)))


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` in at least as many partitions as tasks run at once, for steps that do much with each row."""
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= tasks else rows.repartition(tasks)


def fitted_on(rows: DataFrame) -> DataFrame:
    """``rows``, ``sized``, cached and without their lineage; unpersist them after the fits.

    Every task of a fit carries the lineage of its rows, and a fit runs a job for each level of each tree: the plan that
    made the rows would be sent and read with each of them. A reliable checkpoint keeps partitions and order.
    """
    checkpoint_root(rows.sparkSession)
    return sized(rows).checkpoint().cache()


def at_once(spark: SparkSession, tasks: Sequence[Callable[[], T]], most: int | None = None) -> list[T]:
    """The results of ``tasks``, which run as concurrent Spark jobs, at most ``most`` at a time."""
    run = inheritable_thread_target(spark)(lambda task: task())
    with ThreadPoolExecutor(max_workers=max(1, min(most or len(tasks), len(tasks)))) as pool:
        return list(pool.map(run, tasks))


def fitted(learned: DataFrame, asked: Sequence[GBTClassifier]) -> list[GBTClassificationModel]:
    """The models of classifiers that differ in their label alone: by one task, or by Spark ML if the rows are too many for that."""
    return fitted_models(learned, asked) or at_once(learned.sparkSession, [lambda c=c: c.fit(learned) for c in asked])


def with_class_marks(rows: DataFrame, label_col: str, objective: str, classes: int = 3) -> DataFrame:
    """Add what the classifiers learn from: a mark per class (``multi``), or the row weight (``binary``)."""
    if objective == "multi":
        return rows.withColumns({f"_is_{c}": (F.col(label_col) == c).cast("double") for c in range(classes)})
    weight = class_balance(rows, label_col).first()["positive_weight"]
    return rows.withColumn(WEIGHT, F.when(F.col(label_col) == 1, F.lit(weight)).otherwise(1.0))


def classifiers(params: TreeParams, label_col: str, objective: str, prefix: str, classes: int = 3) -> list[GBTClassifier]:
    """The classifiers of an objective over ``<prefix>_features``."""
    if objective == "multi":
        return [boosted_trees(params, f"_is_{c}", f"{prefix}_{c}", vector_of=prefix) for c in range(classes)]
    return [boosted_trees(params, label_col, prefix, WEIGHT)]


def positive_probability(prefix: str = "s1") -> Column:
    return vector_to_array(f"{prefix}_probability")[1]


def predicted_class(prefix: str = "s2", classes: int = 3) -> Column:
    """The class whose classifier is most in favour, the lowest of equals."""
    margins = F.array(*[vector_to_array(f"{prefix}_{c}_raw")[1] for c in range(classes)])
    return (F.array_position(margins, F.array_max(margins)) - 1).cast("int")


def random_params(space: SearchSpace, rng: random.Random, seed: int) -> TreeParams:
    low, high = space.step_size
    return TreeParams(
        trees=rng.randint(*space.trees),
        depth=rng.randint(*space.depth),
        step_size=math.exp(rng.uniform(math.log(low), math.log(high))),
        row_fraction=rng.uniform(*space.row_fraction),
        column_fraction=rng.uniform(*space.column_fraction),
        min_leaf_rows=rng.randint(*space.min_leaf_rows),
        seed=seed,
    )


def drawn_params(space: SearchSpace, trials: int, counts_per_fit: int, seed: int) -> list[TreeParams]:
    """The parameters of all trials. ``counts_per_fit`` trials in a row differ in nothing but their number of trees."""
    rng = random.Random(seed)
    found: list[TreeParams] = []
    while len(found) < trials:
        first = random_params(space, rng, seed)
        others = [replace(first, trees=rng.randint(*space.trees)) for _ in range(counts_per_fit - 1)]
        found += [first, *others]
    return found[:trials]


def _numbered(train, label_col: str, objective: str, folds: int, order_by: Sequence[str], seed: int) -> DataFrame:
    if objective == "multi":
        return stratified_folds(train, label_col, order_by[-1], folds, seed)
    return time_series_folds(train, list(order_by), folds)


def _sides(numbered: DataFrame, objective: str, folds: int) -> list[tuple[DataFrame, DataFrame]]:
    """(rows to train on, rows to validate on) of every fold."""
    fold = F.col("fold")
    if objective == "multi":
        return [(numbered.filter(fold != i), numbered.filter(fold == i)) for i in range(folds)]
    return [(numbered.filter(fold < i), numbered.filter(fold == i)) for i in range(1, folds + 1)]


def _encoded_fold(fit: DataFrame, validate: DataFrame, features, label_col, objective) -> tuple[DataFrame, DataFrame]:
    """Both sides of a fold as labels and cached vectors. Medians and weights depend on the fold only, not on a trial."""
    rows = aligned(fit, features, [label_col])
    encoder = PipelineModel(encoder_stages(rows, features, "cv"))
    marked = with_class_marks(rows, label_col, objective)
    marks = [c for c in marked.columns if c not in features]
    learned = encoder.transform(marked).select(*marks, "cv_features")
    judged = encoder.transform(aligned(validate, features, [label_col])).select(label_col, "cv_features")
    return fitted_on(learned), sized(judged).cache()


def staged_scores(learned: DataFrame, judged: DataFrame, label_col: str, params: TreeParams, objective: str, counts: Sequence[int]) -> list[float]:
    """The validation score after each number of trees in ``counts``, from one fit of the most trees.

    Boosting adds trees and changes none, so the first trees of a long fit are the short fit: running margins over the
    trees score every prefix in one pass over the validation rows.
    """
    longest = replace(params, trees=max(counts))
    asked = classifiers(longest, label_col, objective, "cv")
    if vector_width(learned, "cv_features") is None:
        trees = at_once(learned.sparkSession, [lambda c=c: FlatTrees.of_model(c.fit(learned)) for c in asked])
    else:
        trees = fitted_flat(learned, asked)
    staged = staged_margins(judged, "cv_features", [label_col], trees, counts)
    label = F.col(label_col).alias("label")
    if objective == "multi":
        best = (F.array_position("margins", F.array_max("margins")) - 1).cast("int")
        rows = tier_report(staged.select("stage", label, best.alias("prediction")), by=["stage"]).collect()
        found = {r["stage"]: r["weighted_f1"] for r in rows}
    else:
        score = 1 / (1 + F.exp(-2 * F.col("margins")[0]))
        rows = average_precisions(staged.select("stage", label, score.alias("score")), "stage").collect()
        found = {r["stage"]: r["average_precision"] for r in rows}
    return [found[i] for i in range(len(counts))]


def tune_model(
    train: DataFrame,
    features: Sequence[str],
    label_col: str,
    objective: str = "binary",
    trials: int = 50,
    folds: int = 5,
    order_by: Sequence[str] = ("first_order_date", "customer_unique_id"),
    seed: int = 42,
    space: SearchSpace | None = None,
    parallelism: int = 8,
    counts_per_fit: int = 1,
) -> tuple[TreeParams, DataFrame]:
    """Seeded random search; returns the best parameters and one row per trial.

    ``binary`` is judged by average precision on later customers than it was trained on, ``multi`` by weighted F1 on
    stratified folds. Each fold is encoded once for all trials, all folds side by side. Every trial draws all its parameters; with
    ``counts_per_fit`` above 1, so many in a row differ in their number of trees alone and share a fit a fold (see
    ``staged_scores``). Fits of all settings and folds run side by side, each in one task unless its rows are too many for that. A fold without both classes on both sides has no average precision; it is left out and counted in
    ``skipped_folds``. ``fit_seconds`` is the time of the trial's share of its fits.
    """
    spark = train.sparkSession
    drawn = drawn_params(space or SearchSpace(), trials, counts_per_fit, seed)
    groups = [list(range(i, min(i + counts_per_fit, trials))) for i in range(0, trials, counts_per_fit)]
    numbered = _numbered(train, label_col, objective, folds, order_by, seed).cache()
    sides = _sides(numbered, objective, folds)
    encoded = []

    def judge(group: list[int], learned: DataFrame, judged: DataFrame) -> tuple[list[float], float]:
        started = time.perf_counter()
        counts = [drawn[i].trees for i in group]
        scores = staged_scores(learned, judged, label_col, drawn[group[0]], objective, counts)
        return scores, (time.perf_counter() - started) / len(group)

    try:
        scorable = [pair for pair in sides if _has_classes(*pair, label_col, objective)]
        if not scorable:
            raise ValueError("no fold holds both classes")
        encodings = [lambda f=fit, v=validate: encoded.append(_encoded_fold(f, v, features, label_col, objective)) for fit, validate in scorable]
        at_once(spark, encodings, parallelism)
        tasks = [(group, pair) for group in groups for pair in encoded]
        judged = at_once(spark, [lambda g=g, p=p: judge(g, *p) for g, p in tasks], parallelism)
    finally:
        for cached in (numbered, *chain.from_iterable(encoded)):
            cached.unpersist()
    totals, seconds = [0.0] * trials, [0.0] * trials
    for (group, _), (scores, share) in zip(tasks, judged, strict=True):
        for trial, score in zip(group, scores, strict=True):
            totals[trial] += score
            seconds[trial] += share
    means = [total / len(scorable) for total in totals]
    best = max(range(trials), key=lambda i: (means[i], -i))
    rows = [
        (number, *asdict(params).values(), mean, len(sides) - len(scorable), number == best, round(seconds[number], 3))
        for number, (params, mean) in enumerate(zip(drawn, means, strict=True))
    ]
    schema = (
        "trial int, trees int, depth int, step_size double, row_fraction double, column_fraction double, "
        "min_leaf_rows int, seed int, mean_score double, skipped_folds int, is_best boolean, fit_seconds double"
    )
    return drawn[best], spark.createDataFrame(rows, schema)


def _has_classes(fit: DataFrame, validate: DataFrame, label_col: str, objective: str) -> bool:
    if objective == "multi":
        return bool(fit.take(1)) and bool(validate.take(1))
    fitted, judged = class_balance(fit, label_col).first(), class_balance(validate, label_col).first()
    return fitted["positives"] > 0 and fitted["negatives"] > 0 and judged["positives"] > 0
