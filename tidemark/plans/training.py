"""From the base table to a trained and evaluated two-stage model."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import bucketed, durable
from tidemark.operators import features as feats
from tidemark.operators import metrics, ordering, targets
from tidemark.operators.attribution import select_features
from tidemark.operators.base_table import base_table
from tidemark.operators.modeling import (
    TreeParams,
    aligned,
    at_once,
    positive_probability,
    predicted_class,
    train_model,
    tune_model,
)
from tidemark.operators.profile import prepare_data
from tidemark.plans.artifact import Artifact
from tidemark.plans.reporting import observed_base_table, observed_split, observed_targets
from tidemark.settings import FEATURES, Settings
from tidemark.sources import CommerceTables, write_bucketed_base_table

CUSTOMER = feats.CUSTOMER


@dataclass(frozen=True)
class Trained:
    artifact: Artifact
    params: dict[str, object]
    metrics: dict[str, float]
    trials1: DataFrame
    trials2: DataFrame


@dataclass(frozen=True)
class _Stage:
    model: PipelineModel
    used: list[str]
    dropped: list[str]
    params: TreeParams
    trials: DataFrame
    report: dict[str, float]


def training_counts(orders: DataFrame, cutoff: datetime | str) -> DataFrame:
    """Customers per state before the cutoff, computed once for the features and for the artifact."""
    return durable(feats.state_counts(feats.latest_state(feats.history(orders, cutoff))))


def store_base_table(tables: CommerceTables, path: str, settings: Settings | None = None) -> dict[str, object]:
    """Store the base table of orders in a valid status, bucketed by customer; returns what was observed of it on the way.

    ``rows``, ``without_customer`` and ``about_customers``.
    """
    settings = settings or Settings()
    base, seen = observed_base_table(base_table(tables, settings.valid_statuses))
    write_bucketed_base_table(base, path)
    return seen.get


def training_table(
    orders: DataFrame, cutoff: datetime | str, settings: Settings, counts: DataFrame | None = None
) -> tuple[DataFrame, dict[str, object]]:
    """Targets, split, tiers and features of every customer known before the cutoff, made durable, and a report on them.

    The targets are stored in buckets by customer. Split and tiers are decided row by row from looked-up edges, so over a
    base table bucketed alike targets and features join where they lie; only the narrow state lookup, after the join,
    moves rows. The report is observed while the two tables are written.
    """
    buckets = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known, seen = observed_targets(targets.customer_targets(orders, cutoff, settings.horizon_days, first_order=True))
    found = bucketed(known, CUSTOMER, [CUSTOMER], buckets)
    split = found.withColumn("split", ordering.chronological_cut(found, settings.train_fraction))
    fitted_on = split.filter("split = 'train'") if settings.tiers_from == "train" else split
    tiered = targets.with_spend_tier(split, targets.tier_edges(fitted_on))
    numbers = feats.feature_numbers(orders, cutoff, windows=settings.lookback_days)
    whole = feats.with_state_frequency(tiered.join(numbers, CUSTOMER, "left"), counts)
    reported, sides = observed_split(whole)
    return durable(reported), {**seen.get, **sides.get}


def scored_stage1(model, rows: DataFrame, used: list[str]) -> DataFrame:
    scored = model.transform(aligned(rows, used, [CUSTOMER, "will_return"]))
    return scored.select(CUSTOMER, F.col("will_return").alias("label"), positive_probability("s1").alias("score"))


def validation_threshold(train: DataFrame, used: list[str], params: TreeParams, settings: Settings) -> float:
    """Best F-beta threshold on the newest training customers, scored by a model of the earlier ones."""
    placed = ordering.global_running(train, ["first_order_date", CUSTOMER])
    early = F.col("position") < F.floor(F.col("total_rows") * F.lit(1 - settings.validation_fraction))
    model = train_model(placed.filter(early), used, "will_return", params)
    scored = scored_stage1(model, placed.filter(~early), used)
    return metrics.f_beta_threshold(scored, settings.beta).first()["threshold"]


def train_two_stage(
    orders: DataFrame, cutoff: datetime | str, settings: Settings | None = None, feature_cache: str | None = None
) -> Trained:
    """Select, tune, fit and evaluate both stages, side by side.

    Stage 1 predicts whether a customer returns, from all training customers; stage 2 predicts the spend tier and
    learns from returners only.
    """
    settings = settings or Settings()
    counts = training_counts(orders, cutoff)
    table, report = training_table(orders, cutoff, settings, counts)
    train, test = table.filter("split = 'train'"), table.filter("split = 'test'")
    candidates = [c for c in FEATURES if c in table.columns] + [
        c for c in table.columns if c.startswith(("orders_last_", "spend_last_")) and c not in FEATURES
    ]
    scout = TreeParams(settings.scout_trees, settings.scout_depth, settings.scout_step_size, seed=settings.seed)
    search = {"trials": settings.trials, "seed": settings.seed, "space": settings.space, "parallelism": settings.parallelism}
    spark = orders.sparkSession

    def returns() -> _Stage:
        prepared, dropped = prepare_data(train, candidates, settings.drop_missing_above)
        kept = [c for c in candidates if c not in dropped]
        used = select_features(
            prepared, kept, "will_return", settings.stage1_top_n, scout, stage="stage1", cache_path=feature_cache
        )
        params, trials = tune_model(train, used, "will_return", "binary", folds=settings.stage1_folds, **search)
        fits = [lambda: train_model(train, used, "will_return", params)]
        if settings.threshold_on != "test":
            fits.append(lambda: validation_threshold(train, used, params, settings))
        model, *threshold = at_once(spark, fits)
        found = metrics.binary_report(scored_stage1(model, test, used), *(threshold or [None]), settings.beta).first()
        return _Stage(model, used, dropped, params, trials, found.asDict())

    def tiers() -> _Stage:
        returners, returners_test = train.filter("will_return = 1"), test.filter("will_return = 1")
        prepared, dropped = prepare_data(returners, candidates, settings.drop_missing_above)
        kept = [c for c in candidates if c not in dropped]
        used = select_features(
            prepared, kept, "spend_tier", settings.stage2_top_n, scout, 3, stage="stage2", cache_path=feature_cache
        )
        params, trials = tune_model(returners, used, "spend_tier", "multi", folds=settings.stage2_folds, **search)
        model = train_model(returners, used, "spend_tier", params, "multi", "s2")
        called = model.transform(aligned(returners_test, used, ["spend_tier"])).select(
            F.col("spend_tier").alias("label"), predicted_class("s2").alias("prediction")
        )
        return _Stage(model, used, dropped, params, trials, metrics.tier_report(called).first().asDict())

    one, two = at_once(spark, [returns, tiers])
    artifact = Artifact(one.model, two.model, one.used, two.used, one.report["threshold"], counts)
    return Trained(
        artifact=artifact,
        params={
            "cutoff_date": str(cutoff),
            "horizon_days": settings.horizon_days,
            "train_frac": settings.train_fraction,
            "n_trials": settings.trials,
            "cv_folds": settings.stage1_folds,
            "stage1_top_n": len(one.used),
            "stage2_top_n": len(two.used),
            **report,
            "s1_dropped": ",".join(one.dropped),
            "s2_dropped": ",".join(two.dropped),
            **{f"s1_{name}": value for name, value in asdict(one.params).items()},
            **{f"s2_{name}": value for name, value in asdict(two.params).items()},
        },
        metrics={
            **{f"s1_{name}": value for name, value in one.report.items()},
            **{f"s2_{name}": value for name, value in two.report.items()},
        },
        trials1=one.trials,
        trials2=two.trials,
    )
