"""The registered queries over the test tables. Results are rounded for comparison; the operators are not."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import shared_folder
from tidemark.operators import base_table as base
from tidemark.operators import attribution, features, metrics, modeling, ordering, profile, requests, targets
from tidemark.plans import scoring, training
from tidemark.plans.artifact import Artifact
from tidemark.settings import FEATURES, SearchSpace, Settings
from tidemark.sources.commerce import commerce_tables, star_table

CUTOFF = "2001-01-01"
HORIZON_DAYS = 90
CUSTOMER = "customer_unique_id"

Query = Callable[[SparkSession, str], DataFrame]


def tidy(df: DataFrame) -> DataFrame:
    """Round doubles to six places, a little off the half so that both engines round the same way."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(F.col(name) + F.lit(1e-9), 6) for name in doubles}) if doubles else df


def base_rows(spark: SparkSession, folder: str) -> DataFrame:
    return base.base_table(commerce_tables(spark, folder))


def orders_valid_status(spark: SparkSession, folder: str) -> DataFrame:
    tables = commerce_tables(spark, folder)
    return base.with_customer(base.orders_with_status(tables.orders), tables.customers)


def items_per_order(spark: SparkSession, folder: str) -> DataFrame:
    tables = commerce_tables(spark, folder)
    return tidy(base.items_per_order(tables.order_items, tables.products, tables.category))


def payments_per_order(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(base.payments_per_order(commerce_tables(spark, folder).payments))


def latest_review_per_order(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(base.latest_review_per_order(commerce_tables(spark, folder).reviews))


def base_table(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(base_rows(spark, folder))


def rfm_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(features.rfm_features(base_rows(spark, folder), CUTOFF))


def behavioral_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(features.behavioral_features(base_rows(spark, folder), CUTOFF))


def temporal_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(features.temporal_features(base_rows(spark, folder), CUTOFF))


def delivery_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(features.delivery_features(base_rows(spark, folder), CUTOFF))


def state_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return features.state_frequency(features.history(base_rows(spark, folder), CUTOFF))


def state_counts(spark: SparkSession, folder: str) -> DataFrame:
    return features.state_counts(features.latest_state(features.history(base_rows(spark, folder), CUTOFF)))


def feature_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(features.feature_matrix(base_rows(spark, folder), CUTOFF))


def target_rows(known: DataFrame) -> DataFrame:
    return targets.customer_targets(known, CUTOFF, HORIZON_DAYS)


def tiered_rows(known: DataFrame) -> DataFrame:
    found = target_rows(known)
    return targets.with_spend_tier(found, targets.tier_edges(found))


def customer_targets(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(target_rows(base_rows(spark, folder)))


def spend_tiers(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(tiered_rows(base_rows(spark, folder)))


def tier_counts(spark: SparkSession, folder: str) -> DataFrame:
    return targets.tier_counts(tiered_rows(base_rows(spark, folder)))


def split_rows(known: DataFrame) -> DataFrame:
    return ordering.chronological_split(target_rows(known), known)


def chronological_split(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(split_rows(base_rows(spark, folder)))


def train_test_features(spark: SparkSession, folder: str) -> DataFrame:
    """Split customers joined with their features, as the models see them."""
    known = base_rows(spark, folder)
    split = ordering.chronological_split(targets.customer_targets(known, CUTOFF, HORIZON_DAYS, first_order=True))
    return tidy(split.join(features.feature_matrix(known, CUTOFF), CUSTOMER, "left"))


def time_series_folds(spark: SparkSession, folder: str) -> DataFrame:
    dated = ordering.first_orders(base_rows(spark, folder))
    return ordering.time_series_folds(dated, ["first_order_date", CUSTOMER])


def _returners(known: DataFrame) -> DataFrame:
    return tiered_rows(known).filter("will_return = 1")


def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(ordering.stratified_folds(_returners(base_rows(spark, folder)), "spend_tier", CUSTOMER, folds=3))


def stratified_fold_sizes(spark: SparkSession, folder: str) -> DataFrame:
    dealt = ordering.stratified_folds(_returners(base_rows(spark, folder)), "spend_tier", CUSTOMER, folds=3)
    return dealt.groupBy("spend_tier", "fold").agg(F.count(F.lit(1)).alias("customers"))


def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    matrix = features.feature_matrix(base_rows(spark, folder), CUTOFF)
    return tidy(profile.column_profile(matrix, FEATURES).drop("position"))


def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(profile.class_balance(target_rows(base_rows(spark, folder))))


def scored_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their label and a score computed from two features instead of a model."""
    known = base_rows(spark, folder)
    rfm = features.rfm_features(known, CUTOFF).select(CUSTOMER, "recency", "frequency")
    labelled = target_rows(known).join(rfm, CUSTOMER)
    return labelled.select(
        CUSTOMER, F.col("will_return").alias("label"), (F.col("frequency") / (F.col("recency") + 30)).alias("score")
    )


def precision_recall_curve(spark: SparkSession, folder: str) -> DataFrame:
    curve = metrics.score_curve(scored_rows(spark, folder))
    return curve.select(
        F.round(F.col("threshold") + 1e-12, 9).alias("threshold"),
        F.round(F.col("running_positives") / F.col("running_cases") + 1e-9, 6).alias("precision"),
        F.round(F.col("running_positives") / F.col("total_positives") + 1e-9, 6).alias("recall"),
    )


def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(metrics.average_precision(scored_rows(spark, folder)))


def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(metrics.roc_auc(scored_rows(spark, folder)))


def f_beta_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(metrics.f_beta_threshold(scored_rows(spark, folder)))


def binary_report(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.binary_report(scored_rows(spark, folder))


def predicted_tiers(spark: SparkSession, folder: str) -> DataFrame:
    """Returners with their tier and a tier guessed from a feature instead of a model."""
    known = base_rows(spark, folder)
    rfm = features.rfm_features(known, CUTOFF).select(CUSTOMER, "frequency")
    guessed = (F.col("frequency") % 3).cast("int").alias("prediction")
    return _returners(known).join(rfm, CUSTOMER).select(CUSTOMER, F.col("spend_tier").alias("label"), guessed)


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(predicted_tiers(spark, folder))


def tier_report(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.tier_report(predicted_tiers(spark, folder))


def request_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One scoring request per order row: that order, for even keys an earlier one too, some of them broken."""
    key, placed, total = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_totalprice")

    def days(count: int | F.Column, hours: F.Column | None = None) -> F.Column:
        return F.make_dt_interval(
            F.lit(count) if isinstance(count, int) else count.cast("int"),
            F.lit(0) if hours is None else hours.cast("int"),
        )

    newest = F.struct(
        key.cast("string").alias("order_id"),
        F.when(key % 67 != 0, placed + days(0, key % 24)).alias("order_purchase_timestamp"),
        F.when(key % 53 == 0, -10.0).otherwise(total).alias("payment_value"),
        F.when(key % 59 == 0, 0).otherwise(1 + key % 10).cast("int").alias("payment_installments"),
        (1 + key % 4).cast("int").alias("order_item_count"),
        (total * 0.1).alias("freight_value"),
        F.when(key % 61 == 0, 6.0).when(key % 3 != 0, (1 + key % 5).cast("double")).alias("review_score"),
        F.when(key % 5 != 0, F.concat(F.lit("S"), (F.col("o_custkey") % 27).cast("string"))).alias("customer_state"),
        F.when(key % 37 != 0, placed + days(1 + key % 29, key % 23)).alias("order_delivered_customer_date"),
        (placed + days(20)).alias("order_estimated_delivery_date"),
    )
    earlier = F.struct(
        F.concat(key.cast("string"), F.lit("b")).alias("order_id"),
        (placed - days(45)).alias("order_purchase_timestamp"),
        (total * 0.5).alias("payment_value"),
        F.lit(1).alias("payment_installments"),
        F.lit(1).alias("order_item_count"),
        (total * 0.05).alias("freight_value"),
        F.lit(4.0).alias("review_score"),
        F.lit("S1").alias("customer_state"),
        (placed - days(25)).alias("order_delivered_customer_date"),
        (placed - days(30)).alias("order_estimated_delivery_date"),
    )
    held = F.when(key % 71 == 0, 0).when(key % 2 == 0, 2).otherwise(1)
    orders = F.slice(F.array(newest, earlier), F.lit(1), held)
    return star_table(spark, folder, "orders").select(
        key.cast("string").alias("request_id"),
        F.col("o_custkey").cast("string").alias("customer_unique_id"),
        F.when(key % 43 == 0, placed - days(100)).otherwise(placed + days(30)).alias("cutoff_date"),
        orders.alias("orders"),
    )


def validate_requests(spark: SparkSession, folder: str) -> DataFrame:
    checked = requests.validate_requests(request_rows(spark, folder))
    return checked.select(*requests.REQUEST_KEYS, F.array_join("violations", ",").alias("violations"))


def valid_request_rows(spark: SparkSession, folder: str) -> DataFrame:
    return requests.valid_requests(request_rows(spark, folder))


def rejected_requests(spark: SparkSession, folder: str) -> DataFrame:
    rejected = requests.rejected_requests(request_rows(spark, folder))
    return rejected.withColumn("violations", F.array_join("violations", ","))


def requests_to_orders(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(requests.requests_to_orders(valid_request_rows(spark, folder)))


def request_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(requests.request_features(valid_request_rows(spark, folder)))


SQL_CHECKED: dict[str, Query] = {
    query.__name__: query
    for query in (
        orders_valid_status,
        items_per_order,
        payments_per_order,
        latest_review_per_order,
        base_table,
        rfm_features,
        behavioral_features,
        temporal_features,
        delivery_features,
        state_frequency,
        state_counts,
        feature_matrix,
        customer_targets,
        spend_tiers,
        tier_counts,
        chronological_split,
        train_test_features,
        time_series_folds,
        stratified_folds,
        stratified_fold_sizes,
        column_profile,
        class_balance,
        precision_recall_curve,
        average_precision,
        roc_auc,
        f_beta_threshold,
        binary_report,
        confusion,
        tier_report,
        validate_requests,
        rejected_requests,
        requests_to_orders,
        request_features,
    )
}


# The queries below fit models, which no SQL engine can repeat. Nothing of the search is cut: rows, trials, trees, folds,
# depths, rates and scouts are those of ``Settings``, and every trial draws all its parameters.
SEARCH = Settings(parallelism=16)


def model_rows(known: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    return training.training_table(known, CUTOFF, SEARCH, counts)[0]


_TRAINED: dict[tuple[str, str], str] = {}


def trained_folder(spark: SparkSession, folder: str) -> str:
    """Where the two-stage model of the test tables is stored, trained once per application: base, artifact, metrics, trials."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _TRAINED:
        path = shared_folder(spark, "trained")
        made = base_rows(spark, folder)
        made.write.parquet(f"{path}/base")
        known = spark.read.schema(made.schema).parquet(f"{path}/base")
        trained = training.train_two_stage(known, CUTOFF, SEARCH, feature_cache=f"{path}/selected")
        trained.artifact.save(f"{path}/artifact")
        rows = sorted(trained.metrics.items())
        spark.createDataFrame(rows, "metric string, value double").coalesce(1).write.parquet(f"{path}/metrics")
        trials = [t.withColumn("stage", F.lit(i)) for i, t in enumerate((trained.trials1, trained.trials2), start=1)]
        trials[0].unionByName(trials[1]).coalesce(1).write.parquet(f"{path}/trials")
        _TRAINED[key] = path
    return _TRAINED[key]


def trained_base(spark: SparkSession, folder: str) -> DataFrame:
    """The base table that the model was trained on, as it was stored then."""
    return spark.read.parquet(f"{trained_folder(spark, folder)}/base")


def stored_artifact(spark: SparkSession, folder: str) -> Artifact:
    """The trained artifact, as it was saved and is loaded."""
    return Artifact.load(spark, f"{trained_folder(spark, folder)}/artifact")


def select_features(spark: SparkSession, folder: str) -> DataFrame:
    train = model_rows(base_rows(spark, folder)).filter("split = 'train'")
    settings = Settings()
    scout = modeling.TreeParams(settings.scout_trees, settings.scout_depth, settings.scout_step_size)
    return attribution.rank_features(train, FEATURES, "will_return", settings.stage1_top_n, scout)


def tune_model(spark: SparkSession, folder: str) -> DataFrame:
    """The trials of both stages' searches."""
    return spark.read.parquet(f"{trained_folder(spark, folder)}/trials").drop("fit_seconds")


def train_two_stage(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{trained_folder(spark, folder)}/metrics")


def score_customers(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score_customers(trained_base(spark, folder), CUTOFF, stored_artifact(spark, folder))


def score_requests(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score_requests(request_rows(spark, folder), stored_artifact(spark, folder))[0]


ROWS_ONLY: dict[str, Query] = {
    query.__name__: query
    for query in (select_features, tune_model, train_two_stage, score_customers, score_requests)
}
