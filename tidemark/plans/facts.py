"""Registered queries about stages that SQL cannot repeat: what holds of their results can still be stated in SQL."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import durable, shared_folder
from tidemark.operators import attribution, base_table, features, metrics, modeling, ordering, profile, targets
from tidemark.plans import queries, reporting, scoring, training
from tidemark.plans.artifact import log_run
from tidemark.plans.queries import CUSTOMER, CUTOFF, Query, tidy
from tidemark.settings import FEATURES, TIER_LABELS, Settings
from tidemark.sources import (
    read_base_table,
    read_bucketed_base_table,
    read_csv_tables,
    read_requests,
    write_base_table,
    write_bucketed_base_table,
)
from tidemark.sources.commerce import commerce_tables
from tidemark.streaming import read_stream_output, request_stream, score_stream

# A feature that no table has, between features in another order than the matrix has them
ALIGNED = ("recency", "not_a_feature", "has_voucher", "monetary", "avg_order_gap_days")


def csv_base_table(spark: SparkSession, folder: str) -> DataFrame:
    """The base table from CSV files that were written from the test tables."""
    tables, path = commerce_tables(spark, folder), shared_folder(spark, "csv")
    written = ("orders", "order_items", "payments", "reviews", "customers", "products", "category")
    for name in written:
        getattr(tables, name).write.option("header", True).option("escape", '"').csv(f"{path}/{name}")
    sellers = tables.order_items.select("seller_id").distinct()
    sellers.write.option("header", True).csv(f"{path}/sellers")
    found = base_table.base_table(read_csv_tables(spark, path, {name: name for name in (*written, "sellers")}))
    return tidy(found.select(queries.base_rows(spark, folder).columns))


def base_table_months(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and spend per month of the stored base table, read up to the cutoff."""
    path = shared_folder(spark, "base")
    write_base_table(queries.base_rows(spark, folder), path)
    by_month = read_base_table(spark, path, CUTOFF).groupBy(F.date_format("purchase_month", "yyyy-MM-dd").alias("month"))
    return tidy(by_month.agg(F.count("order_id").alias("orders"), F.sum("payment_value").alias("spend")))


def base_table_report(spark: SparkSession, folder: str) -> DataFrame:
    return reporting.base_table_report(queries.base_rows(spark, folder))


def split_report(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(reporting.split_report(queries.split_rows(queries.base_rows(spark, folder))))


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics of a logged run, read back from the run table."""
    path = f"{shared_folder(spark, 'log')}/runs"
    report = metrics.binary_report(queries.scored_rows(spark, folder)).first().asDict()
    log_run(spark, path, "report", {"cutoff": CUTOFF}, report)
    return spark.read.parquet(path).select("run_name", F.explode("metrics").alias("metric", "value"))


def dropped_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of the base table that are not worth training on."""
    base = durable(queries.base_rows(spark, folder))
    _, dropped = profile.prepare_data(base, base.columns)
    return spark.createDataFrame([(name,) for name in dropped], "column string")


def aligned_features(spark: SparkSession, folder: str) -> DataFrame:
    matrix = features.feature_matrix(queries.base_rows(spark, folder), CUTOFF)
    return tidy(modeling.aligned(matrix, ALIGNED, [CUSTOMER]))


def customer_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of all customers for a probability and a tier computed from their id instead of a model."""
    found = queries.target_rows(queries.base_rows(spark, folder))
    probability = F.pmod(CUSTOMER, F.lit(1000)) / 1000
    tier = F.pmod(CUSTOMER, F.lit(3)).cast("int")
    return found.select(CUSTOMER, scoring.segment(probability, tier, 0.5, TIER_LABELS).alias("customer_segment"))


def shapley_additivity(spark: SparkSession, folder: str) -> DataFrame:
    """Training customers, and those whose Shapley values do not add up to margin minus expectation, for a full scout."""
    known = durable(queries.base_rows(spark, folder))
    found = targets.customer_targets(known, CUTOFF)
    matrix = features.feature_matrix(known, CUTOFF)
    rows = durable(modeling.aligned(found.join(matrix, CUSTOMER), FEATURES, ["will_return"]))
    encoded = Pipeline(stages=modeling.encoder_stages(rows, FEATURES, "scout")).fit(rows).transform(rows)
    settings = Settings()
    scout = modeling.TreeParams(settings.scout_trees, settings.scout_depth, settings.scout_step_size)
    model = modeling.boosted_trees(scout, "will_return", "scout").fit(encoded)
    return attribution.additivity(model.transform(encoded), "scout_features", "scout_raw", model)


def feature_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Per stage, how many features training stored, and whether a second selection reads back just those of the model."""
    path, artifact = queries.trained_folder(spark, folder), queries.stored_artifact(spark, folder)
    nothing = spark.range(0).withColumn("label", F.lit(0))
    rows = []
    for stage, used in (("stage1", artifact.stage1_features), ("stage2", artifact.stage2_features)):
        again = attribution.select_features(nothing, [], "label", stage=stage, cache_path=f"{path}/selected")
        rows.append((stage, len(again), again == used))
    return spark.createDataFrame(rows, "stage string, features int, same_as_model boolean")


def bucketed_features(spark: SparkSession, folder: str) -> DataFrame:
    """``train_test_features`` from a base table that was stored in buckets by customer."""
    path = shared_folder(spark, "by-customer")
    write_bucketed_base_table(queries.base_rows(spark, folder), path)
    known = read_bucketed_base_table(spark, path)
    found = targets.customer_targets(known, CUTOFF, queries.HORIZON_DAYS, first_order=True)
    split = found.withColumn("split", ordering.chronological_cut(found))
    numbers = features.feature_numbers(known, CUTOFF)
    return tidy(features.with_state_frequency(split.join(numbers, CUSTOMER, "left")))


def step_reports(spark: SparkSession, folder: str) -> DataFrame:
    """What training and the storing of the base table observed on their way, as numbers by name."""
    path = shared_folder(spark, "by-customer")
    stored = training.store_base_table(commerce_tables(spark, folder), path)
    _, trained = training.training_table(read_bucketed_base_table(spark, path), CUTOFF, Settings())
    said = {"orders": stored["rows"], "without_customer": stored["without_customer"]}
    said |= {name: trained[name] for name in ("returners", "return_rate", "train_customers", "test_customers")}
    said |= {name: trained[name] for name in ("train_return_rate", "test_return_rate")}
    return tidy(spark.createDataFrame([(k, float(v)) for k, v in said.items()], "fact string, value double"))


def scored_grain(spark: SparkSession, folder: str) -> DataFrame:
    """Responses, distinct askers, and responses with an impossible probability or segment, by kind."""
    artifact = queries.stored_artifact(spark, folder)
    customers = scoring.score_customers(queries.trained_base(spark, folder), CUTOFF, artifact)
    requests = scoring.score_requests(queries.request_rows(spark, folder), artifact)[0]
    return _grain(customers, "customers", CUSTOMER).unionByName(_grain(requests, "requests", "request_id"))


def _grain(scored: DataFrame, kind: str, key: str) -> DataFrame:
    possible = F.col("will_return_probability").between(0, 1)
    below = F.col("will_return_probability").isNull() | F.col("customer_segment").isNull()
    return scored.agg(
        F.lit(kind).alias("kind"),
        F.count(F.lit(1)).alias("responses"),
        F.count_distinct(key).alias("askers"),
        F.count_if(~possible).alias("impossible"),
        F.count_if(below).alias("missing"),
    )


def scored_from_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Responses by kind, and those that differ from a walk through the exported nodes of the model.

    The nodes are data of their own, so probability, class and segment are computed a second time without Spark's models.
    """
    artifact = queries.stored_artifact(spark, folder)
    known = queries.trained_base(spark, folder)
    customers = features.feature_matrix(known, CUTOFF, counts=artifact.state_counts)
    asked = queries.requests.request_features(queries.valid_request_rows(spark, folder), artifact.state_counts)
    return _differing(
        "customers", scoring.score_customers(known, CUTOFF, artifact), scoring.scores_from_nodes(customers, artifact, [CUSTOMER]), [CUSTOMER]
    ).unionByName(
        _differing(
            "requests",
            scoring.score_requests(queries.request_rows(spark, folder), artifact)[0],
            scoring.scores_from_nodes(asked, artifact, queries.requests.REQUEST_KEYS),
            queries.requests.REQUEST_KEYS,
        )
    )


def _differing(kind: str, one: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``one``, and how many have no equal in ``other`` (probabilities within a ten-thousandth)."""
    renamed = other.withColumnsRenamed({"will_return_probability": "_p", "customer_segment": "_s"})
    same = (F.abs(F.col("will_return_probability") - F.col("_p")) <= 1.00001e-4) & (F.col("customer_segment") == F.col("_s"))
    both = one.join(renamed, list(keys), "left")
    return both.agg(
        F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("responses"), F.count_if(~F.coalesce(same, F.lit(False))).alias("different")
    )


def _streamed(spark: SparkSession, folder: str) -> str:
    """Where a stream put what it made of the requests, which it reads from JSON files to their end."""
    asked, sink, state = (shared_folder(spark, kind) for kind in ("asked", "sink", "state"))
    queries.request_rows(spark, folder).write.mode("overwrite").json(asked)
    writer = score_stream(request_stream(spark, asked), queries.stored_artifact(spark, folder), sink, state)
    writer.trigger(availableNow=True).start().awaitTermination()
    return sink


def stream_rejections(spark: SparkSession, folder: str) -> DataFrame:
    """Requests that the stream rejects."""
    rejected = read_stream_output(spark, _streamed(spark, folder), "rejected").drop("batch")
    return rejected.withColumn("violations", F.array_join("violations", ","))


def stream_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Responses of the stream, and those that differ from batch scoring with the same artifact."""
    streamed = read_stream_output(spark, _streamed(spark, folder), "scored").drop("batch")
    batch = scoring.score_requests(queries.request_rows(spark, folder), queries.stored_artifact(spark, folder))[0]
    return _differing("streamed", streamed, batch, queries.requests.REQUEST_KEYS)


def json_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests written as JSON, read back and validated."""
    path = shared_folder(spark, "requests")
    queries.request_rows(spark, folder).write.mode("overwrite").json(path)
    checked = queries.requests.validate_requests(read_requests(spark, path))
    return checked.select(*queries.requests.REQUEST_KEYS, F.array_join("violations", ",").alias("violations"))


FACTS: dict[str, Query] = {
    query.__name__: query
    for query in (
        csv_base_table,
        base_table_months,
        base_table_report,
        split_report,
        run_log,
        dropped_columns,
        aligned_features,
        customer_segments,
        shapley_additivity,
        feature_cache,
        bucketed_features,
        step_reports,
        scored_grain,
        scored_from_nodes,
        stream_rejections,
        stream_scores,
        json_requests,
    )
}
