import random
import threading
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from fixtures import request
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import attribution, modeling
from tidemark.operators.modeling import TreeParams
from tidemark.plans.artifact import Artifact, log_run
from tidemark.plans.scoring import score_customers, score_requests
from tidemark.plans.training import train_two_stage
from tidemark.settings import FEATURES, SearchSpace, Settings
from tidemark.sources.schemas import REQUEST_SCHEMA
from tidemark.streaming import read_stream_output, request_stream, score_stream

SMALL = TreeParams(trees=3, depth=3, step_size=0.3)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    made = []
    for i in range(400):
        a, b, c = rng.random(), rng.random(), rng.random()
        label = int(a + 0.3 * b + 0.1 * rng.random() > 0.9)
        made.append((i, a, None if rng.random() < 0.2 else b, c, label, int(3 * a)))
    return spark.createDataFrame(made, "id int, a double, b double, c double, label int, tier int").cache()


def test_alignment_adds_missing_features(rows):
    found = modeling.aligned(rows, ["c", "unknown"], ["id"])
    assert found.columns == ["id", "c", "unknown"]
    assert found.filter("unknown IS NOT NULL").count() == 0


def test_encoder_fills_medians_and_flags(rows):
    stages = modeling.encoder_stages(rows, ["a", "b"], "x")
    encoded = Pipeline(stages=stages).fit(rows).transform(rows)
    median = rows.agg(F.percentile_approx("b", 0.5, 10_000)).first()[0]
    for row in encoded.select("a", "b", vector_to_array("x_features").alias("v")).collect():
        assert row["v"] == [row["a"], median if row["b"] is None else row["b"], 0.0, float(row["b"] is None)]


def test_binary_model_separates(rows):
    model = modeling.train_model(rows, ["a", "b", "c"], "label", SMALL)
    scored = model.transform(modeling.aligned(rows, ["a", "b", "c"], ["label"])).select("label", modeling.positive_probability().alias("p"))
    means = {r["label"]: r["p"] for r in scored.groupBy("label").agg(F.avg("p").alias("p")).collect()}
    assert 0 <= means[0] < means[1] <= 1


def test_multi_model_predicts_classes(rows):
    model = modeling.train_model(rows, ["a", "b", "c"], "tier", SMALL, "multi", "s2")
    called = model.transform(modeling.aligned(rows, ["a", "b", "c"], ["tier"])).select("tier", modeling.predicted_class().alias("p"))
    assert called.filter("tier = p").count() > 380
    assert {r["p"] for r in called.select("p").distinct().collect()} == {0, 1, 2}


def test_search_is_seeded_and_within_bounds():
    space = SearchSpace()
    drawn = [modeling.random_params(space, random.Random(1), 42) for _ in range(2)]
    assert drawn[0] == drawn[1]
    rng = random.Random(3)
    for params in (modeling.random_params(space, rng, 42) for _ in range(200)):
        assert 100 <= params.trees <= 500 and 3 <= params.depth <= 7 and 0.01 <= params.step_size <= 0.3
        assert 0.6 <= params.row_fraction <= 1 and 0.6 <= params.column_fraction <= 1 and 1 <= params.min_leaf_rows <= 10


def test_tuning_skips_folds_without_positives(spark):
    df = spark.range(60).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") >= 35).cast("int").alias("label"))
    best, trials = modeling.tune_model(
        df, ["x"], "label", trials=2, folds=5, order_by=["id"], space=SearchSpace(trees=(1, 2), depth=(3, 3))
    )
    found = trials.collect()
    assert len(found) == 2
    assert {r["skipped_folds"] for r in found} == {3}  # folds 1, 2 train and 3 trains without positives
    chosen = [r for r in found if r["is_best"]]
    assert len(chosen) == 1 and chosen[0]["mean_score"] == max(r["mean_score"] for r in found)
    assert best.trees == chosen[0]["trees"]


def test_folds_are_encoded_side_by_side_and_leave_their_lineage(spark, rows, monkeypatch):
    together, encode, learned = threading.Barrier(3, timeout=60), modeling._encoded_fold, []

    def met(*args):
        together.wait()  # broken if a fold waits for another
        learned.append(encode(*args))
        return learned[-1]

    monkeypatch.setattr(modeling, "_encoded_fold", met)
    space = SearchSpace(trees=(1, 2), depth=(3, 3))
    modeling.tune_model(rows, ["a", "b"], "tier", "multi", trials=1, folds=3, order_by=["id"], space=space)
    assert len(learned) == 3
    for fitted, _ in learned:
        assert "LogicalRDD" in fitted._jdf.queryExecution().analyzed().toString()  # not the plan that made the rows


def test_tuning_without_usable_fold_is_an_error(spark):
    df = spark.range(12).select("id", F.lit(1.0).alias("x"), F.lit(0).alias("label"))
    with pytest.raises(ValueError, match="both classes"):
        modeling.tune_model(df, ["x"], "label", trials=1, folds=2, order_by=["id"])


def tree_value(nodes, point, known):
    """Expected value of a tree if only the ``known`` features are known, by walking it."""

    def walk(node):
        if node["left"] < 0:
            return node["value"]
        left, right = nodes[node["left"]], nodes[node["right"]]
        if node["feature"] in known:
            return walk(left if point[node["feature"]] <= node["threshold"] else right)
        return (walk(left) * left["cover"] + walk(right) * right["cover"]) / node["cover"]

    return walk(nodes[0])


def test_shapley_values_equal_brute_force(rows):
    stages = modeling.encoder_stages(rows, ["a", "b", "c"], "x")
    encoded = Pipeline(stages=stages).fit(rows).transform(rows)
    model = modeling.boosted_trees(TreeParams(trees=4, depth=4), "label", "x").fit(encoded)
    nodes = attribution.tree_nodes(model).collect()
    leaves = attribution._leaf_tables(nodes, model.treeWeights)
    points = np.array([r["v"] for r in encoded.select(vector_to_array("x_features").alias("v")).limit(20).collect()])
    found = attribution.shapley_values(points, leaves)
    trees = {}
    for n in nodes:
        trees.setdefault(n["tree"], {})[n["id"]] = n
    width = points.shape[1]

    def game(point, known):
        return sum(model.treeWeights[t] * tree_value(members, point, known) for t, members in trees.items())

    for point, values in zip(points, found, strict=True):
        for target in range(width):
            others = [i for i in range(width) if i != target]
            expected = sum(
                factorial(size) * factorial(width - size - 1) / factorial(width) * (game(point, {*s, target}) - game(point, set(s)))
                for size in range(width)
                for s in combinations(others, size)
            )
            assert values[target] == pytest.approx(expected, abs=1e-12)
    margins = [r["m"] for r in model.transform(encoded).select(vector_to_array("x_raw")[1].alias("m")).limit(20).collect()]
    # the values and the expectation of the model add up to its raw margin
    assert found.sum(axis=1) + game(points[0], set()) == pytest.approx(margins)


def test_ranking_finds_what_matters_and_is_cached(spark, rows, tmp_path):
    path = f"{tmp_path}/selected"
    ranked = attribution.rank_features(rows, ["c", "b", "a"], "label", 2, SMALL).collect()
    assert [r["feature"] for r in ranked][0] == "a"
    assert len(ranked) == 2 and ranked[0]["score"] > ranked[1]["score"] > 0
    chosen = attribution.select_features(rows, ["c", "b", "a"], "label", 2, SMALL, cache_path=path)
    assert attribution.select_features(rows.limit(0), ["c"], "label", cache_path=path) == chosen
    tiers = attribution.select_features(rows, ["a", "b", "c"], "tier", 1, SMALL, 3, stage="stage2", cache_path=path)
    assert tiers == ["a"]


@pytest.fixture(scope="module")
def artifact(spark):
    """Models of all-zero rows, as good as a fixed low probability."""
    zero = spark.range(10).select("id", *[F.lit(0.0).alias(name) for name in FEATURES])
    stage1 = modeling.train_model(zero.withColumn("y", (F.col("id") == 9).cast("int")), FEATURES, "y", TreeParams(1, 1))
    stage2 = modeling.train_model(zero.withColumn("y", (F.col("id") % 3).cast("int")), FEATURES, "y", TreeParams(1, 1), "multi", "s2")
    counts = spark.createDataFrame([("SP", 10)], "customer_state string, customer_state_freq bigint")
    return Artifact(stage1, stage2, list(FEATURES), list(FEATURES), 0.9, counts)


@pytest.fixture(scope="module")
def asked(spark):
    made = [
        request("r1", {}, customer="u1"),
        request("r2", {}, {"order_id": "second"}, customer="u2"),
        request("bad", {"review_score": 6.0}),
        request("none"),
    ]
    return spark.createDataFrame(made, REQUEST_SCHEMA)


def test_scored_requests(asked, artifact):
    scored, rejected = score_requests(asked, artifact)
    assert dict(scored.dtypes) == {
        "request_id": "string",
        "customer_unique_id": "string",
        "cutoff_date": "timestamp_ntz",
        "will_return_probability": "double",
        "customer_segment": "string",
    }
    found = {r["request_id"]: r for r in scored.collect()}
    assert set(found) == {"r1", "r2"}
    assert found["r1"]["customer_unique_id"] == "u1"
    assert all(0 <= r["will_return_probability"] <= 1 for r in found.values())
    assert {r["customer_segment"] for r in found.values()} == {"Non-returner"}  # threshold 0.9
    assert {r["request_id"]: r["violations"] for r in rejected.collect()} == {"bad": ["review_score"], "none": ["orders"]}


def test_segments_above_the_threshold(asked, artifact):
    low = Artifact(artifact.stage1, artifact.stage2, artifact.stage1_features, artifact.stage2_features, 0.0)
    segments = {r["customer_segment"] for r in score_requests(asked, low, "recompute")[0].collect()}
    assert segments <= {"Low", "Mid", "High"} and segments


def test_artifact_round_trip(spark, asked, artifact, tmp_path):
    artifact.save(str(tmp_path))
    loaded = Artifact.load(spark, str(tmp_path))
    assert (loaded.threshold, loaded.stage1_features, loaded.tier_labels) == (0.9, list(FEATURES), {0: "Low", 1: "Mid", 2: "High"})
    assert loaded.state_counts.collect() == artifact.state_counts.collect()
    before, after = (sorted(score_requests(asked, a)[0].collect()) for a in (artifact, loaded))
    assert before == after


def test_stream_equals_batch(spark, asked, artifact, tmp_path):
    asked.filter("request_id <> 'r2'").write.json(f"{tmp_path}/in/one")
    asked.filter("request_id = 'r2'").write.json(f"{tmp_path}/in/two")
    stream = request_stream(spark, f"{tmp_path}/in/*", maxFilesPerTrigger="1")
    query = score_stream(stream, artifact, f"{tmp_path}/out", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    scored, rejected = score_requests(asked, artifact)
    streamed = spark.read.parquet(f"{tmp_path}/out/scored")
    assert sorted(streamed.drop("batch").collect()) == sorted(scored.collect())
    refused = spark.read.parquet(f"{tmp_path}/out/rejected").drop("batch")
    assert sorted(refused.collect()) == sorted(rejected.collect())


def test_a_batch_that_failed_between_its_outputs_is_not_read(spark, asked, artifact, tmp_path, monkeypatch):
    from tidemark.streaming import scoring

    asked.write.json(f"{tmp_path}/in")
    sink, state = f"{tmp_path}/out", f"{tmp_path}/state"

    def broken(requests, artifact):
        scored, _ = score_requests(requests, artifact)
        return scored, requests.select(F.raise_error(F.lit("lost")).alias("x"))

    def run():
        stream = request_stream(spark, f"{tmp_path}/in")
        score_stream(stream, artifact, sink, state).trigger(availableNow=True).start().awaitTermination()

    monkeypatch.setattr(scoring, "score_requests", broken)
    with pytest.raises(Exception, match="lost"):
        run()
    assert spark.read.parquet(f"{sink}/scored").count() == 2  # the first output is there, but no record of its batch
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_stream_output(spark, sink, "scored")
    monkeypatch.undo()
    run()
    scored, rejected = score_requests(asked, artifact)
    assert sorted(read_stream_output(spark, sink, "scored").drop("batch").collect()) == sorted(scored.collect())
    assert sorted(read_stream_output(spark, sink, "rejected").drop("batch").collect()) == sorted(rejected.collect())


def test_a_committed_batch_is_not_written_again(spark, asked, artifact, tmp_path):
    import os

    asked.write.json(f"{tmp_path}/in")

    def run(state):
        stream = request_stream(spark, f"{tmp_path}/in")
        writer = score_stream(stream, artifact, f"{tmp_path}/out", f"{tmp_path}/{state}")
        writer.trigger(availableNow=True).start().awaitTermination()

    run("state")
    written = {f: os.stat(f).st_mtime_ns for f in spark.read.parquet(f"{tmp_path}/out/scored").inputFiles() for f in [f.removeprefix("file://")]}
    for file in ("0", ".0.crc"):
        os.remove(f"{tmp_path}/state/commits/{file}")  # as if the query had been lost before it noted its progress
    run("state")
    assert {f: os.stat(f).st_mtime_ns for f in written} == written
    assert read_stream_output(spark, f"{tmp_path}/out", "scored").count() == 2
    with pytest.raises(Exception, match="another query"):
        run("other")  # a query of its own may not hide behind the batch numbers of the first


def test_run_log_appends(spark, tmp_path):
    path = f"{tmp_path}/runs"
    log_run(spark, path, "first", {"n_trials": 2}, {"s1_pr_auc": 0.5, "s1_recall": None})
    log_run(spark, path, "second", {"n_trials": 3}, {"s1_pr_auc": 0.6})
    found = {r["run_name"]: r for r in spark.read.parquet(path).collect()}
    assert found["first"]["params"] == {"n_trials": "2"}
    assert found["first"]["metrics"] == {"s1_pr_auc": 0.5}
    assert found["second"]["metrics"] == {"s1_pr_auc": 0.6}


def test_two_stage_training(spark, tmp_path):
    from tidemark.durable import durable
    from tidemark.plans.queries import CUTOFF, base_rows

    orders = durable(base_rows(spark, "/root/testdata/sf0.01"))
    settings = Settings(
        trials=1, stage1_folds=2, stage2_folds=2, scout_trees=2, space=SearchSpace(trees=(2, 2), depth=(3, 3)),
        stage1_top_n=6, stage2_top_n=4, tiers_from="train",
    )
    trained = train_two_stage(orders, CUTOFF, settings)
    assert len(trained.artifact.stage1_features) == 6 and len(trained.artifact.stage2_features) == 4
    assert set(trained.metrics) == {
        "s1_pr_auc", "s1_roc_auc", "s1_precision", "s1_recall", "s1_threshold",
        "s2_weighted_f1", "s2_f1_low", "s2_f1_mid", "s2_f1_high",
    }
    scored = score_customers(orders, CUTOFF, trained.artifact)
    assert scored.count() == 744
    assert {r[0] for r in scored.select("customer_segment").distinct().collect()} <= {"Non-returner", "Low", "Mid", "High"}


def test_scoring_reads_the_base_table_of_the_training(spark, monkeypatch):
    from tidemark.plans import facts, queries

    read, base = [], queries.base_rows
    space = SearchSpace(trees=(2, 2), depth=(3, 3))
    monkeypatch.setattr(queries, "SEARCH", Settings(trials=1, stage1_folds=2, stage2_folds=2, scout_trees=2, space=space))
    monkeypatch.setattr(queries, "_TRAINED", {})
    monkeypatch.setattr(queries, "base_rows", lambda *where: read.append(where) or base(*where))
    found = facts.scored_from_nodes(spark, "/root/testdata/sf0.001").collect()
    assert all(r["responses"] > 0 and r["different"] == 0 for r in found)
    assert len(read) == 1


def test_rows_are_spread_for_heavy_steps(spark):
    few = spark.range(100).coalesce(1)
    assert modeling.spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(modeling.spread(few).collect()) == sorted(few.collect())


def test_additivity_makes_the_base_table_once(spark, monkeypatch):
    from tidemark.plans import facts, queries

    read, base = [], queries.base_rows
    monkeypatch.setattr(queries, "base_rows", lambda *where: read.append(where) or base(*where))
    monkeypatch.setattr(facts, "Settings", lambda: Settings(scout_trees=2))
    found = facts.shapley_additivity(spark, "/root/testdata/sf0.001").first()
    assert found["rows"] > 0 and found["violations"] == 0
    assert len(read) == 1


@pytest.mark.parametrize("rows, most, tasks", [(50, 1_000, 1), (1_000_000, 1_000_000, "cores"), (1_000, 10, 100), (0, 1_000, 1)])
def test_fits_have_a_task_a_core_before_they_have_more(spark, monkeypatch, rows, most, tasks):
    monkeypatch.setattr(modeling, "ROWS_PER_TASK", min(most, 50))
    monkeypatch.setattr(modeling, "MOST_ROWS_PER_TASK", most)
    many = spark.range(0, rows, 1, 200)
    cores = spark.sparkContext.defaultParallelism
    assert modeling.sized(many).rdd.getNumPartitions() == (cores if tasks == "cores" else tasks)
    assert modeling.sized(many).count() == rows
