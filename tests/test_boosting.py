"""Fits in one task against Spark ML's, and the whole of the registered search."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import boosting, modeling
from tidemark.operators.modeling import TreeParams
from tidemark.operators.prefixes import FlatTrees, tree_nodes
from tidemark.plans import queries
from tidemark.settings import SearchSpace, Settings

NAMES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    dice = random.Random(3)
    made = []
    for i in range(700):
        a, b, c = dice.random(), dice.random() if dice.random() > 0.2 else 0.0, dice.randint(0, 5)
        y = int(a + 0.3 * b + 0.4 * dice.random() + 0.1 * c > 1.1)
        made.append((i, a, b, float(c), float(dice.random() < 0.3), 1.0, float(y), float(c % 3 == 1), 3.7 if y else 1.0))
    table = spark.createDataFrame(made, "id int, a double, b double, c double, d double, e double, y double, z double, w double")
    return VectorAssembler(inputCols=NAMES, outputCol="x_features").transform(table.coalesce(1)).cache()


def margins(model, rows):
    return [r["m"] for r in model.transform(rows).orderBy("id").select(vector_to_array("x_raw")[1].alias("m")).collect()]


@pytest.mark.parametrize("weight", [None, "w"])
@pytest.mark.parametrize(
    "params",
    [TreeParams(6, 4), TreeParams(6, 3, 0.3, column_fraction=0.5), TreeParams(6, 3, 0.2, row_fraction=0.7, column_fraction=0.8, min_leaf_rows=5)],
)
def test_a_task_grows_the_trees_of_spark_ml(rows, params, weight):
    asked = modeling.boosted_trees(params, "y", "x", weight)
    spark_ml, (own,) = asked.fit(rows), boosting.fitted_models(rows, [asked])
    assert margins(own, rows) == pytest.approx(margins(spark_ml, rows), abs=1e-9)
    assert own.treeWeights == spark_ml.treeWeights and own.numFeatures == len(NAMES)
    (flat,) = boosting.fitted_flat(rows, [asked])
    points = np.array([r["v"] for r in rows.orderBy("id").select(vector_to_array("x_features").alias("v")).collect()])
    assert flat.margins(points, [params.trees])[:, 0] == pytest.approx(margins(own, rows), abs=1e-12)
    root = {r["tree"]: r["cover"] for r in tree_nodes(own).filter("id = 0").collect()}
    assert root == {r["tree"]: pytest.approx(r["cover"]) for r in tree_nodes(spark_ml).filter("id = 0").collect()}


def test_labels_that_are_fitted_together_get_their_own_trees(rows):
    params = TreeParams(5, 3, row_fraction=0.8, column_fraction=0.7)
    asked = [modeling.boosted_trees(params, label, "x") for label in ("y", "z")]
    together = boosting.fitted_models(rows, asked)
    for model, one in zip(together, asked, strict=True):
        assert margins(model, rows) == pytest.approx(margins(one.fit(rows), rows), abs=1e-9)
    with pytest.raises(ValueError, match="same parameters"):
        boosting.fitted_arrays(rows, [asked[0], modeling.boosted_trees(replace(params, depth=4), "z", "x")])


def test_training_starts_no_job_for_each_level(rows, monkeypatch):
    monkeypatch.setattr(GBTClassifier, "fit", lambda *_: pytest.fail("a job for each level of each tree"))
    model = modeling.train_model(rows.select("id", "a", "b", F.col("y").cast("int").alias("y")), ["a", "b"], "y", TreeParams(3, 3))
    assert len(model.stages[-1].trees) == 3


def test_more_rows_than_a_task_holds_are_left_to_spark_ml(rows, monkeypatch):
    monkeypatch.setattr(boosting, "MOST_CELLS", 700 * len(NAMES) - 1)
    asked = modeling.boosted_trees(TreeParams(2, 2), "y", "x")
    assert boosting.fitted_models(rows, [asked]) is None
    (model,) = modeling.fitted(rows, [asked])
    assert margins(model, rows) == pytest.approx(margins(asked.fit(rows), rows))


def test_counting_by_pairs_and_from_the_parent_changes_no_tree(monkeypatch):
    dice = np.random.default_rng(1)
    points = np.concatenate([dice.random((3_000, 3)), dice.integers(0, 4, (3_000, 2))], axis=1)
    labels = np.stack([points[:, 0] + points[:, 3] / 4 + dice.random(3_000) > 1.2, points[:, 1] > 0.5]).astype(float)
    params = {"trees": 4, "depth": 5, "step_size": 0.2, "row_fraction": 0.8, "column_fraction": 0.8, "min_leaf_rows": 20, "seed": 1, "bins": 32}
    for weight in (None, np.where(labels[0] == 1, 2.5, 1.0), dice.random(3_000)):
        found = boosting.boosted(points, labels, weight, params)
        with monkeypatch.context() as plain:
            plain.setattr(boosting, "FEW_ROWS", 10**9)
            plain.setattr(boosting, "FEW_CELLS", 10**9)
            expected = boosting.boosted(points, labels, weight, params)
        for one, other in zip(found, expected, strict=True):
            assert (one["feature"] == other["feature"]).all() and one["value"] == pytest.approx(other["value"], abs=1e-9)


def test_thresholds_equal_a_walk_through_the_values():
    dice = np.random.default_rng(2)
    for values, weight in ((dice.random(500), None), (dice.integers(0, 90, 800) / 7, dice.random(800)), (dice.integers(0, 5, 60) * 1.0, None)):
        counted = {}
        for value, w in zip(values, np.ones(len(values)) if weight is None else weight, strict=True):
            counted[value] = counted.get(value, 0.0) + w
        known, weights = zip(*sorted(counted.items()), strict=True)
        expected, stride = [], sum(weights) / 32
        reached, wanted = weights[0], stride
        for i in range(1, len(known)):
            before, reached = reached, reached + weights[i]
            if abs(before - wanted) < abs(reached - wanted):
                expected.append((known[i - 1] + known[i]) / 2)
                wanted += stride
        if len(known) <= 32:
            expected = [(x + y) / 2 for x, y in zip(known, known[1:], strict=False)]
        assert boosting.candidate_thresholds(values, weight, 32).tolist() == pytest.approx(expected)


def test_walk_in_blocks_holds_every_prefix(monkeypatch, rows):
    (flat,) = boosting.fitted_flat(rows, [modeling.boosted_trees(TreeParams(9, 3), "y", "x")])
    points = np.random.default_rng(0).random((50, len(NAMES)))
    whole = flat.margins(points, [9, 1, 4, 9])
    monkeypatch.setattr("tidemark.operators.prefixes.BLOCK", 100)  # two trees at once
    assert (flat.margins(points, [9, 1, 4, 9]) == whole).all()
    assert isinstance(flat, FlatTrees) and (whole[:, 0] == whole[:, 3]).all() and (whole[:, 0] != whole[:, 1]).any()


def test_the_registered_search_is_whole():
    assert replace(queries.SEARCH, parallelism=Settings().parallelism) == Settings()
    assert Settings().trials == 50 and Settings().space == SearchSpace()


def test_every_trial_draws_all_its_parameters(spark):
    table = spark.range(80).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    _, trials = modeling.tune_model(table, ["x"], "label", trials=4, folds=2, order_by=["id"], space=SearchSpace(trees=(1, 2)))
    assert len({(r["depth"], r["step_size"], r["row_fraction"], r["column_fraction"]) for r in trials.collect()}) == 4
