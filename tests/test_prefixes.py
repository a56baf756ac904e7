import random
from dataclasses import replace

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import attribution, metrics, modeling
from tidemark.operators.modeling import TreeParams
from tidemark.operators.prefixes import FlatTrees, staged_margins
from tidemark.settings import SearchSpace

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    dice = random.Random(9)
    made = []
    for i in range(500):
        a, b = dice.random(), None if dice.random() < 0.2 else dice.random()
        made.append((i, a, b, int(a + 0.4 * (b or 0) + 0.3 * dice.random() > 1), int(2.99 * a)))
    return spark.createDataFrame(made, "id int, a double, b double, label int, tier int").cache()


def test_margins_of_prefixes_equal_separate_fits(rows):
    encoded = Pipeline(stages=modeling.encoder_stages(rows, FEATURES, "x")).fit(rows).transform(rows).cache()
    params = TreeParams(trees=7, depth=3, row_fraction=0.8, column_fraction=0.7, min_leaf_rows=2)
    longest = FlatTrees.of_model(modeling.boosted_trees(params, "label", "x").fit(encoded))
    counts = [7, 1, 4]
    staged = staged_margins(encoded, "x_features", ["id"], [longest], counts).collect()
    found = {(r["id"], r["stage"]): r["margins"][0] for r in staged}
    assert len(found) == 1500
    for stage, count in enumerate(counts):
        model = modeling.boosted_trees(replace(params, trees=count), "label", "x").fit(encoded)
        for r in model.transform(encoded).select("id", vector_to_array("x_raw")[1].alias("m")).collect():
            assert found[r["id"], stage] == pytest.approx(r["m"], abs=1e-12)


def separate_score(learned, judged, label, params, objective):
    model = Pipeline(stages=modeling.classifiers(params, label, objective, "cv")).fit(learned)
    scored = model.transform(judged)
    if objective == "multi":
        called = scored.select(F.col(label).alias("label"), modeling.predicted_class("cv").alias("prediction"))
        return metrics.tier_report(called).first()["weighted_f1"]
    scores = scored.select(F.col(label).alias("label"), modeling.positive_probability("cv").alias("score"))
    return metrics.average_precision(scores).first()["average_precision"]


@pytest.mark.parametrize(("objective", "label"), [("binary", "label"), ("multi", "tier")])
def test_scores_of_prefixes_equal_separate_fits(rows, objective, label):
    params, counts = TreeParams(depth=3, step_size=0.2, row_fraction=0.7), [6, 2, 3, 2]
    learned, judged = modeling._encoded_fold(rows.filter("id < 350"), rows.filter("id >= 350"), FEATURES, label, objective)
    found = modeling.staged_scores(learned, judged, label, params, objective, counts)
    for count, score in zip(counts, found, strict=True):
        assert score == pytest.approx(separate_score(learned, judged, label, replace(params, trees=count), objective), abs=1e-9)


def test_trials_that_differ_in_trees_share_a_fit():
    drawn = modeling.drawn_params(SearchSpace(), 12, 5, 42)
    assert len(drawn) == 12
    settings = [replace(p, trees=0) for p in drawn]
    assert settings[0:5] == [settings[0]] * 5 and settings[5:10] == [settings[5]] * 5 and settings[10] == settings[11]
    assert len(set(settings)) == 3 and len({p.trees for p in drawn}) > 6
    assert drawn == modeling.drawn_params(SearchSpace(), 12, 5, 42) != modeling.drawn_params(SearchSpace(), 12, 5, 43)


def test_search_fits_once_per_setting_and_fold(rows, monkeypatch):
    fits = []
    plain = modeling.staged_scores
    monkeypatch.setattr(modeling, "staged_scores", lambda *a: fits.append(a[-1]) or plain(*a))
    space = SearchSpace(trees=(1, 4), depth=(2, 2))
    best, trials = modeling.tune_model(
        rows, FEATURES, "label", trials=7, folds=2, order_by=["id"], space=space, counts_per_fit=4
    )
    assert sorted(map(len, fits)) == [3, 3, 4, 4]
    found = trials.orderBy("trial").collect()
    assert [r["is_best"] for r in found].count(True) == 1
    assert max(r["mean_score"] for r in found) == next(r["mean_score"] for r in found if r["is_best"])
    assert all(r["fit_seconds"] > 0 for r in found) and best.trees in {r["trees"] for r in found}


def test_average_precision_by_group(spark):
    dice = random.Random(1)
    made = [(g, dice.randint(0, 1), dice.randint(0, 9) / 10) for g in range(4) for _ in range(60 + g)]
    scored = spark.createDataFrame(made, "g int, label int, score double").repartition(4)
    found = {r["g"]: r["average_precision"] for r in metrics.average_precisions(scored, "g").collect()}
    for group in range(4):
        alone = metrics.average_precision(scored.filter(F.col("g") == group)).first()["average_precision"]
        assert found[group] == pytest.approx(alone, abs=1e-12)


def test_shapley_values_of_the_deepest_trees_add_up(rows):
    wide = rows.withColumns({f"x{i}": F.rand(i) for i in range(8)})
    names = [*FEATURES, *[f"x{i}" for i in range(8)]]
    encoded = Pipeline(stages=modeling.encoder_stages(wide, names, "x")).fit(wide).transform(wide).cache()
    model = modeling.boosted_trees(TreeParams(trees=12, depth=7), "label", "x").fit(encoded)
    leaves = attribution._leaf_tables(attribution.tree_nodes(model).collect(), model.treeWeights)
    assert max(len(leaf[0]) for leaf in leaves) >= 6
    report = attribution.additivity(model.transform(encoded), "x_features", "x_raw", model).first()
    assert (report["rows"], report["violations"]) == (500, 0)
