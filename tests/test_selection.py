import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import modeling, selection
from tidemark.operators.modeling import TreeParams


@pytest.fixture(scope="module")
def table(spark):
    dice = random.Random(2)
    rows = []
    for i in range(3001):
        rows.append(
            (
                dice.gauss(0, 1),
                None if dice.random() < 0.4 else dice.choice([1.0, 2.0, 2.0, 5.0]),
                10.0 ** dice.randint(-300, 300) * dice.choice([-1, 1]),
                float("nan") if i % 3 == 0 else float(i // 7),
                None,
                4.0,
                i % 2,
            )
        )
    return spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, g int").repartition(5)


def plain(rows, column):
    known = sorted(float(r[column]) for r in rows if r[column] is not None and r[column] == r[column])
    return known[(len(known) - 1) // 2] if known else None


@pytest.mark.parametrize(("cuts", "fetched"), [(1024, 2048), (8, 400), (64, 20), (1024, 1)])
def test_medians_are_exact(table, monkeypatch, cuts, fetched):
    monkeypatch.setattr(selection, "CUTS", cuts)
    monkeypatch.setattr(selection, "FETCHED", fetched)
    names, rows = list("abcdefg"), table.collect()
    assert selection.exact_lower_medians(table, names) == [plain(rows, c) for c in names]


@pytest.mark.parametrize("cuts", [8, 1024])
def test_ranges_rise_with_the_values(spark, monkeypatch, cuts):
    monkeypatch.setattr(selection, "CUTS", cuts)
    dice = random.Random(7)
    for low, high in ((1.0, 1.0000000000000002), (-3.0, 8.0), (0.0, 5e-324), (-1e300, -1e-300), (2.0, 3.0), (-7.5, 0.0), (1e-9, 1e9)):
        values = sorted({low, high, *(v for v in (dice.choice([-1, 1]) * 10.0 ** dice.uniform(-300, 300) for _ in range(300)) if low <= v <= high)})
        values = sorted({*values, *(dice.uniform(low, high) for _ in range(100))} if high - low < 1e299 else values)
        search = selection._Search("v", low, high, 0, len(values))
        rows = spark.createDataFrame([(v,) for v in values], "v double")
        cut = {r["v"]: r["c"] for r in rows.select("v", selection._cut(F.col("v"), search).alias("c")).collect()}
        placed = [cut[v] for v in values]
        assert placed == sorted(placed) and placed[0] < placed[-1] and len(set(placed)) <= cuts


def test_medians_of_nothing(spark, table):
    assert selection.exact_lower_medians(table, []) == []
    assert selection.exact_lower_medians(table.limit(0), ["a", "b"]) == [None, None]


def test_partitions_change_neither_medians_nor_model(table):
    rows = table.select("a", "b", (F.col("a") + F.coalesce("b", F.lit(0.0)) > 1).cast("int").alias("label")).cache()
    scores = []
    for parts in (1, 64):
        dealt = rows.repartition(parts)
        model = modeling.train_model(dealt, ["a", "b"], "label", TreeParams(trees=3, depth=2))
        scored = model.transform(modeling.aligned(rows, ["a", "b"])).select("a", vector_to_array("s1_features").alias("v"), modeling.positive_probability().alias("p"))
        scores.append({r["a"]: (r["v"], r["p"]) for r in scored.collect()})
    assert all(scores[0][k][0] == scores[1][k][0] for k in scores[0])
    assert all(scores[0][k][1] == pytest.approx(scores[1][k][1], abs=1e-9) for k in scores[0])
