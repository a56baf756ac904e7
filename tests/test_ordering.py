import numpy as np
import pytest
from fixtures import order, orders
from pyspark.sql import functions as F

from tidemark.operators import ordering


@pytest.fixture
def numbers(spark):
    """1000 rows, 400 of them with the same leading value."""
    value = F.when(F.col("id") % 5 < 2, 7).otherwise(F.col("id") * 37 % 101)
    return spark.range(1000).select("id", value.cast("int").alias("value")).repartition(5, "id")


def test_positions_and_running_sums_equal_a_plain_sort(numbers):
    placed = ordering.global_running(numbers, ["value", "id"], ["value"])
    assert placed.select(F.spark_partition_id()).distinct().count() > 1
    rows = sorted(numbers.collect(), key=lambda r: (r["value"], r["id"]))
    running, expected = 0, {}
    for position, row in enumerate(rows):
        running += row["value"]
        expected[row["id"]] = (position, running)
    found = {r["id"]: (r["position"], r["running_value"]) for r in placed.collect()}
    assert found == expected
    totals = placed.select("total_rows", "total_value").distinct().collect()
    assert [tuple(t) for t in totals] == [(1000, running)]


def test_descending_order_and_empty_input(numbers):
    first = ordering.global_running(numbers, [F.desc("value"), "id"]).filter("position = 0").first()
    best = max(numbers.collect(), key=lambda r: (r["value"], -r["id"]))
    assert (first["value"], first["id"]) == (best["value"], best["id"])
    assert ordering.global_running(numbers.limit(0), ["value", "id"], ["value"]).count() == 0


def test_exact_quantiles(numbers):
    values = [r["value"] for r in numbers.collect()]
    shares = [0.0, 0.1, 1 / 3, 0.5, 2 / 3, 1.0]
    assert ordering.exact_quantiles(numbers, "value", shares) == pytest.approx(list(np.quantile(values, shares)))
    assert ordering.exact_quantiles(numbers.limit(0), "value", shares) == []


def test_chronological_split(spark):
    rows = [order(str(i), f"c{i:02d}", f"2018-01-{1 + i // 3:02d}") for i in range(11)]
    history = orders(spark, rows + [order("late", "c00", "2018-05-01")])
    targets = history.select("customer_unique_id").distinct().withColumn("will_return", F.lit(0))
    split = ordering.chronological_split(targets, history)
    found = {r["customer_unique_id"]: r["split"] for r in split.collect()}
    assert [found[f"c{i:02d}"] for i in range(11)] == ["train"] * 8 + ["test"] * 3  # int(11 * 0.8) = 8
    edge = split.groupBy("split").agg(F.min("first_order_date").alias("low"), F.max("first_order_date").alias("high"))
    dates = {r["split"]: (r["low"], r["high"]) for r in edge.collect()}
    assert dates["train"][1] <= dates["test"][0]


def test_one_first_date_for_a_third_of_the_customers(spark):
    history = spark.range(900).select(
        F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("customer_unique_id"),
        F.when(F.col("id") % 3 == 0, F.lit("2018-01-01")).otherwise(F.lit("2018-02-01")).cast("timestamp_ntz").alias("order_purchase_timestamp"),
    )
    split = ordering.chronological_split(history.select("customer_unique_id"), history, 0.2)
    ordered = sorted(history.collect(), key=lambda r: (r[1], r[0]))
    train = {r["customer_unique_id"] for r in split.filter("split = 'train'").collect()}
    assert train == {r[0] for r in ordered[:180]}


@pytest.mark.parametrize(("rows", "folds"), [(23, 5), (12, 3), (7, 2)])
def test_time_series_folds(spark, rows, folds):
    df = spark.range(rows).select("id")
    found = {r["id"]: r["fold"] for r in ordering.time_series_folds(df, ["id"], folds).collect()}
    size = rows // (folds + 1)
    for number in range(1, folds + 1):
        start = rows - (folds - number + 1) * size
        assert [i for i in range(rows) if found[i] == number] == list(range(start, start + size))
    assert [i for i in range(rows) if found[i] == 0] == list(range(rows - folds * size))


def test_stratified_folds_are_even_and_seeded(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 61, 0).when(F.col("id") < 90, 1).otherwise(2).alias("label"))
    dealt = ordering.stratified_folds(df, "label", "id", 3, seed=1)
    sizes = {(r["label"], r["fold"]): r["count"] for r in dealt.groupBy("label", "fold").count().collect()}
    for label, rows in ((0, 61), (1, 29), (2, 10)):
        assert [sizes[label, fold] for fold in range(3)] == [(rows + 2 - fold) // 3 for fold in range(3)]
    again = ordering.stratified_folds(df.repartition(7), "label", "id", 3, seed=1)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in dealt.collect()}
    other = ordering.stratified_folds(df, "label", "id", 3, seed=2)
    assert {tuple(r) for r in other.collect()} != {tuple(r) for r in dealt.collect()}
