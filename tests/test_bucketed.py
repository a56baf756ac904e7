"""Storage in buckets: what is grouped and joined by customer runs where the rows lie."""

import pytest
from compare import connect
from fixtures import order, orders
from pyspark.sql import functions as F

from tidemark.operators import features, ordering, targets
from tidemark.plans import queries, training
from tidemark.settings import Settings
from tidemark.sources import read_bucketed_base_table, write_bucketed_base_table
from tidemark.sources.commerce import commerce_tables

FOLDER = "/root/testdata/sf0.001"
CUSTOMER = "customer_unique_id"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bucketed") / "base")
    write_bucketed_base_table(queries.base_rows(spark, FOLDER), path, 4)
    return read_bucketed_base_table(spark, path)


def test_round_trip(spark, stored):
    base = queries.base_rows(spark, FOLDER)
    assert stored.columns == base.columns and dict(stored.dtypes) == dict(base.dtypes)
    assert sorted(map(str, stored.collect())) == sorted(map(str, base.collect()))
    assert spark.catalog.listTables() == []


def test_customers_do_not_move(spark, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = targets.customer_targets(stored, queries.CUTOFF, first_order=True)
        numbers = features.feature_numbers(stored, queries.CUTOFF)
        split = found.withColumn("split", ordering.chronological_cut(found))
        for df in (found, numbers, features.rfm_features(stored, queries.CUTOFF), split.join(numbers, CUSTOMER, "left")):
            text = plan(df)
            assert "Bucketed: true" in text and "Exchange" not in text and "SortAggregate" not in text
        # the scan, the day states and the merge are one chain
        assert plan(numbers).count("FileScan") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_features_equal_those_of_plain_storage(spark, stored):
    plain = features.feature_matrix(queries.base_rows(spark, FOLDER), queries.CUTOFF)
    found = features.feature_matrix(stored, queries.CUTOFF).select(plain.columns)
    assert sorted(map(str, queries.tidy(found).collect())) == sorted(map(str, queries.tidy(plain).collect()))


def test_cut_equals_split(spark):
    rows = [order(str(i), f"c{i:02d}", f"2018-01-{1 + i // 4:02d}") for i in range(23)]
    dated = ordering.first_orders(orders(spark, rows)).union(spark.createDataFrame([("undated", None), ("x", None)], "c string, d timestamp_ntz"))
    for share in (0.0, 0.3, 0.5, 0.8, 0.93, 0.97, 1.0):
        split = ordering.chronological_split(dated, train_fraction=share).select(CUSTOMER, "split")
        cut = dated.select(CUSTOMER, ordering.chronological_cut(dated, share).alias("split"))
        assert sorted(cut.collect()) == sorted(split.collect())
    assert dated.limit(0).select(ordering.chronological_cut(dated.limit(0))).count() == 0


def test_running_totals_move_rows_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    table = spark.range(1000).select("id", (F.col("id") * 37 % 101).alias("value"))
    text = plan(ordering.global_running(table, ["value", "id"], ["value"]))
    assert "hashpartitioning(_part" not in text.split("BroadcastExchange")[0]
    assert "Bucketed: true" in text
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before


def test_favourite_category_and_reviews_are_hash_aggregates(spark):
    for name in ("items_per_order", "latest_review_per_order", "base_table", "feature_matrix"):
        text = plan(queries.SQL_CHECKED[name](spark, FOLDER))
        assert "SortAggregate" not in text and "Expand" not in text, name


def test_step_reports(spark, tmp_path):
    path = f"{tmp_path}/base"
    said = training.store_base_table(commerce_tables(spark, FOLDER), path)
    known = read_bucketed_base_table(spark, path)
    assert said["rows"] == known.count() and said["without_customer"] == 0
    every = training.store_base_table(commerce_tables(spark, FOLDER), f"{tmp_path}/all", Settings(valid_statuses=("delivered", "shipped")))
    assert every["rows"] > said["rows"]
    table, report = training.training_table(known, queries.CUTOFF, Settings())
    sides = {r["split"]: (r["count"], r["rate"]) for r in table.groupBy("split").agg(F.count("*").alias("count"), F.avg("will_return").alias("rate")).collect()}
    for side, (count, rate) in sides.items():
        assert report[f"{side}_customers"] == count and report[f"{side}_return_rate"] == pytest.approx(rate)
    assert report["returners"] == table.filter("will_return = 1").count()
    assert connect(FOLDER).execute("SELECT count(*) FROM orders WHERE o_orderstatus IN ('F', 'O')").fetchone()[0] == every["rows"]
