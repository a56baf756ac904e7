"""Every registered query against the SQL oracle, and the plans it runs by."""

import re

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from tidemark.plans import queries
from tidemark.settings import SearchSpace, Settings

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def short_search():
    """The tests train on a handful of trees; what is checked of the models holds for any."""
    before = queries.SEARCH
    space = SearchSpace(trees=(2, 4), depth=(3, 4))
    queries.SEARCH = Settings(trials=2, stage1_folds=2, stage2_folds=2, scout_trees=5, space=space)
    yield
    queries.SEARCH = before



@pytest.fixture(scope="module")
def oracle():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_the_oracle(spark, oracle, name):
    assert differences(entry.queries()[name](spark, FOLDER), oracle, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 75


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The base table on disk, which is what the plans look like in production."""
    path = str(tmp_path_factory.mktemp("base"))
    queries.base_rows(spark, FOLDER).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_features_need_one_shuffle_per_branch(stored):
    from tidemark.operators import features

    text = plan(features.rfm_features(stored, queries.CUTOFF))
    assert text.count("Exchange hashpartitioning(customer_unique_id") == 1
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {field.split(":")[0] for field in read.split(",")} == {
        "customer_unique_id",
        "order_purchase_timestamp",
        "payment_value",
    }
    text = plan(features.feature_matrix(stored, queries.CUTOFF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text
    assert "SinglePartition" not in text
    # the states of a day, which were then merged per customer and stored, are not computed again
    assert text.count("Exchange hashpartitioning(customer_unique_id") == 0
    text = plan(features.feature_numbers(stored, queries.CUTOFF))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning(customer_unique_id") == 2  # by customer and day, then by customer


def test_targets_are_one_aggregation(stored):
    from tidemark.operators import targets

    text = plan(targets.customer_targets(stored, queries.CUTOFF))
    assert text.count("Exchange") == 1
    assert "Join" not in text


def test_no_python_before_the_models(spark):
    for name in ("base_table", "feature_matrix", "customer_targets", "validate_requests", "request_features"):
        text = plan(queries.SQL_CHECKED[name](spark, FOLDER))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text and "InPandas" not in text, name


def test_rows_are_never_gathered_in_one_partition(spark):
    text = plan(queries.split_rows(queries.base_rows(spark, FOLDER)))
    # the only single partition holds one row per partition of the sort
    for line in text.splitlines():
        if "SinglePartition" in line:
            following = text[text.index(line) :].splitlines()[1:4]
            assert any("_part" in other for other in following)
