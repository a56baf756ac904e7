"""A third of all rows under one key: the work is split and the results stay whole."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import base_table as base
from tidemark.operators import features

ROWS = 60_000

# Small enough that the test data counts as large; nothing may be broadcast.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
}


@pytest.fixture
def crowded(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(column, others):
    return F.when(F.col(column) % 3 == 0, 0).otherwise(F.col(column) % others).cast("string")


def tables(spark):
    orders = spark.range(0, ROWS, 1, 8).select(
        F.col("id").cast("string").alias("order_id"),
        hot("id", 5000).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        (F.lit("2000-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 300).cast("int"))).alias(
            "order_purchase_timestamp"
        ),
        (F.col("id") % 100).cast("double").alias("payment_value"),
    )
    customers = spark.range(5000).select(
        F.col("id").cast("string").alias("customer_id"),
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("customer_unique_id"),
        F.concat(F.lit("S"), hot("id", 400)).alias("customer_state"),
    )
    return orders, customers


def executed(df):
    rows = df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return rows, text.split("== Initial Plan ==")[0]


def test_hot_account(crowded):
    orders, customers = tables(crowded)
    rows, text = executed(features.rfm_features(base.with_customer(orders, customers), "2001-01-01"))
    assert re.search(r"SortMergeJoin\(skew=true\) \[customer_id", text)
    counts = {r["customer_unique_id"]: r["frequency"] for r in rows}
    assert sum(counts.values()) == ROWS
    assert counts["u0"] == sum(1 for i in range(ROWS) if i % 3 == 0 or i % 5000 == 0)


def test_hot_product(crowded):
    orders, customers = tables(crowded)
    items = orders.select(
        "order_id",
        F.lit(1).alias("order_item_id"),
        F.col("customer_id").alias("product_id"),
        F.lit("s").alias("seller_id"),
        F.col("payment_value").alias("price"),
        F.lit(1.0).alias("freight_value"),
    )
    products = customers.select(F.col("customer_id").alias("product_id"), F.col("customer_state").alias("product_category_name"))
    category = crowded.range(400).select(
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("product_category_name"),
        F.concat(F.lit("E"), F.col("id").cast("string")).alias("product_category_name_english"),
    )
    rows, text = executed(base.items_per_order(items, products, category))
    assert re.search(r"SortMergeJoin\(skew=true\) \[product_id", text)
    assert len(rows) == ROWS
    assert sum(r["item_count"] for r in rows) == ROWS
    assert all(r["unique_categories"] == 1 for r in rows)


def test_hot_state(crowded):
    orders, customers = tables(crowded)
    past = base.with_customer(orders, customers)
    rows, text = executed(features.state_frequency(past))
    assert re.search(r"SortMergeJoin.*\[customer_state#\d+, _salt", text)
    known = {r["customer_unique_id"]: r["customer_state"] for r in features.latest_state(past).collect()}
    sizes = {}
    for state in known.values():
        sizes[state] = sizes.get(state, 0) + 1
    assert max(sizes.values()) > len(known) / 3
    assert {r["customer_unique_id"]: r["customer_state_freq"] for r in rows} == {c: sizes[s] for c, s in known.items()}
