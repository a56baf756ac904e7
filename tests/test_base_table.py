from fixtures import at

from tidemark.operators import base_table as base
from tidemark.sources.readers import CommerceTables


def tables(spark):
    return CommerceTables(
        orders=spark.createDataFrame(
            [
                ("o1", "c1", "delivered", at("2018-01-01")),
                ("o2", "c2", "shipped", at("2018-01-02")),
                ("o3", "c3", "delivered", at("2018-01-03")),
                ("o4", "nobody", "delivered", at("2018-01-04")),
            ],
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz",
        ),
        order_items=spark.createDataFrame(
            [
                ("o1", 1, "p1", "s1", 10.0, 1.0),
                ("o1", 2, "p2", "s1", 20.0, None),
                ("o1", 3, "p3", "s2", None, 2.0),
                ("o1", 4, "p2", None, 5.0, 1.0),
                ("o3", None, "p9", "s1", None, None),
                (None, 1, "p1", "s1", 99.0, 9.0),
            ],
            "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double",
        ),
        payments=spark.createDataFrame(
            [
                ("o1", "voucher", 1, 5.0),
                ("o1", "credit_card", 4, 30.0),
                ("o3", None, None, None),
            ],
            "order_id string, payment_type string, payment_installments int, payment_value double",
        ),
        reviews=spark.createDataFrame(
            [
                ("o1", 3.0, "long text", at("2018-02-01")),
                ("o1", None, None, at("2018-03-01")),
                ("o3", 1.0, "x", None),
                ("o3", 5.0, "yy", at("2018-02-01")),
            ],
            "order_id string, review_score double, review_comment_message string, review_creation_date timestamp_ntz",
        ),
        customers=spark.createDataFrame(
            [("c1", "u1", "SP"), ("c2", "u1", "RJ"), ("c3", "u2", None)],
            "customer_id string, customer_unique_id string, customer_state string",
        ),
        products=spark.createDataFrame(
            [("p1", "brinquedos"), ("p2", "livros"), ("p3", "brinquedos"), ("p9", "sem_nome")],
            "product_id string, product_category_name string",
        ),
        category=spark.createDataFrame(
            [("brinquedos", "toys"), ("livros", "books")],
            "product_category_name string, product_category_name_english string",
        ),
    )


def by_order(df):
    return {row["order_id"]: row for row in df.collect()}


def test_items_per_order(spark):
    t = tables(spark)
    found = by_order(base.items_per_order(t.order_items, t.products, t.category))
    assert set(found) == {"o1", "o3"}
    first = found["o1"]
    assert (first["total_price"], first["total_freight"], first["item_count"]) == (35.0, 4.0, 4)
    assert (first["unique_sellers"], first["unique_categories"]) == (2, 2)
    assert first["top_category"] == "books"  # two votes each, the smaller name wins
    third = found["o3"]
    assert (third["total_price"], third["total_freight"], third["item_count"]) == (0.0, 0.0, 0)
    assert (third["unique_sellers"], third["unique_categories"], third["top_category"]) == (1, 0, None)


def test_payments_per_order(spark):
    found = by_order(base.payments_per_order(tables(spark).payments))
    assert tuple(found["o1"])[1:] == (35.0, 4, 1, 1, 0)
    assert tuple(found["o3"])[1:] == (0.0, None, 0, 0, 0)


def test_latest_review_takes_each_column_on_its_own(spark):
    found = by_order(base.latest_review_per_order(tables(spark).reviews))
    assert tuple(found["o1"])[1:] == (3.0, 0, at("2018-03-01"))  # the newest score is unknown, its comment is empty
    assert tuple(found["o3"])[1:] == (1.0, 1, at("2018-02-01"))  # a review without date counts as the newest


def test_base_table_keeps_orders_without_children(spark):
    found = by_order(base.base_table(tables(spark)))
    assert set(found) == {"o1", "o3", "o4"}
    bare = found["o4"]
    assert all(bare[name] is None for name in ("customer_unique_id", "total_price", "payment_value", "review_score"))
    assert found["o1"]["customer_unique_id"] == "u1"
    assert found["o3"]["customer_state"] is None


def test_statuses_are_a_parameter(spark):
    found = by_order(base.base_table(tables(spark), statuses=("shipped", "delivered")))
    assert set(found) == {"o1", "o2", "o3", "o4"}


def test_one_order_with_very_many_items(spark):
    """A third and more of all items in one order, and one product: same results as a plain aggregation."""
    from pyspark.sql import functions as F

    items = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 97).cast("string").alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.concat(F.lit("p"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7)).alias("product_id"),
        (F.col("id") % 13).cast("string").alias("seller_id"),
        (F.col("id") % 10).cast("double").alias("price"),
        F.lit(1.0).alias("freight_value"),
    )
    t = tables(spark)
    found = by_order(base.items_per_order(items, t.products, t.category))
    plain = base.categorized_items(items, t.products, t.category).groupBy("order_id").agg(
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight"),
        F.count("order_item_id").alias("item_count"),
        F.count_distinct("seller_id").alias("unique_sellers"),
        F.count_distinct("product_category_name_english").alias("unique_categories"),
        F.mode("product_category_name_english", True).alias("top_category"),
    )
    assert found == by_order(plain.select(*next(iter(found.values())).__fields__))
