from fixtures import at
from pyspark.sql import functions as F

from tidemark.operators.base_table import base_table
from tidemark.operators.requests import valid_requests, validate_requests
from tidemark.sources import (
    commerce_tables,
    read_base_table,
    read_csv_tables,
    read_parquet_tables,
    read_requests,
    write_base_table,
)
from tidemark.sources.schemas import TABLE_COLUMNS

FILES = {
    "shop_orders_dataset.csv": "customer_id,order_id,order_status,order_purchase_timestamp,note\n"
    "c1,o1,delivered,2018-01-01 10:11:12,hello\nc2,o2,delivered,not a date,\n",
    "shop_order_items_dataset.csv": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    "o1,1,p1,s1,2018-01-02 00:00:00,58.90,13.29\n",
    "shop_order_payments_dataset.csv": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    "o1,1,credit_card,8,99.33\n",
    "shop_order_reviews_dataset.csv": "review_id,order_id,review_score,review_comment_message,review_creation_date\n"
    'r1,o1,4,"two\nlines, with ""quotes""",2018-02-01 00:00:00\n',
    "shop_customers_dataset.csv": "customer_id,customer_unique_id,customer_state\nc1,u1,SP\n",
    "shop_products_dataset.csv": "product_id,product_category_name\np1,livros\n",
    "product_category_name_translation.csv": "product_category_name,product_category_name_english\nlivros,books\n",
    "shop_sellers_dataset.csv": "seller_id,seller_state\ns1,SP\n",
}


def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_csv_columns_go_by_name_and_missing_ones_are_null(spark, tmp_path):
    orders = read_csv_tables(spark, folder(tmp_path)).orders
    kinds = dict(orders.dtypes)
    assert all(kinds[name] == kind for name, kind in TABLE_COLUMNS["orders"].items())
    assert kinds["note"] == "string"
    rows = {r["order_id"]: r for r in orders.collect()}
    assert rows["o1"]["customer_id"] == "c1"
    assert rows["o1"]["order_purchase_timestamp"] == at("2018-01-01T10:11:12")
    assert rows["o1"]["order_approved_at"] is None
    assert rows["o1"]["_corrupt_record"] is None


def test_csv_row_that_does_not_fit_is_kept(spark, tmp_path):
    bad = read_csv_tables(spark, folder(tmp_path)).orders.filter("order_id = 'o2'").first()
    assert bad["order_purchase_timestamp"] is None
    assert bad["_corrupt_record"] == "c2,o2,delivered,not a date,"


def test_csv_quoted_line_breaks(spark, tmp_path):
    review = read_csv_tables(spark, folder(tmp_path)).reviews.first()
    assert review["review_comment_message"] == 'two\nlines, with "quotes"'


def test_csv_to_base_table(spark, tmp_path):
    row = base_table(read_csv_tables(spark, folder(tmp_path))).filter("order_id = 'o1'").first()
    assert (row["customer_unique_id"], row["total_price"], row["top_category"]) == ("u1", 58.90, "books")
    assert (row["payment_value"], row["review_score"], row["review_comment_length"]) == (99.33, 4.0, len('two\nlines, with "quotes"'))


def test_parquet_tables(spark, tmp_path):
    tables = read_csv_tables(spark, folder(tmp_path))
    for name in TABLE_COLUMNS:
        getattr(tables, name).drop("_corrupt_record").write.parquet(f"{tmp_path}/{name}.parquet")
    again = read_parquet_tables(spark, str(tmp_path))
    assert base_table(again).count() == 2
    assert again.orders.columns[:2] == ["customer_id", "order_id"]


def test_base_table_round_trip_prunes_months(spark, tmp_path):
    base = base_table(commerce_tables(spark, "/root/testdata/sf0.001"))
    path = f"{tmp_path}/base"
    write_base_table(base, path)
    stored = read_base_table(spark, path)
    assert stored.count() == base.count()
    assert set(stored.columns) == {*base.columns, "purchase_month"}
    early = read_base_table(spark, path, before="1997-03-15")
    assert early.count() == base.filter(F.col("order_purchase_timestamp") < F.lit("1997-03-15").cast("timestamp_ntz")).count()
    plan = early._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan


def test_requests_from_json(spark, tmp_path):
    import json

    sample = {
        "order_id": "r-1",
        "order_purchase_timestamp": "2018-02-20T08:15:00",
        "payment_value": 64.25,
        "payment_installments": 4,
        "order_item_count": 3,
        "freight_value": 7.75,
        "order_delivered_customer_date": "2018-03-01T11:00:00",
    }
    asked = [
        {"request_id": "fine", "customer_unique_id": "c", "cutoff_date": "2018-07-01T00:00:00", "orders": [sample]},
        {
            "request_id": "text for a number",
            "customer_unique_id": "c",
            "cutoff_date": "2018-07-01T00:00:00",
            "orders": [{**sample, "payment_value": "much"}],
        },
        {"request_id": "no array", "customer_unique_id": "c", "cutoff_date": "2018-07-01T00:00:00"},
    ]
    (tmp_path / "asked.json").write_text("\n".join(json.dumps(request) for request in asked))
    requests = read_requests(spark, f"{tmp_path}/asked.json")
    found = {r["request_id"]: r["violations"] for r in validate_requests(requests).collect()}
    assert found["fine"] == []
    assert found["no array"] == ["orders"]
    assert found["text for a number"]
    row = valid_requests(requests).first()
    assert row["cutoff_date"] == at("2018-07-01")
    assert row["orders"][0]["order_purchase_timestamp"] == at("2018-02-20T08:15:00")
    assert row["orders"][0]["review_score"] is None
