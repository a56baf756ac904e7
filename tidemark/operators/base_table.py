"""One row per order: orders with what their items, payments, reviews and customers say.

Children are aggregated to the order before they are joined, so no join fans out, and every aggregate combines
map-side before its shuffle, so an order with very many child rows does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import any_equals, micros_since_year_1, packed, sum_or_zero
from tidemark.sources.readers import CommerceTables

# A category's number takes the low bits of a long, its votes in an order the rest.
_NUMBER_BITS = 31
# Later than any date, and digits of a review's rank among those of the same date
_UNDATED, _RANK_DIGITS = 999_999_999_999_999_999, 19


def orders_with_status(orders: DataFrame, statuses: Iterable[str] = ("delivered",)) -> DataFrame:
    return orders.filter(F.col("order_status").isin(*statuses))


def with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Attach the stable customer id and the state; unknown accounts keep their order with NULLs."""
    return orders.join(customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id", "left")


def categorized_items(items: DataFrame, products: DataFrame, category: DataFrame) -> DataFrame:
    """Items with the translated category of their product.

    The small sides carry no broadcast hint: Spark broadcasts them by measured size and otherwise runs a
    sort-merge join, where adaptive execution splits a product that holds very many items.
    """
    translated = products.select("product_id", "product_category_name").join(
        category.select("product_category_name", "product_category_name_english"), "product_category_name", "left"
    )
    return items.join(translated.select("product_id", "product_category_name_english"), "product_id", "left")


def numbered_categories(category: DataFrame) -> DataFrame:
    """category, number: the distinct names, numbered from 0 in descending order.

    One task numbers the names. They are a dimension: a row for each category name, whatever the number of items.
    """
    names = category.select(F.col("product_category_name_english").alias("category")).filter("category IS NOT NULL").distinct()
    return names.select("category", (F.row_number().over(Window.orderBy(F.desc("category"))) - 1).cast("long").alias("number"))


def items_per_order(items: DataFrame, products: DataFrame, category: DataFrame) -> DataFrame:
    """Totals, distinct sellers and categories, and the most frequent category of each order.

    Categories are numbered, so that a category's items and its number fit into one long, votes above the number: the
    favourite is a maximum of fixed width, and ties go to the smallest name. The items are grouped by (order, category
    number) with the sums, and by (order, seller) over two columns; both are then counted per order and joined. All steps
    are hash aggregates that combine before their shuffle, and no row is copied for a distinct count.
    """
    named = numbered_categories(category)
    translated = category.select("product_category_name", F.col("product_category_name_english").alias("category"))
    numbers = translated.join(named, "category", "left").select("product_category_name", "number")
    by_product = products.select("product_id", "product_category_name").join(numbers, "product_category_name", "left")
    known = items.filter(F.col("order_id").isNotNull())
    votes = F.shiftleft(F.col("rows"), _NUMBER_BITS) + F.col("number")
    by_category = (
        known.join(by_product.select("product_id", "number"), "product_id", "left")
        .groupBy("order_id", "number")
        .agg(
            F.sum("price").alias("price"),
            F.sum("freight_value").alias("freight"),
            F.count("order_item_id").alias("items"),
            F.count(F.lit(1)).alias("rows"),
        )
        .groupBy("order_id")
        .agg(
            sum_or_zero("price").alias("total_price"),
            sum_or_zero("freight").alias("total_freight"),
            F.sum("items").alias("item_count"),
            F.count("number").alias("unique_categories"),
            F.max(votes).alias("_most"),
        )
    )
    sellers = known.filter("seller_id IS NOT NULL").select("order_id", "seller_id").distinct()
    by_seller = sellers.groupBy("order_id").agg(F.count(F.lit(1)).alias("unique_sellers"))
    # Grouped by number, the names are known to be one each: a plan that uses no column of the items then drops them whole.
    names = named.groupBy("number").agg(F.get(F.collect_list("category"), F.lit(0)).alias("top_category"))
    favourite = F.col("_most").bitwiseAND(F.lit((1 << _NUMBER_BITS) - 1))
    return (
        by_category.join(by_seller, "order_id", "left")
        .withColumn("number", favourite)
        .join(names, "number", "left")
        .select(
            "order_id",
            "total_price",
            "total_freight",
            "item_count",
            F.coalesce("unique_sellers", F.lit(0)).alias("unique_sellers"),
            "unique_categories",
            "top_category",
        )
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    return (
        payments.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            sum_or_zero("payment_value").alias("payment_value"),
            F.max("payment_installments").alias("max_installments"),
            any_equals("payment_type", "voucher").alias("has_voucher"),
            any_equals("payment_type", "credit_card").alias("is_credit_card"),
            any_equals("payment_type", "boleto").alias("is_boleto"),
        )
    )


def latest_review_per_order(reviews: DataFrame) -> DataFrame:
    """The newest known score, comment length and date of each order, each column on its own.

    A review without date counts as the newest. Equal dates fall back to score (none below any; compared to six places,
    between -400 and 400) and length, so the result does not depend on the row order. Date, score and length are packed
    into one decimal to be ordered by.
    """
    length = F.length(F.coalesce("review_comment_message", F.lit("")))
    score = F.least(F.greatest(F.col("review_score"), F.lit(-400.0)), F.lit(400.0))
    rank = F.coalesce((score * 1_000_000).cast("long") + 400_000_001, F.lit(0).cast("long"))
    sized = reviews.filter(F.col("order_id").isNotNull()).select(
        "order_id",
        "review_score",
        "review_creation_date",
        length.alias("comment_length"),
        packed(
            F.coalesce(micros_since_year_1("review_creation_date"), F.lit(_UNDATED)),
            rank * 10_000_000_000 + length,
            _RANK_DIGITS,
        ).alias("newness"),
    )
    return sized.groupBy("order_id").agg(
        F.max_by("review_score", F.when(F.col("review_score").isNotNull(), F.col("newness"))).alias("review_score"),
        F.max_by("comment_length", "newness").alias("review_comment_length"),
        F.max("review_creation_date").alias("review_creation_date"),
    )


def base_table(tables: CommerceTables, statuses: Iterable[str] = ("delivered",)) -> DataFrame:
    """The order-level base table. Orders without items, payments or reviews keep NULL aggregates."""
    orders = with_customer(orders_with_status(tables.orders, statuses), tables.customers)
    return (
        orders.join(items_per_order(tables.order_items, tables.products, tables.category), "order_id", "left")
        .join(payments_per_order(tables.payments), "order_id", "left")
        .join(latest_review_per_order(tables.reviews), "order_id", "left")
    )
