"""The commerce tables, derived from the star-schema test tables.

The star schema has no payments and no reviews. Both are derived from order keys by plain arithmetic, so that
another engine can derive the same rows (see ``tidemark/plans/oracles.py``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _interval(days: Column | None = None, hours: Column | None = None) -> Column:
    zero = F.lit(0)
    return F.make_dt_interval(
        zero if days is None else days.cast("int"),
        zero if hours is None else hours.cast("int"),
    )


# Types of the star-schema columns used here. Declaring them saves a schema pass per query.
_STAR = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_brand string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, "
    "l_tax double",
}


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One star-schema table."""
    return spark.read.schema(_STAR[name]).parquet(f"{folder}/{name}.parquet")


class StarCommerce:
    """The commerce tables over a star-schema folder, each built when it is first asked for."""

    sellers = None

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder
        self._read: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = star_table(self._spark, self._folder, name)
        return self._read[name]

    @cached_property
    def customers(self) -> DataFrame:
        nations = self._table("nation")
        return (
            self._table("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                (F.col("c_custkey") - F.col("c_custkey") % 2).alias("customer_unique_id"),
                F.col("n_name").alias("customer_state"),
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        key, placed = F.col("o_orderkey"), F.col("o_orderdate")
        return self._table("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "O", "shipped")
            .when(F.col("o_orderstatus") == "P", "canceled")
            .alias("order_status"),
            (placed + _interval(hours=key % 24)).alias("order_purchase_timestamp"),
            F.when(key % 37 != 0, placed + _interval(1 + key % 29, key % 23)).alias("order_delivered_customer_date"),
            (placed + _interval(F.lit(20))).alias("order_estimated_delivery_date"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self._table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.when(F.col("l_orderkey") % 101 == 0, 0.0).otherwise(F.col("l_extendedprice")).alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_partkey") % 50 != 0, F.col("p_brand")).alias("product_category_name"),
        )

    @cached_property
    def category(self) -> DataFrame:
        english = F.concat(F.lit("cat_"), F.expr("substr(product_category_name, 7)"))
        return (
            self._table("part")
            .select(F.col("p_brand").alias("product_category_name"))
            .filter(F.col("product_category_name") != "Brand#9")
            .distinct()
            .withColumn("product_category_name_english", english)
        )

    @cached_property
    def payments(self) -> DataFrame:
        key, total = F.col("o_orderkey"), F.col("o_totalprice")
        main = F.struct(
            F.when(key % 3 == 0, "boleto").otherwise("credit_card").alias("payment_type"),
            (1 + key % 10).cast("int").alias("payment_installments"),
            total.alias("payment_value"),
        )
        voucher = F.struct(
            F.lit("voucher").alias("payment_type"),
            F.lit(1).alias("payment_installments"),
            (total * 0.05).alias("payment_value"),
        )
        both = F.when(key % 7 == 0, F.array(main, voucher)).otherwise(F.array(main))
        return self._table("orders").filter(key % 41 != 0).select(key.alias("order_id"), F.inline(both))

    @cached_property
    def reviews(self) -> DataFrame:
        key, placed = F.col("o_orderkey"), F.col("o_orderdate")
        first = F.struct(
            F.when(key % 13 != 0, (1 + key % 5).cast("double")).alias("review_score"),
            (placed + _interval(F.lit(35))).alias("review_creation_date"),
            F.when(key % 2 == 0, F.col("o_orderpriority")).alias("review_comment_message"),
        )
        second = F.struct(
            F.when(key % 3 != 0, 5.0).alias("review_score"),
            (placed + _interval(F.lit(40))).alias("review_creation_date"),
            F.lit("second").alias("review_comment_message"),
        )
        both = F.when(key % 10 == 1, F.array(first, second)).otherwise(F.array(first))
        return self._table("orders").filter(key % 4 != 0).select(key.alias("order_id"), F.inline(both))


def commerce_tables(spark: SparkSession, folder: str) -> StarCommerce:
    """Commerce tables over ``folder``'s nation, customer, part, orders and lineitem files."""
    return StarCommerce(spark, folder)
