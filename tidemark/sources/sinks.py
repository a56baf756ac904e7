"""Base table sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import bucketed

CUSTOMER, PURCHASED = "customer_unique_id", "order_purchase_timestamp"
# The number of buckets, kept beside the files where Spark does not look for data
BUCKETING = "_bucketing"


def write_base_table(base: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store the base table by month of purchase.

    The rebalance hint gathers each month into files of the advisory size and lets adaptive execution split a
    month that is far larger than the others, so neither tiny files nor one long task result.
    """
    dated = base.withColumn("purchase_month", F.trunc("order_purchase_timestamp", "MM"))
    dated.hint("rebalance", "purchase_month").write.mode(mode).partitionBy("purchase_month").parquet(path)


def write_bucketed_base_table(base: DataFrame, path: str, buckets: int | None = None) -> None:
    """Store the base table in ``buckets`` buckets by customer, sorted by customer and time of purchase.

    What groups or joins by customer then runs where the rows lie: features, targets, and the join of both shuffle nothing.
    ``buckets`` (by default the session's shuffle partitions) should make files of a few hundred MB. One task writes each
    bucket, so there is one file a bucket. Orders without a customer share a bucket.
    """
    spark = base.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed(base.repartition(count, CUSTOMER), CUSTOMER, [CUSTOMER, PURCHASED], count, path)
    spark.createDataFrame([(count,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/{BUCKETING}")
