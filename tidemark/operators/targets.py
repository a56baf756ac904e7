"""What each customer did after the cutoff."""

from __future__ import annotations

from datetime import datetime
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_timestamp, days_after, sum_or_zero
from tidemark.operators.ordering import exact_quantiles


def customer_targets(
    orders: DataFrame,
    cutoff: datetime | str,
    horizon_days: int = 90,
    date_col: str = "order_purchase_timestamp",
    customer_col: str = "customer_unique_id",
    value_col: str = "payment_value",
    first_order: bool = False,
) -> DataFrame:
    """``future_spend`` in [cutoff, cutoff + horizon) and ``will_return`` for all customers known before the cutoff.

    Eligibility and spend come from one conditional aggregation instead of a semi join, an aggregate and a left
    join. A customer whose later orders carry no payment is not a returner. With ``first_order`` the same pass also
    gives ``first_order_date``, which ``chronological_split`` needs.
    """
    start = as_timestamp(cutoff)
    inside = F.col(date_col) >= start
    spend = (
        orders.filter((F.col(date_col) < days_after(start, horizon_days)) & F.col(customer_col).isNotNull())
        .groupBy(customer_col)
        .agg(
            F.count(F.when(~inside, 1)).alias("orders_before"),
            sum_or_zero(F.when(inside, F.col(value_col))).alias("future_spend"),
            F.min(date_col).alias("first_order_date"),
        )
    )
    return spend.filter("orders_before > 0").select(
        customer_col,
        "future_spend",
        (F.col("future_spend") > 0).cast("int").alias("will_return"),
        *(["first_order_date"] if first_order else []),
    )


def tier_edges(targets: DataFrame, tiers: int = 3, approximate: bool = False) -> list[float]:
    """Inner edges that cut the returners' spend into equally filled tiers.

    An edge that coincides with another one, or with the smallest or largest spend, is an error: a tier would be empty
    or hold customers of two.
    """
    shares = [Fraction(i, tiers) for i in range(tiers + 1)]
    returners = targets.filter("will_return = 1")
    if approximate:
        edges = returners.agg(F.percentile_approx("future_spend", [float(s) for s in shares], 100_000)).first()[0]
    else:
        edges = exact_quantiles(returners, "future_spend", shares)
    if not edges:
        raise ValueError("spend tiers need at least one returner")
    if len(set(edges)) < len(edges):
        raise ValueError(f"spend tiers coincide: {edges}")
    return edges[1:-1]


def with_spend_tier(targets: DataFrame, edges: list[float]) -> DataFrame:
    """Add ``spend_tier``: 0 up to the first edge, 1 up to the second, ...; -1 for non-returners."""
    tier = F.when(F.col("will_return") == 0, -1)
    for number, edge in enumerate(edges):
        tier = tier.when(F.col("future_spend") <= F.lit(edge), number)
    return targets.withColumn("spend_tier", tier.otherwise(len(edges)))


def tier_counts(targets: DataFrame) -> DataFrame:
    """Returners per tier, in tier order."""
    return (
        targets.filter("will_return = 1")
        .groupBy("spend_tier")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy("spend_tier")
    )
