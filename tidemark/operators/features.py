"""Leak-free customer features as of a cutoff.

Every family is a list of aggregates over the orders strictly before the cutoff. ``feature_matrix`` takes all families from
one chain: partial states per customer and day, merged per customer. ``cutoff`` is a literal, or a column that is among the grouping columns
``by`` (one cutoff per scoring request).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.durable import durable
from tidemark.functions import as_timestamp, days_after, micros_since_year_1, packed, share_above, sum_or_zero, whole_days

CUSTOMER = "customer_unique_id"
PURCHASED = "order_purchase_timestamp"
VALUE = "payment_value"
WINDOWS = (30, 60)
STATE_SALTS = 32
STATE_DIGEST = "state_digest"
# Digits of a 64-bit number above 0; with 18 for the time they fill a decimal.
_ID_DIGITS = 20

Cutoff = Column | datetime | str


def history(orders: DataFrame, cutoff: Cutoff, by: Sequence[str] = (CUSTOMER,), date_col: str = PURCHASED) -> DataFrame:
    """Orders strictly before the cutoff that belong to somebody."""
    known = F.col(date_col) < as_timestamp(cutoff)
    for name in by:
        known = known & F.col(name).isNotNull()
    return orders.filter(known)


def _rfm(cutoff: Column, date_col: str, value_col: str) -> list[Column]:
    orders, spend = F.count(date_col), sum_or_zero(value_col)
    return [
        whole_days(cutoff, F.max(date_col)).alias("recency"),
        orders.alias("frequency"),
        spend.alias("monetary"),
        (spend / orders).alias("avg_order_value"),
    ]


def _behavioral() -> list[Column]:
    return [
        # distinct counts per order, summed: something bought in two orders counts twice
        F.coalesce(F.sum("unique_categories"), F.lit(0)).alias("unique_categories"),
        F.coalesce(F.sum("unique_sellers"), F.lit(0)).alias("unique_sellers"),
        F.avg("review_score").alias("avg_review_score"),
        F.avg("item_count").alias("avg_items_per_order"),
        F.avg(F.try_divide("total_freight", "total_price")).alias("avg_freight_ratio"),
        share_above("max_installments", 1).alias("pct_installments"),
        F.max("has_voucher").alias("has_voucher"),
    ]


def _velocity(cutoff: Column, windows: Sequence[int], date_col: str, value_col: str) -> list[Column]:
    found = []
    for days in windows:
        recent = F.col(date_col) >= days_after(cutoff, -days)
        found.append(F.count(F.when(recent, F.col("order_id"))).alias(f"orders_last_{days}d"))
        found.append(sum_or_zero(F.when(recent, F.col(value_col))).alias(f"spend_last_{days}d"))
    return found + [(F.count("order_id") > 1).cast("int").alias("is_repeat_customer")]


def _delivery() -> list[Column]:
    delay = whole_days("order_delivered_customer_date", "order_estimated_delivery_date")
    return [
        F.avg(delay).alias("avg_delivery_delay_days"),
        share_above(delay, 0).alias("pct_late_deliveries"),
        F.avg(whole_days("order_delivered_customer_date", PURCHASED)).alias("avg_delivery_speed_days"),
    ]


def order_gaps(past: DataFrame, by: Sequence[str] = (CUSTOMER,), date_col: str = PURCHASED) -> DataFrame:
    """Mean whole days between consecutive orders; NULL for a single order.

    Orders of the same day lie 0 days apart, so first and last order and the number of orders of each day are
    enough. The window then sees at most one row per customer and day, however many orders a customer has.
    """
    days = past.groupBy(*by, F.col(date_col).cast("date").alias("day")).agg(
        F.min(date_col).alias("first_at"), F.max(date_col).alias("last_at"), F.count(F.lit(1)).alias("orders")
    )
    earlier = F.lag("last_at").over(Window.partitionBy(*by).orderBy("day"))
    return (
        days.withColumn("gap", whole_days(F.col("first_at"), earlier))
        .groupBy(*by)
        .agg(F.try_divide(F.coalesce(F.sum("gap"), F.lit(0)), F.sum("orders") - 1).alias("avg_order_gap_days"))
    )


def newness(df: DataFrame, date_col: str = PURCHASED, id_col: str = "order_id") -> Column:
    """What orders by time, equal times by greater order id (by greater digest of an id that is not an integer)."""
    kind = df.schema[id_col].dataType
    number = F.col(id_col).cast("long") if isinstance(kind, IntegralType) else F.xxhash64(id_col)
    above_zero = number.cast("decimal(20,0)") + F.lit(Decimal(1 << 63)).cast("decimal(20,0)")
    return packed(micros_since_year_1(date_col), F.coalesce(above_zero, F.lit(0).cast("decimal(20,0)")), _ID_DIGITS)


def latest_state(past: DataFrame, by: Sequence[str] = (CUSTOMER,), date_col: str = PURCHASED) -> DataFrame:
    """The known state of each customer's newest order, by ``newness``."""
    order = F.when(F.col("customer_state").isNotNull(), newness(past, date_col))
    return past.groupBy(*by).agg(F.max_by("customer_state", order).alias("customer_state"))


def state_counts(states: DataFrame) -> DataFrame:
    """Number of customers per known state."""
    known = states.filter(F.col("customer_state").isNotNull())
    return known.groupBy("customer_state").agg(F.count(F.lit(1)).alias("customer_state_freq"))


def state_frequency(past: DataFrame, counts: DataFrame | None = None, by: Sequence[str] = (CUSTOMER,)) -> DataFrame:
    """Each customer with the number of customers of the same state.

    ``counts`` are stored frequencies to look up; without them they are counted here. Spark broadcasts them if
    they measure small at run time. If they do not, one state may still hold a third of the customers, and adaptive
    execution does not split a join whose other side is an aggregate on the same key. So customers of a state are
    dealt over several salts, and each salt gets its copy of the counts.
    """
    states = latest_state(past, by)
    counted = state_counts(states) if counts is None else counts
    return _looked_up(states, counted, "customer_state", by).select(*by, "customer_state_freq")


def rfm_features(
    orders: DataFrame,
    cutoff: Cutoff,
    customer_col: str = CUSTOMER,
    date_col: str = PURCHASED,
    value_col: str = VALUE,
) -> DataFrame:
    past = history(orders, cutoff, [customer_col], date_col)
    return past.groupBy(customer_col).agg(*_rfm(as_timestamp(cutoff), date_col, value_col))


def behavioral_features(orders: DataFrame, cutoff: Cutoff, customer_col: str = CUSTOMER) -> DataFrame:
    return history(orders, cutoff, [customer_col]).groupBy(customer_col).agg(*_behavioral())


def temporal_features(
    orders: DataFrame,
    cutoff: Cutoff,
    customer_col: str = CUSTOMER,
    date_col: str = PURCHASED,
    windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    past = history(orders, cutoff, [customer_col], date_col)
    velocity = past.groupBy(customer_col).agg(*_velocity(as_timestamp(cutoff), windows, date_col, VALUE))
    return velocity.join(order_gaps(past, [customer_col], date_col), customer_col)


def delivery_features(
    orders: DataFrame, cutoff: Cutoff, customer_col: str = CUSTOMER, counts: DataFrame | None = None
) -> DataFrame:
    past = history(orders, cutoff, [customer_col])
    delivery = past.groupBy(customer_col).agg(*_delivery())
    return delivery.join(state_frequency(past, counts, [customer_col]), customer_col)


def day_states(orders: DataFrame, cutoff: Cutoff, by: Sequence[str] = (CUSTOMER,), windows: Sequence[int] = WINDOWS) -> DataFrame:
    """One row per ``by`` and day of purchase before the cutoff, with what all features need of that day's orders.

    Sums, counts and extremes of fixed width. A state is held as its 64-bit digest, because a string buffer would turn the
    hash aggregation into a sort: two of S states share a digest with a chance of S^2 / 2^65.
    """
    past, start = history(orders, cutoff, by), as_timestamp(cutoff)
    delay = whole_days("order_delivered_customer_date", "order_estimated_delivery_date")
    averaged = {
        "review_score": F.col("review_score"),
        "items": F.col("item_count"),
        "freight_ratio": F.try_divide("total_freight", "total_price"),
        "delay": delay,
        "speed": whole_days("order_delivered_customer_date", PURCHASED),
    }
    parts = [
        F.min(PURCHASED).alias("first_at"),
        F.max(PURCHASED).alias("last_at"),
        F.count(F.lit(1)).alias("orders"),
        F.count("order_id").alias("ids"),
        F.sum(VALUE).alias("spend"),
        F.sum("unique_categories").alias("categories"),
        F.sum("unique_sellers").alias("sellers"),
        F.count_if(F.col("max_installments") > 1).alias("in_instalments"),
        F.count_if(delay > 0).alias("late"),
        F.max("has_voucher").alias("has_voucher"),
    ]
    for name, value in averaged.items():
        parts += [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]
    for days in windows:
        recent = F.col(PURCHASED) >= days_after(start, -days)
        parts.append(F.count(F.when(recent, F.col("order_id"))).alias(f"orders_{days}"))
        parts.append(F.sum(F.when(recent, F.col(VALUE))).alias(f"spend_{days}"))
    known = F.when(F.col("customer_state").isNotNull(), newness(past))
    parts += [F.max_by(F.xxhash64("customer_state"), known).alias(STATE_DIGEST), F.max(known).alias("state_newness")]
    return past.groupBy(*by, F.col(PURCHASED).cast("date").alias("day")).agg(*parts)


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def merged_days(days: DataFrame, cutoff: Cutoff, by: Sequence[str] = (CUSTOMER,), windows: Sequence[int] = WINDOWS) -> DataFrame:
    """All features but the state frequency, from ``day_states``, and the digest of the latest state.

    Orders of one day lie 0 whole days apart, so first and last order of each day are enough for the gaps, and the window
    sees one row per customer and day, however many orders a customer has.
    """
    earlier = F.lag("last_at").over(Window.partitionBy(*by).orderBy("day"))
    orders, spend = F.sum("orders"), sum_or_zero("spend")
    recent = []
    for n in windows:
        recent.append(F.sum(f"orders_{n}").alias(f"orders_last_{n}d"))
        recent.append(sum_or_zero(f"spend_{n}").alias(f"spend_last_{n}d"))
    return (
        days.withColumn("gap", whole_days(F.col("first_at"), earlier))
        .groupBy(*by)
        .agg(
            whole_days(as_timestamp(cutoff), F.max("last_at")).alias("recency"),
            orders.alias("frequency"),
            spend.alias("monetary"),
            (spend / orders).alias("avg_order_value"),
            F.coalesce(F.sum("categories"), F.lit(0)).alias("unique_categories"),
            F.coalesce(F.sum("sellers"), F.lit(0)).alias("unique_sellers"),
            _mean("review_score").alias("avg_review_score"),
            _mean("items").alias("avg_items_per_order"),
            _mean("freight_ratio").alias("avg_freight_ratio"),
            (F.sum("in_instalments") / orders).alias("pct_installments"),
            F.max("has_voucher").alias("has_voucher"),
            *recent,
            F.try_divide(F.coalesce(F.sum("gap"), F.lit(0)), orders - 1).alias("avg_order_gap_days"),
            (F.sum("ids") > 1).cast("int").alias("is_repeat_customer"),
            _mean("delay").alias("avg_delivery_delay_days"),
            (F.sum("late") / orders).alias("pct_late_deliveries"),
            _mean("speed").alias("avg_delivery_speed_days"),
            F.max_by(STATE_DIGEST, "state_newness").alias(STATE_DIGEST),
        )
    )


def feature_numbers(orders: DataFrame, cutoff: Cutoff, by: Sequence[str] = (CUSTOMER,), windows: Sequence[int] = WINDOWS) -> DataFrame:
    """All features but the state frequency, and ``state_digest``, from one chain over one scan of the orders.

    The rows of a day are combined before they move, by customer and day; one row per customer and day then moves by
    customer. Over a base table that is bucketed by customer nothing moves.
    """
    return merged_days(day_states(orders, cutoff, by, windows), cutoff, by, windows)


def with_state_frequency(numbers: DataFrame, counts: DataFrame | None = None, by: Sequence[str] = (CUSTOMER,)) -> DataFrame:
    """``customer_state_freq`` instead of ``state_digest``: looked up in ``counts``, or counted among the rows.

    To be counted and looked up, the rows are made durable, which saves a second run of what made them. The lookup is
    salted as in ``state_frequency``.
    """
    if counts is None:
        numbers = durable(numbers)
        known = numbers.filter(F.col(STATE_DIGEST).isNotNull())
        counted = known.groupBy(STATE_DIGEST).agg(F.count(F.lit(1)).alias("customer_state_freq"))
    else:
        counted = counts.select(F.xxhash64("customer_state").alias(STATE_DIGEST), "customer_state_freq")
    return _looked_up(numbers, counted, STATE_DIGEST, by).drop(STATE_DIGEST)


def _looked_up(rows: DataFrame, counted: DataFrame, state_col: str, by: Sequence[str]) -> DataFrame:
    """``rows`` with their state's count. A crowded state is dealt over several salts, each with its copy of the counts."""
    salted = rows.withColumn("_salt", F.pmod(F.hash(*by), F.lit(STATE_SALTS)))
    copies = counted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(STATE_SALTS - 1))))
    return salted.join(copies, [state_col, "_salt"], "left").drop("_salt")


def feature_matrix(
    orders: DataFrame,
    cutoff: Cutoff,
    by: Sequence[str] = (CUSTOMER,),
    windows: Sequence[int] = WINDOWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """All features, one row per customer with an order before the cutoff.

    ``counts`` are stored state frequencies to look up; without them they are counted among these customers.
    """
    found = with_state_frequency(feature_numbers(orders, cutoff, by, windows), counts, by)
    return found.select(*by, *[c for c in found.columns if c not in by])
