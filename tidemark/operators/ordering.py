"""Exact global positions without a single-task sort, and what is built on them."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.durable import bucketed, durable
from tidemark.functions import as_timestamp

# monotonically_increasing_id: partition number above bit 33, row number in the partition below
_PARTITION_BITS = 33


def global_running(df: DataFrame, order_by: Sequence[Column | str], sums: Sequence[str] = ()) -> DataFrame:
    """Add ``position`` (from 0), ``total_rows`` and for each of ``sums`` a running and an overall total.

    ``order_by`` must order the rows completely (end it with a unique column), which also keeps the range
    partitions of the sort even. The sorted rows are made durable, because partition numbers are only
    comparable within one execution. With ``sums`` they are stored in buckets of whole partitions, so the running totals
    are taken where the rows lie: the sort is the only step that moves rows. What is broadcast is one row per partition of
    the sort.
    """
    slotted = df.sort(*order_by).withColumn("_slot", F.monotonically_increasing_id())
    slotted = slotted.withColumn("_part", F.shiftright("_slot", _PARTITION_BITS))
    if sums:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        laid = bucketed(slotted, "_part", ["_slot"], buckets)
    else:
        laid = durable(slotted)
    per_part = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{c}") for c in sums])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_part.select(
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(everything).alias("total_rows"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_{c}_before") for c in sums],
        *[F.sum(f"_sum_{c}").over(everything).alias(f"total_{c}") for c in sums],
    )
    upto = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_part = F.col("_slot") - F.shiftleft(F.col("_part"), _PARTITION_BITS)
    placed = laid.join(F.broadcast(offsets), "_part")
    return placed.select(
        *df.columns,
        (F.col("_rows_before") + in_part).alias("position"),
        "total_rows",
        *[(F.col(f"_{c}_before") + F.sum(c).over(upto)).alias(f"running_{c}") for c in sums],
        *[F.col(f"total_{c}") for c in sums],
    )


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float | Fraction]) -> list[float]:
    """Linearly interpolated quantiles of the non-null values; empty if there are none.

    Values are counted first, so many equal values are one row, and then placed by running count. Only the two
    neighbours of each quantile reach the driver. A quantile that falls on a value, or between two equal ones, is that
    value itself; with ``Fraction`` shares the places are exact.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    placed = global_running(values, ["value"], ["n"])
    sized = placed.agg(F.max("total_n")).first()[0]
    if not sized:
        return []
    spots = [(sized - 1) * Fraction(share) for share in shares]
    wanted = sorted({floor(spot) for spot in spots} | {min(floor(spot) + 1, sized - 1) for spot in spots})
    covers = [(F.col("running_n") > rank) & (F.col("running_n") - F.col("n") <= rank) for rank in wanted]
    at = placed.agg(*[F.max(F.when(cover, F.col("value"))).alias(f"v{i}") for i, cover in enumerate(covers)]).first()
    value_at = dict(zip(wanted, at, strict=True))
    found = []
    for spot in spots:
        low = floor(spot)
        below, above = value_at[low], value_at[min(low + 1, sized - 1)]
        found.append(float(below if spot == low or below == above else below + (above - below) * float(spot - low)))
    return found


def first_orders(
    orders: DataFrame, date_col: str = "order_purchase_timestamp", customer_col: str = "customer_unique_id"
) -> DataFrame:
    known = orders.filter(F.col(customer_col).isNotNull())
    return known.groupBy(customer_col).agg(F.min(date_col).alias("first_order_date"))


def chronological_split(
    targets: DataFrame,
    orders: DataFrame | None = None,
    train_fraction: float = 0.80,
    date_col: str = "order_purchase_timestamp",
    customer_col: str = "customer_unique_id",
) -> DataFrame:
    """Targets with ``split``: 'train' for the earliest customers by first order, 'test' for the rest.

    Equal first dates are ordered by customer. ``position`` numbers the customers from the earliest. The first dates
    are taken from ``orders``, or without them from a column ``first_order_date`` of the targets.
    """
    dated = targets
    if orders is not None:
        dated = targets.join(first_orders(orders, date_col, customer_col), customer_col, "left")
    placed = global_running(dated, [F.asc_nulls_last("first_order_date"), F.asc(customer_col)])
    train_rows = F.floor(F.col("total_rows") * F.lit(train_fraction))
    split = F.when(F.col("position") < train_rows, "train").otherwise("test")
    return placed.withColumn("split", split).drop("total_rows")


def chronological_cut(targets: DataFrame, train_fraction: float = 0.80, customer_col: str = "customer_unique_id") -> Column:
    """'train' or 'test' as ``chronological_split`` says, as a column over ``targets`` with ``first_order_date``.

    Only the first customer of the test side is looked up, over two columns; each row is then compared with it where it
    lies, so whatever the targets are partitioned by stays.
    """
    order = [F.asc_nulls_last("first_order_date"), F.asc(customer_col)]
    placed = global_running(targets.select("first_order_date", customer_col), order)
    edge = placed.filter(F.col("position") == F.floor(F.col("total_rows") * F.lit(train_fraction))).first()
    if edge is None:
        return F.lit("train")
    date, customer = F.col("first_order_date"), F.col(customer_col)
    before = customer < F.lit(edge[customer_col])
    if edge["first_order_date"] is None:
        earlier = date.isNotNull() | before
    else:
        at = as_timestamp(edge["first_order_date"])
        earlier = date.isNotNull() & ((date < at) | ((date == at) & before))
    return F.when(earlier, "train").otherwise("test")


def time_series_folds(df: DataFrame, order_by: Sequence[Column | str], folds: int = 5) -> DataFrame:
    """Add ``fold``: rows of fold i are validated by a model of all rows with a smaller fold number.

    The last ``folds`` blocks of n // (folds + 1) rows are numbered 1..folds, everything earlier is 0.
    """
    placed = global_running(df, order_by)
    size = F.floor(F.col("total_rows") / F.lit(folds + 1))
    from_start = F.col("position") - (F.col("total_rows") - size * folds)
    fold = F.when(from_start >= 0, F.floor(F.try_divide(from_start, size)) + 1).otherwise(0)
    return placed.withColumn("fold", fold.cast("int")).drop("total_rows")


def stratified_folds(df: DataFrame, label_col: str, id_col: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` in 0..folds-1: every class is shuffled by a seeded digest of the id and dealt out evenly."""
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    placed = global_running(df, [F.asc(label_col), shuffled, F.asc(id_col)])
    starts = placed.groupBy(F.col(label_col).alias("_class")).agg(F.min("position").alias("_start"))
    placed = placed.join(starts, F.col(label_col).eqNullSafe(F.col("_class")))
    fold = F.pmod(F.col("position") - F.col("_start"), F.lit(folds))
    return placed.withColumn("fold", fold.cast("int")).drop("total_rows", "position", "_class", "_start")
