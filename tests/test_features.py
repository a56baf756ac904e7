import pytest
from fixtures import at, order, orders
from pyspark.sql import functions as F

from tidemark.operators import features
from tidemark.settings import BEHAVIORAL_FEATURES, DELIVERY_FEATURES, FEATURES, RFM_FEATURES, TEMPORAL_FEATURES

CUTOFF = "2018-06-01"


@pytest.fixture
def sample(spark):
    start = at(CUTOFF)
    from datetime import timedelta

    rows = [("customer_a", -90, 100.0), ("customer_a", -30, 200.0), ("customer_a", -5, 50.0), ("customer_a", 10, 999.0), ("customer_b", -60, 75.0)]
    return spark.createDataFrame(
        [(c, start + timedelta(days=d), v) for c, d, v in rows],
        "customer_unique_id string, order_purchase_timestamp timestamp_ntz, payment_value double",
    )


def by_customer(df):
    return {row["customer_unique_id"]: row for row in df.collect()}


def test_rfm_does_not_see_the_future(sample):
    assert by_customer(features.rfm_features(sample, CUTOFF))["customer_a"]["monetary"] == pytest.approx(350.0)


def test_rfm_frequency(sample):
    assert by_customer(features.rfm_features(sample, CUTOFF))["customer_a"]["frequency"] == 3


def test_rfm_recency(sample):
    assert by_customer(features.rfm_features(sample, CUTOFF))["customer_a"]["recency"] == 5


def test_rfm_schema_and_grain(sample):
    found = features.rfm_features(sample, CUTOFF)
    assert set(found.columns) == {"customer_unique_id", *RFM_FEATURES}
    assert found.count() == 2


def test_rfm_column_names_can_be_overridden(sample):
    renamed = sample.toDF("who", "placed", "paid")
    found = features.rfm_features(renamed, CUTOFF, customer_col="who", date_col="placed", value_col="paid")
    assert {row["who"]: row["monetary"] for row in found.collect()} == {"customer_a": 350.0, "customer_b": 75.0}


@pytest.fixture
def history(spark):
    return orders(
        spark,
        [
            order("1", "a", "2018-01-01T10:00:00", 100.0, max_installments=3, review_score=4.0, total_freight=20.0,
                  order_delivered_customer_date="2018-01-10T00:00:00", order_estimated_delivery_date="2018-01-10T12:00:00"),
            order("2", "a", "2018-05-20T09:00:00", None, max_installments=None, review_score=2.0, total_price=0.0, has_voucher=1,
                  order_delivered_customer_date="2018-05-27T09:00:00", order_estimated_delivery_date="2018-05-25T00:00:00",
                  customer_state=None),
            order("3", "a", "2018-05-20T21:00:00", 50.0, item_count=3, total_freight=5.0, customer_state="RJ",
                  unique_categories=2),
            order("4", "a", "2018-06-01T00:00:00", 999.0, customer_state="MG"),
            order("5", "b", "2018-04-02T00:00:00", 7.0, customer_state="RJ"),
            order("6", "c", "2018-05-01T00:00:00", 8.0, customer_state=None),
            order("7", None, "2018-05-01T00:00:00", 8.0),
            order("8", "d", "2018-07-01T00:00:00", 8.0),
        ],
    )


def test_behavioral(history):
    row = by_customer(features.behavioral_features(history, CUTOFF))["a"]
    assert (row["unique_categories"], row["unique_sellers"], row["has_voucher"]) == (4, 3, 1)
    assert row["avg_review_score"] == 3.0
    assert row["avg_items_per_order"] == pytest.approx(5 / 3)
    assert row["avg_freight_ratio"] == pytest.approx((0.2 + 0.1) / 2)  # no ratio for goods of price 0
    assert row["pct_installments"] == pytest.approx(1 / 3)  # unknown instalments stay in the denominator


def test_temporal(history):
    found = by_customer(features.temporal_features(history, CUTOFF))
    a = found["a"]
    assert (a["orders_last_30d"], a["spend_last_30d"]) == (2, 50.0)
    assert (a["orders_last_60d"], a["spend_last_60d"]) == (2, 50.0)
    assert a["avg_order_gap_days"] == pytest.approx((138 + 0) / 2)  # 138 days and 23 hours, then 12 hours
    assert a["is_repeat_customer"] == 1
    b = found["b"]
    assert (b["orders_last_30d"], b["orders_last_60d"], b["spend_last_30d"]) == (0, 1, 0.0)  # on the 60 day bound
    assert (b["avg_order_gap_days"], b["is_repeat_customer"]) == (None, 0)


def test_temporal_windows_are_a_parameter(history):
    found = features.temporal_features(history, CUTOFF, windows=[7, 365])
    assert {"orders_last_7d", "spend_last_365d"} <= set(found.columns)
    assert by_customer(found)["a"]["orders_last_365d"] == 3


def test_delivery(history):
    found = by_customer(features.delivery_features(history, CUTOFF))
    a = found["a"]
    assert a["avg_delivery_delay_days"] == pytest.approx((-1 + 2) / 2)  # half a day early is -1
    assert a["pct_late_deliveries"] == pytest.approx(1 / 3)  # an undelivered order is not late
    assert a["avg_delivery_speed_days"] == pytest.approx((8 + 7) / 2)
    assert a["customer_state_freq"] == 2  # latest known state RJ, shared with b
    assert found["c"]["customer_state_freq"] is None


def test_state_counts_can_be_given(spark, history):
    counts = spark.createDataFrame([("RJ", 77)], "customer_state string, customer_state_freq bigint")
    assert by_customer(features.delivery_features(history, CUTOFF, counts=counts))["a"]["customer_state_freq"] == 77


def test_matrix_is_the_families_together(history):
    matrix = features.feature_matrix(history, CUTOFF)
    assert set(matrix.columns) == {"customer_unique_id", *FEATURES}
    whole = by_customer(matrix)
    assert set(whole) == {"a", "b", "c"}
    for family, names in (
        (features.rfm_features, RFM_FEATURES),
        (features.behavioral_features, BEHAVIORAL_FEATURES),
        (features.temporal_features, TEMPORAL_FEATURES),
        (features.delivery_features, DELIVERY_FEATURES),
    ):
        for customer, row in by_customer(family(history, CUTOFF)).items():
            assert {n: row[n] for n in names} == {n: whole[customer][n] for n in names}


def test_later_orders_change_nothing(spark, history):
    later = history.withColumn("order_purchase_timestamp", F.lit("2018-06-01 00:00:01").cast("timestamp_ntz"))
    before = by_customer(features.feature_matrix(history, CUTOFF))
    assert by_customer(features.feature_matrix(history.unionByName(later), CUTOFF)) == before


def test_gaps_of_one_very_busy_customer(spark):
    """Half of all orders belong to one customer: gaps equal the plain difference of neighbours."""
    from pyspark.sql import Window

    from tidemark.functions import whole_days

    busy = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "busy").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("customer_unique_id"),
        (F.lit("2017-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("id") * 7919 % 9001).cast("int"))).alias(
            "order_purchase_timestamp"
        ),
    )
    previous = F.lag("order_purchase_timestamp").over(
        Window.partitionBy("customer_unique_id").orderBy("order_purchase_timestamp")
    )
    plain = busy.withColumn("gap", whole_days(F.col("order_purchase_timestamp"), previous)).groupBy("customer_unique_id")
    expected = {r[0]: r[1] for r in plain.agg(F.avg("gap")).collect()}
    found = {r[0]: r[1] for r in features.order_gaps(busy).collect()}
    assert found == pytest.approx(expected)
