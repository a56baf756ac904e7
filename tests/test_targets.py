import pytest
from fixtures import order, orders

from tidemark.operators import targets


def test_targets(spark):
    history = orders(
        spark,
        [
            order("1", "returns", "2018-06-30T23:59:59"),
            order("2", "returns", "2018-07-01T00:00:00", 5.0),  # the cutoff itself is inside
            order("3", "returns", "2018-09-29T00:00:00", 7.0),  # 90 days later is outside
            order("4", "unpaid", "2018-01-01"),
            order("5", "unpaid", "2018-07-02", None),
            order("6", "gone", "2018-01-01"),
            order("7", "new", "2018-07-02"),
            order("8", None, "2018-01-01"),
        ],
    )
    found = {r["customer_unique_id"]: (r["future_spend"], r["will_return"]) for r in targets.customer_targets(history, "2018-07-01").collect()}
    assert found == {"returns": (5.0, 1), "unpaid": (0.0, 0), "gone": (0.0, 0)}


def spends(spark, values):
    rows = [(i, float(v), int(v > 0)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "customer_unique_id int, future_spend double, will_return int")


def test_tier_edges_interpolate_and_close_on_the_right(spark):
    import numpy as np

    values = [3, 1, 4, 1.5, 9, 2.6, 5.3, 0, 0]
    found = targets.tier_edges(spends(spark, values))
    positive = [v for v in values if v > 0]
    assert found == pytest.approx(list(np.quantile(positive, [1 / 3, 2 / 3])), abs=1e-9)
    tiers = targets.with_spend_tier(spends(spark, values), found)
    by_value = {r["future_spend"]: r["spend_tier"] for r in tiers.collect()}
    assert by_value[0.0] == -1
    assert by_value[2.6] == 0  # an edge is a value here (7 returners): it belongs to the lower tier
    assert [by_value[v] for v in (1.0, 3.0, 4.0, 5.3, 9.0)] == [0, 1, 1, 2, 2]
    assert [(r["spend_tier"], r["customers"]) for r in targets.tier_counts(tiers).collect()] == [(0, 3), (1, 2), (2, 2)]


def test_coinciding_edges_are_an_error(spark):
    with pytest.raises(ValueError, match="coincide"):
        targets.tier_edges(spends(spark, [2, 2, 2, 2, 2, 3]))


@pytest.mark.parametrize("values", [[1, 2, 3, 3, 3, 3], [1, 1, 1, 1, 2, 3], [5]])
def test_edge_on_the_smallest_or_largest_spend_is_an_error(spark, values):
    with pytest.raises(ValueError, match="coincide"):
        targets.tier_edges(spends(spark, values))


def test_customers_that_tie_at_an_edge_share_the_lower_tier(spark):
    long_tail = 0.1 + 0.2
    values = [long_tail, long_tail, long_tail, 0.2, 1, 2, 3]
    found = spends(spark, values)
    tiers = targets.with_spend_tier(found, targets.tier_edges(found))
    assert {r["spend_tier"] for r in tiers.filter(f"future_spend = {long_tail!r}D").collect()} == {0}


def test_no_returner_is_an_error(spark):
    with pytest.raises(ValueError, match="returner"):
        targets.tier_edges(spends(spark, [0, 0]))


def test_approximate_edges(spark):
    exact = targets.tier_edges(spends(spark, range(1, 1000)))
    assert targets.tier_edges(spends(spark, range(1, 1000)), approximate=True) == pytest.approx(exact, abs=1)
