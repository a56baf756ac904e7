"""Small hand-made tables."""

from datetime import datetime

ORDER_COLUMNS = (
    "order_id string, customer_unique_id string, order_purchase_timestamp timestamp_ntz, payment_value double, "
    "max_installments int, has_voucher int, item_count bigint, total_price double, total_freight double, "
    "unique_categories bigint, unique_sellers bigint, review_score double, order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz, customer_state string"
)
_NAMES = [part.split()[0] for part in ORDER_COLUMNS.split(", ")]


def at(text):
    return None if text is None else datetime.fromisoformat(text)


def order(order_id, customer, placed, value=10.0, **other):
    row = {
        "max_installments": 1,
        "has_voucher": 0,
        "item_count": 1,
        "total_price": value,
        "total_freight": 1.0,
        "unique_categories": 1,
        "unique_sellers": 1,
        "review_score": None,
        "order_delivered_customer_date": None,
        "order_estimated_delivery_date": None,
        "customer_state": "SP",
        **other,
        "order_id": order_id,
        "customer_unique_id": customer,
        "order_purchase_timestamp": at(placed),
        "payment_value": value,
    }
    for name in ("order_delivered_customer_date", "order_estimated_delivery_date"):
        if isinstance(row[name], str):
            row[name] = at(row[name])
    return tuple(row[name] for name in _NAMES)


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDER_COLUMNS)


REQUEST_ORDER = {
    "order_id": "r-1",
    "order_purchase_timestamp": at("2018-02-20T08:15:00"),
    "payment_value": 64.25,
    "payment_installments": 4,
    "order_item_count": 3,
    "freight_value": 7.75,
    "review_score": 2.0,
    "customer_state": "SP",
    "order_delivered_customer_date": at("2018-03-01T11:00:00"),
    "order_estimated_delivery_date": at("2018-03-06T00:00:00"),
}


def request(request_id, *changes, customer="shopper-7", cutoff="2018-07-01"):
    """A request of one order per change; ``{}`` is the unchanged sample order."""
    made = [{**REQUEST_ORDER, **change} for change in changes]
    return (request_id, customer, at(cutoff), made)
