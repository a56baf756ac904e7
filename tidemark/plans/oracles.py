"""The registered queries again, as SQL for an independent engine (DuckDB dialect), over the same test tables."""

from __future__ import annotations

# The commerce tables over the star schema; see tidemark/sources/commerce.py.
_TABLES = """
shop_customers AS (
    SELECT c_custkey AS customer_id, c_custkey - c_custkey % 2 AS customer_unique_id, n_name AS customer_state
    FROM customer JOIN nation ON c_nationkey = n_nationkey
),
shop_orders AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' END AS order_status,
        o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) AS order_purchase_timestamp,
        CASE WHEN o_orderkey % 37 <> 0 THEN o_orderdate + INTERVAL '1' DAY * (1 + o_orderkey % 29)
            + INTERVAL '1' HOUR * (o_orderkey % 23) END AS order_delivered_customer_date,
        o_orderdate + INTERVAL '20' DAY AS order_estimated_delivery_date
    FROM orders
),
shop_items AS (
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
        CASE WHEN l_orderkey % 101 = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS price,
        l_extendedprice * l_tax AS freight_value
    FROM lineitem
),
shop_products AS (
    SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 <> 0 THEN p_brand END AS product_category_name FROM part
),
shop_category AS (
    SELECT DISTINCT p_brand AS product_category_name, concat('cat_', substr(p_brand, 7)) AS product_category_name_english
    FROM part WHERE p_brand <> 'Brand#9'
),
shop_payments AS (
    SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 3 = 0 THEN 'boleto' ELSE 'credit_card' END AS payment_type,
        CAST(1 + o_orderkey % 10 AS INTEGER) AS payment_installments, o_totalprice AS payment_value
    FROM orders WHERE o_orderkey % 41 <> 0
    UNION ALL
    SELECT o_orderkey, 'voucher', 1, o_totalprice * 0.05::DOUBLE
    FROM orders WHERE o_orderkey % 41 <> 0 AND o_orderkey % 7 = 0
),
shop_reviews AS (
    SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(1 + o_orderkey % 5 AS DOUBLE) END AS review_score,
        o_orderdate + INTERVAL '35' DAY AS review_creation_date,
        CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS review_comment_message
    FROM orders WHERE o_orderkey % 4 <> 0
    UNION ALL
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 5.0::DOUBLE END, o_orderdate + INTERVAL '40' DAY, 'second'
    FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 10 = 1
),
valid_orders AS (
    SELECT o.*, c.customer_unique_id, c.customer_state
    FROM shop_orders o LEFT JOIN shop_customers c USING (customer_id)
    WHERE order_status IN ('delivered')
),
translated_items AS (
    SELECT i.*, c.product_category_name_english AS category
    FROM shop_items i LEFT JOIN shop_products p USING (product_id) LEFT JOIN shop_category c USING (product_category_name)
),
favourite AS (
    SELECT order_id, category AS top_category FROM (
        SELECT order_id, category, row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, category) AS place
        FROM translated_items WHERE category IS NOT NULL GROUP BY order_id, category
    ) WHERE place = 1
),
order_sums AS (
    SELECT order_id, coalesce(sum(price), 0.0) AS total_price, coalesce(sum(freight_value), 0.0) AS total_freight,
        count(order_item_id) AS item_count, count(DISTINCT seller_id) AS unique_sellers,
        count(DISTINCT category) AS unique_categories
    FROM translated_items GROUP BY order_id
),
order_items AS (SELECT s.*, f.top_category FROM order_sums s LEFT JOIN favourite f USING (order_id)),
order_payments AS (
    SELECT order_id, coalesce(sum(payment_value), 0.0) AS payment_value, max(payment_installments) AS max_installments,
        CAST(bool_or(payment_type = 'voucher') AS INTEGER) AS has_voucher,
        CAST(bool_or(payment_type = 'credit_card') AS INTEGER) AS is_credit_card,
        CAST(bool_or(payment_type = 'boleto') AS INTEGER) AS is_boleto
    FROM shop_payments GROUP BY order_id
),
order_reviews AS (
    SELECT order_id, arg_max(review_score, review_creation_date) AS review_score,
        CAST(arg_max(length(coalesce(review_comment_message, '')), review_creation_date) AS INTEGER) AS review_comment_length,
        max(review_creation_date) AS review_creation_date
    FROM shop_reviews GROUP BY order_id
),
base AS (
    SELECT * FROM valid_orders LEFT JOIN order_items USING (order_id) LEFT JOIN order_payments USING (order_id)
        LEFT JOIN order_reviews USING (order_id)
)"""


def _days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS INTEGER)"


def _r(value: str) -> str:
    return f"round({value} + 1e-9, 6)"


_LATE = _days("order_delivered_customer_date", "order_estimated_delivery_date")


def _feature_ctes(source: str, keys: str, cutoff: str, prefix: str = "", within: str = "") -> str:
    """CTEs that follow the definitions family by family, with a plain window for the gaps."""
    using = f"USING ({keys})"
    scope = f"{within}, " if within else ""
    return f"""
{prefix}past AS (SELECT * FROM {source} WHERE order_purchase_timestamp < {cutoff}),
{prefix}rfm AS (
    SELECT {keys}, {_days(cutoff, "max(order_purchase_timestamp)")} AS recency, count(*) AS frequency,
        coalesce(sum(payment_value), 0.0) AS monetary, coalesce(sum(payment_value), 0.0) / count(*) AS avg_order_value
    FROM {prefix}past GROUP BY {keys}
),
{prefix}behavior AS (
    SELECT {keys}, CAST(coalesce(sum(unique_categories), 0) AS BIGINT) AS unique_categories,
        CAST(coalesce(sum(unique_sellers), 0) AS BIGINT) AS unique_sellers, avg(review_score) AS avg_review_score,
        avg(item_count) AS avg_items_per_order, avg(total_freight / nullif(total_price, 0)) AS avg_freight_ratio,
        avg(CASE WHEN max_installments > 1 THEN 1.0 ELSE 0.0 END) AS pct_installments,
        max(has_voucher) AS has_voucher
    FROM {prefix}past GROUP BY {keys}
),
{prefix}gaps AS (
    SELECT {keys}, avg(gap) AS avg_order_gap_days FROM (
        SELECT {keys}, {_days("order_purchase_timestamp", "previous")} AS gap FROM (
            SELECT {keys}, order_purchase_timestamp,
                lag(order_purchase_timestamp) OVER (PARTITION BY {keys} ORDER BY order_purchase_timestamp, order_id) AS previous
            FROM {prefix}past)
    ) GROUP BY {keys}
),
{prefix}velocity AS (
    SELECT {keys},
        count(*) FILTER (order_purchase_timestamp >= {cutoff} - INTERVAL '30' DAY) AS orders_last_30d,
        coalesce(sum(payment_value) FILTER (order_purchase_timestamp >= {cutoff} - INTERVAL '30' DAY), 0.0) AS spend_last_30d,
        count(*) FILTER (order_purchase_timestamp >= {cutoff} - INTERVAL '60' DAY) AS orders_last_60d,
        coalesce(sum(payment_value) FILTER (order_purchase_timestamp >= {cutoff} - INTERVAL '60' DAY), 0.0) AS spend_last_60d,
        CAST(count(*) > 1 AS INTEGER) AS is_repeat_customer
    FROM {prefix}past GROUP BY {keys}
),
{prefix}delivery AS (
    SELECT {keys}, avg({_LATE}) AS avg_delivery_delay_days,
        avg(CASE WHEN {_LATE} > 0 THEN 1.0 ELSE 0.0 END) AS pct_late_deliveries,
        avg({_days("order_delivered_customer_date", "order_purchase_timestamp")}) AS avg_delivery_speed_days
    FROM {prefix}past GROUP BY {keys}
),
{prefix}states AS (
    SELECT {keys}, (array_agg(customer_state ORDER BY order_purchase_timestamp DESC, order_id DESC)
        FILTER (customer_state IS NOT NULL))[1] AS customer_state
    FROM {prefix}past GROUP BY {keys}
),
{prefix}counted AS (
    SELECT {scope}customer_state, count(*) AS customer_state_freq FROM {prefix}states WHERE customer_state IS NOT NULL
    GROUP BY {scope}customer_state
),
{prefix}frequency AS (
    SELECT {keys}, customer_state_freq FROM {prefix}states LEFT JOIN {prefix}counted USING ({scope}customer_state)
),
{prefix}matrix AS (
    SELECT * FROM {prefix}rfm JOIN {prefix}behavior {using} JOIN {prefix}velocity {using} JOIN {prefix}gaps {using}
        JOIN {prefix}delivery {using} JOIN {prefix}frequency {using}
)"""


_CUTOFF = "TIMESTAMP '2001-01-01'"

_CUSTOMERS = (
    _TABLES
    + ","
    + _feature_ctes("base", "customer_unique_id", _CUTOFF)
    + f""",
future AS (
    SELECT customer_unique_id, sum(payment_value) AS spend FROM base
    WHERE order_purchase_timestamp >= {_CUTOFF} AND order_purchase_timestamp < {_CUTOFF} + INTERVAL '90' DAY
    GROUP BY customer_unique_id
),
targets AS (
    SELECT k.customer_unique_id, coalesce(spend, 0.0) AS future_spend, CAST(coalesce(spend, 0.0) > 0 AS INTEGER) AS will_return
    FROM (SELECT DISTINCT customer_unique_id FROM past) k LEFT JOIN future USING (customer_unique_id)
),
spends AS (
    SELECT future_spend, row_number() OVER (ORDER BY future_spend) - 1 AS place, count(*) OVER () - 1 AS last
    FROM targets WHERE will_return = 1
),
neighbours AS (
    SELECT tile, any_value(last) * tile % 3 AS parts, max(future_spend) FILTER (place = last * tile // 3) AS below,
        max(future_spend) FILTER (place = least(last * tile // 3 + 1, last)) AS above
    FROM spends, (SELECT unnest([1, 2]) AS tile) GROUP BY tile
),
cuts AS (
    SELECT tile, CASE WHEN parts = 0 OR below = above THEN below ELSE below + (above - below) * (parts / 3.0::DOUBLE) END AS edge
    FROM neighbours
),
edges AS (SELECT max(edge) FILTER (tile = 1) AS low, max(edge) FILTER (tile = 2) AS high FROM cuts),
tiered AS (
    SELECT targets.*, CASE WHEN will_return = 0 THEN -1 WHEN future_spend <= low THEN 0 WHEN future_spend <= high THEN 1
        ELSE 2 END AS spend_tier
    FROM targets, edges
),
first_orders AS (
    SELECT customer_unique_id, min(order_purchase_timestamp) AS first_order_date FROM base GROUP BY customer_unique_id
),
placed AS (
    SELECT targets.*, first_order_date,
        row_number() OVER (ORDER BY first_order_date, customer_unique_id) - 1 AS position, count(*) OVER () AS n
    FROM targets JOIN first_orders USING (customer_unique_id)
),
split AS (
    SELECT customer_unique_id, future_spend, will_return, first_order_date, position,
        CASE WHEN position < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
    FROM placed
),
scored AS (
    SELECT customer_unique_id, will_return AS label, frequency / (recency + 30) AS score
    FROM targets JOIN rfm USING (customer_unique_id)
),
per_score AS (SELECT score, sum(label)::BIGINT AS pos, count(*) AS n FROM scored GROUP BY score),
curve AS (
    SELECT score AS threshold, pos, n, (sum(pos) OVER down)::BIGINT AS tp, (sum(n) OVER down)::BIGINT AS called,
        (sum(pos) OVER ())::BIGINT AS p, (sum(n) OVER ())::BIGINT AS total
    FROM per_score WINDOW down AS (ORDER BY score DESC)
),
graded AS (
    SELECT *, 5.0::DOUBLE * (tp / called) * (tp / p) / (4.0::DOUBLE * (tp / called) + tp / p + 1e-9) AS f_beta FROM curve
),
chosen AS (SELECT * FROM graded ORDER BY f_beta DESC, threshold LIMIT 1),
summary AS (
    SELECT sum(pos::DOUBLE * tp / called) / max(p) AS pr_auc,
        sum((n - pos) * (tp - pos / 2)) / max(p::DOUBLE * (total - p)) AS roc_auc
    FROM curve
),
guessed AS (
    SELECT spend_tier AS label, CAST(frequency % 3 AS INTEGER) AS prediction
    FROM tiered JOIN rfm USING (customer_unique_id) WHERE will_return = 1
),
tier_scores AS (
    SELECT tier, count(*) FILTER (label = tier) AS support,
        coalesce(2 * count(*) FILTER (label = tier AND prediction = tier)
            / nullif(count(*) FILTER (label = tier) + count(*) FILTER (prediction = tier), 0), 0.0) AS f1
    FROM guessed, (SELECT unnest([0, 1, 2]) AS tier) GROUP BY tier
)"""
)

_REQUESTS = """
asked AS (
    SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS request_id, CAST(o_custkey AS VARCHAR) AS customer_unique_id,
        CASE WHEN o_orderkey % 43 = 0 THEN o_orderdate - INTERVAL '100' DAY ELSE o_orderdate + INTERVAL '30' DAY END
            AS cutoff_date
    FROM orders
),
records AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS request_id, CAST(o_orderkey AS VARCHAR) AS order_id,
        CASE WHEN o_orderkey % 67 <> 0 THEN o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) END AS order_purchase_timestamp,
        CASE WHEN o_orderkey % 53 = 0 THEN -10.0::DOUBLE ELSE o_totalprice END AS payment_value,
        CAST(CASE WHEN o_orderkey % 59 = 0 THEN 0 ELSE 1 + o_orderkey % 10 END AS INTEGER) AS payment_installments,
        CAST(1 + o_orderkey % 4 AS INTEGER) AS order_item_count, o_totalprice * 0.1::DOUBLE AS freight_value,
        CASE WHEN o_orderkey % 61 = 0 THEN 6.0::DOUBLE WHEN o_orderkey % 3 <> 0 THEN CAST(1 + o_orderkey % 5 AS DOUBLE) END
            AS review_score,
        CASE WHEN o_orderkey % 5 <> 0 THEN concat('S', o_custkey % 27) END AS customer_state,
        CASE WHEN o_orderkey % 37 <> 0 THEN o_orderdate + INTERVAL '1' DAY * (1 + o_orderkey % 29)
            + INTERVAL '1' HOUR * (o_orderkey % 23) END AS order_delivered_customer_date,
        o_orderdate + INTERVAL '20' DAY AS order_estimated_delivery_date
    FROM orders WHERE o_orderkey % 71 <> 0
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), concat(o_orderkey, 'b'), o_orderdate - INTERVAL '45' DAY, o_totalprice * 0.5::DOUBLE,
        1, 1, o_totalprice * 0.05::DOUBLE, 4.0::DOUBLE, 'S1', o_orderdate - INTERVAL '25' DAY, o_orderdate - INTERVAL '30' DAY
    FROM orders WHERE o_orderkey % 71 <> 0 AND o_orderkey % 2 = 0
),
broken AS (
    SELECT a.request_id, a.customer_unique_id, a.cutoff_date,
        concat_ws(',',
            CASE WHEN k % 71 = 0 THEN 'orders' END,
            CASE WHEN k % 71 <> 0 AND k % 67 = 0 THEN 'order_purchase_timestamp' END,
            CASE WHEN k % 71 <> 0 AND k % 53 = 0 THEN 'payment_value' END,
            CASE WHEN k % 71 <> 0 AND k % 59 = 0 THEN 'payment_installments' END,
            CASE WHEN k % 71 <> 0 AND k % 61 = 0 THEN 'review_score' END) AS fields,
        EXISTS (SELECT 1 FROM records r WHERE r.request_id = a.request_id AND r.order_purchase_timestamp < a.cutoff_date) AS known
    FROM asked a
),
checked AS (
    SELECT request_id, customer_unique_id, cutoff_date,
        CASE WHEN fields = '' AND NOT known THEN 'no_history' ELSE fields END AS violations
    FROM broken
),
request_orders AS (
    SELECT request_id, customer_unique_id, cutoff_date, order_id, order_purchase_timestamp, payment_value,
        payment_installments AS max_installments, order_item_count AS item_count, payment_value AS total_price,
        freight_value AS total_freight, 1 AS unique_categories, 1 AS unique_sellers, 0 AS has_voucher, review_score,
        order_delivered_customer_date, order_estimated_delivery_date, customer_state
    FROM checked JOIN records USING (request_id) WHERE violations = ''
)"""

# Doubles of each result, rounded as in tidemark/plans/queries.py.
_BASE_DOUBLES = ("total_price", "total_freight", "payment_value", "review_score")
_FEATURE_DOUBLES = (
    "monetary avg_order_value avg_review_score avg_items_per_order avg_freight_ratio pct_installments spend_last_30d "
    "spend_last_60d avg_order_gap_days avg_delivery_delay_days pct_late_deliveries avg_delivery_speed_days"
).split()


def _rounded(table: str, doubles: tuple[str, ...] | list[str], extra: str = "") -> str:
    changed = ", ".join(f"{_r(name)} AS {name}" for name in doubles)
    return f"SELECT * REPLACE ({changed}){extra} FROM {table}"


def _of(features: str) -> list[str]:
    return [name for name in _FEATURE_DOUBLES if name in features.split()]


def _profile_rows() -> str:
    from tidemark.settings import FEATURES

    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {_r(f'avg(CASE WHEN {name} IS NULL THEN 1.0 ELSE 0.0 END)')} AS null_rate, "
        f"count(DISTINCT {name}) <= 1 AS is_constant FROM matrix"
        for name in FEATURES
    )


# Columns of the base table.
_BASE_COLUMNS = (
    "order_id customer_id order_status order_purchase_timestamp order_delivered_customer_date "
    "order_estimated_delivery_date customer_unique_id customer_state total_price total_freight item_count unique_sellers "
    "unique_categories top_category payment_value max_installments has_voucher is_credit_card is_boleto review_score "
    "review_comment_length review_creation_date"
).split()


def _dropped_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\" FROM base HAVING count(DISTINCT {name}) <= 1 OR "
        f"avg(CASE WHEN {name} IS NULL THEN 1.0 ELSE 0.0 END) > 0.99"
        for name in _BASE_COLUMNS
    )


def oracle_queries() -> dict[str, str]:
    rfm = "monetary avg_order_value"
    behavior = "avg_review_score avg_items_per_order avg_freight_ratio pct_installments"
    temporal = "spend_last_30d spend_last_60d avg_order_gap_days"
    delivery = "avg_delivery_delay_days pct_late_deliveries avg_delivery_speed_days"
    on_tables = {
        "orders_valid_status": "SELECT * FROM valid_orders",
        "items_per_order": _rounded("order_items", _BASE_DOUBLES[:2]),
        "payments_per_order": _rounded("order_payments", _BASE_DOUBLES[2:3]),
        "latest_review_per_order": _rounded("order_reviews", _BASE_DOUBLES[3:]),
        "base_table": _rounded("base", _BASE_DOUBLES),
        "csv_base_table": "SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, "
        "CAST(customer_unique_id AS VARCHAR) AS customer_unique_id) FROM (" + _rounded("base", _BASE_DOUBLES) + ")",
        "base_table_months": f"""
            SELECT strftime(date_trunc('month', order_purchase_timestamp), '%Y-%m-%d') AS month, count(*) AS orders,
                {_r("sum(payment_value)")} AS spend
            FROM base WHERE order_purchase_timestamp < {_CUTOFF} GROUP BY 1""",
        "base_table_report": """
            SELECT count(*) AS orders, count(*) FILTER (customer_unique_id IS NULL) AS without_customer,
                count(DISTINCT customer_unique_id) AS customers
            FROM base""",
        "dropped_columns": _dropped_rows(),
    }
    on_customers = {
        "rfm_features": _rounded("rfm", _of(rfm)),
        "behavioral_features": _rounded("behavior", _of(behavior)),
        "temporal_features": _rounded("velocity JOIN gaps USING (customer_unique_id)", _of(temporal)),
        "delivery_features": _rounded("delivery JOIN frequency USING (customer_unique_id)", _of(delivery)),
        "state_frequency": "SELECT * FROM frequency",
        "state_counts": "SELECT * FROM counted",
        "feature_matrix": _rounded("matrix", _FEATURE_DOUBLES),
        "customer_targets": _rounded("targets", ("future_spend",)),
        "spend_tiers": _rounded("tiered", ("future_spend",)),
        "tier_counts": "SELECT spend_tier, count(*) AS customers FROM tiered WHERE will_return = 1 GROUP BY spend_tier "
        "ORDER BY spend_tier",
        "chronological_split": _rounded("split", ("future_spend",)),
        "train_test_features": _rounded(
            "split LEFT JOIN matrix USING (customer_unique_id)", ["future_spend", *_FEATURE_DOUBLES]
        ),
        "bucketed_features": "SELECT * EXCLUDE (position) FROM ("
        + _rounded("split LEFT JOIN matrix USING (customer_unique_id)", ["future_spend", *_FEATURE_DOUBLES])
        + ")",
        "step_reports": f"""
            SELECT fact, {_r("value")} AS value FROM (
                SELECT 'orders' AS fact, CAST(count(*) AS DOUBLE) AS value FROM base
                UNION ALL SELECT 'without_customer', count(*) FILTER (customer_unique_id IS NULL) FROM base
                UNION ALL SELECT 'returners', sum(will_return) FROM targets
                UNION ALL SELECT 'return_rate', avg(will_return) FROM targets
                UNION ALL SELECT split || '_customers', count(*) FROM split GROUP BY split
                UNION ALL SELECT split || '_return_rate', avg(will_return) FROM split GROUP BY split)""",
        "time_series_folds": """
            SELECT customer_unique_id, first_order_date, position,
                CAST(CASE WHEN position >= n - 5 * (n // 6) THEN (position - (n - 5 * (n // 6))) // (n // 6) + 1 ELSE 0 END
                    AS INTEGER) AS fold
            FROM (SELECT *, row_number() OVER (ORDER BY first_order_date, customer_unique_id) - 1 AS position,
                count(*) OVER () AS n FROM first_orders)""",
        "stratified_folds": f"""
            SELECT customer_unique_id, {_r("future_spend")} AS future_spend, will_return, spend_tier,
                CAST((row_number() OVER (PARTITION BY spend_tier ORDER BY md5(concat('42:', customer_unique_id)), customer_unique_id)
                    - 1) % 3 AS INTEGER) AS fold
            FROM tiered WHERE will_return = 1""",
        "stratified_fold_sizes": """
            SELECT spend_tier, CAST(fold AS INTEGER) AS fold, count(*) AS customers FROM (
                SELECT spend_tier, (row_number() OVER (PARTITION BY spend_tier) - 1) % 3 AS fold
                FROM tiered WHERE will_return = 1)
            GROUP BY spend_tier, fold""",
        "column_profile": _profile_rows(),
        "class_balance": f"""
            SELECT count(*) FILTER (will_return = 0) AS negatives, count(*) FILTER (will_return = 1) AS positives,
                {_r("count(*) FILTER (will_return = 0) / greatest(count(*) FILTER (will_return = 1), 1)")} AS positive_weight
            FROM targets""",
        "precision_recall_curve": f"SELECT round(threshold + 1e-12, 9) AS threshold, {_r('tp / called')} AS precision, "
        f"{_r('tp / p')} AS recall FROM curve",
        "average_precision": f"SELECT {_r('pr_auc')} AS average_precision FROM summary",
        "roc_auc": f"SELECT {_r('roc_auc')} AS roc_auc FROM summary",
        "f_beta_threshold": f"SELECT {_r('threshold')} AS threshold, {_r('f_beta')} AS f_beta FROM chosen",
        "binary_report": """
            SELECT round(pr_auc, 4) AS pr_auc, round(roc_auc, 4) AS roc_auc, round(tp / called, 4) AS precision,
                round(tp / p, 4) AS recall, round(threshold, 4) AS threshold
            FROM summary, chosen""",
        "split_report": f"""
            SELECT split, count(*) AS customers, {_r("avg(will_return)")} AS return_rate FROM split GROUP BY split""",
        "run_log": """
            SELECT 'report' AS run_name, metric, value FROM (
                UNPIVOT (SELECT round(pr_auc, 4) AS pr_auc, round(roc_auc, 4) AS roc_auc, round(tp / called, 4) AS precision,
                    round(tp / p, 4) AS recall, round(threshold, 4) AS threshold FROM summary, chosen)
                ON COLUMNS(*) INTO NAME metric VALUE value)""",
        "aligned_features": f"""
            SELECT customer_unique_id, CAST(recency AS DOUBLE) AS recency, CAST(NULL AS DOUBLE) AS not_a_feature,
                CAST(has_voucher AS DOUBLE) AS has_voucher, {_r("monetary")} AS monetary,
                {_r("avg_order_gap_days")} AS avg_order_gap_days
            FROM matrix""",
        "customer_segments": """
            SELECT customer_unique_id, CASE WHEN customer_unique_id % 1000 < 500 THEN 'Non-returner'
                ELSE ['Low', 'Mid', 'High'][customer_unique_id % 3 + 1] END AS customer_segment
            FROM targets""",
        "shapley_additivity": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS violations FROM targets",
        "confusion": "SELECT label, prediction, count(*) AS rows FROM guessed GROUP BY label, prediction",
        "tier_report": """
            SELECT round(sum(f1 * support) / sum(support), 4) AS weighted_f1, round(max(f1) FILTER (tier = 0), 4) AS f1_low,
                round(max(f1) FILTER (tier = 1), 4) AS f1_mid, round(max(f1) FILTER (tier = 2), 4) AS f1_high
            FROM tier_scores""",
    }
    on_requests = {
        "validate_requests": "SELECT * FROM checked",
        "stream_rejections": "SELECT * FROM checked WHERE violations <> ''",
        "json_requests": "SELECT * FROM checked",
        "rejected_requests": "SELECT * FROM checked WHERE violations <> ''",
        "requests_to_orders": _rounded("request_orders", ("payment_value", "total_price", "total_freight", "review_score")),
    }
    keys = "request_id, customer_unique_id, cutoff_date"
    request_matrix = _feature_ctes("request_orders", keys, "cutoff_date", "asked_", within="request_id")
    return {
        "feature_cache": """
            SELECT stage, CAST(features AS INTEGER) AS features, TRUE AS same_as_model
            FROM (VALUES ('stage1', 15), ('stage2', 10)) chosen(stage, features)""",
        "scored_from_nodes": f"""
            SELECT 'customers' AS kind, known AS responses, CAST(0 AS BIGINT) AS different
            FROM (WITH {_CUSTOMERS} SELECT count(*) AS known FROM targets)
            UNION ALL
            SELECT 'requests', valid, 0 FROM (WITH {_REQUESTS} SELECT count(*) AS valid FROM checked WHERE violations = '')""",
        "stream_scores": f"""
            WITH {_REQUESTS} SELECT 'streamed' AS kind, count(*) AS responses, CAST(0 AS BIGINT) AS different
            FROM checked WHERE violations = ''""",
        "scored_grain": f"""
            SELECT 'customers' AS kind, known AS responses, known AS askers, CAST(0 AS BIGINT) AS impossible,
                CAST(0 AS BIGINT) AS missing
            FROM (WITH {_CUSTOMERS} SELECT count(*) AS known FROM targets)
            UNION ALL
            SELECT 'requests', valid, valid, 0, 0
            FROM (WITH {_REQUESTS} SELECT count(*) AS valid FROM checked WHERE violations = '')""",
        **{name: f"WITH {_TABLES} {sql}" for name, sql in on_tables.items()},
        **{name: f"WITH {_CUSTOMERS} {sql}" for name, sql in on_customers.items()},
        **{name: f"WITH {_REQUESTS} {sql}" for name, sql in on_requests.items()},
        "request_features": f"WITH {_REQUESTS}, {request_matrix} {_rounded('asked_matrix', _FEATURE_DOUBLES)}",
    }
