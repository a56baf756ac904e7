from tidemark.functions.columns import (
    any_equals,
    as_timestamp,
    days_after,
    last_known,
    micros_since_year_1,
    packed,
    share_above,
    sum_or_zero,
    whole_days,
)

__all__ = [
    "any_equals",
    "as_timestamp",
    "days_after",
    "last_known",
    "micros_since_year_1",
    "packed",
    "share_above",
    "sum_or_zero",
    "whole_days",
]
