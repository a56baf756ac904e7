"""Column builders whose null, rounding and tie rules the operators rely on."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Longer than any span between two valid timestamps, so that a shifted span is never negative.
_SHIFT_DAYS = 10_000_000


def _col(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def as_timestamp(value: Column | datetime | date | str) -> Column:
    """A zone-free timestamp: a column as it is, anything else as a literal."""
    if isinstance(value, Column):
        return value
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def days_after(moment: Column, days: int | Column) -> Column:
    """``moment`` moved by whole days; negative moves back."""
    count = days if isinstance(days, Column) else F.lit(days)
    return moment + F.make_dt_interval(count)


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Days from ``earlier`` to ``later``, rounded down (12 hours early is -1).

    ``datediff`` counts midnights and ``timestampdiff`` cuts toward zero and depends on the session time zone.
    Here the span is shifted into the positive, where cutting off is rounding down.
    """
    span = _col(later) - _col(earlier)
    shifted = F.extract(F.lit("DAY"), span + F.expr(f"INTERVAL '{_SHIFT_DAYS}' DAY"))
    return shifted - F.lit(_SHIFT_DAYS)


def micros_since_year_1(moment: Column | str) -> Column:
    """Microseconds from the first day of year 1 as a long, for years 1 to 9999: below 10^18, and free of time zones."""
    at = _col(moment)
    days = F.datediff(at.cast("date"), F.lit("0001-01-01").cast("date")).cast("long")
    seconds = (days * 24 + F.hour(at)) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")


def packed(high: Column, low: Column, digits: int) -> Column:
    """high * 10^digits + low as one decimal of 38 digits, for 0 <= low < 10^digits.

    Orders like the pair, but has a fixed width, so that an aggregate ordered by it stays a hash aggregate.
    """
    scale = F.lit(Decimal(10**digits)).cast(f"decimal({digits + 1},0)")
    return (high.cast(f"decimal({38 - digits},0)") * scale + low.cast(f"decimal({digits},0)")).cast("decimal(38,0)")


def sum_or_zero(value: Column | str) -> Column:
    """Sum that is 0.0 when a group has no known value. For use inside ``agg`` only."""
    return F.coalesce(F.sum(_col(value)), F.lit(0.0))


def share_above(value: Column | str, limit: float) -> Column:
    """Share of all rows with ``value > limit``; rows without a value count as not above."""
    return F.avg(F.when(_col(value) > F.lit(limit), 1.0).otherwise(0.0))


def any_equals(value: Column | str, wanted: str) -> Column:
    """1 if any row of the group equals ``wanted``, else 0, also when nothing is known."""
    return F.coalesce(F.max((_col(value) == F.lit(wanted)).cast("int")), F.lit(0))


def last_known(value: Column | str, *order: Column | str) -> Column:
    """The non-null ``value`` of the row with the greatest ``order``.

    Rows that lack the value are passed over: the null check sits in the ordering, where a null ordering
    is ignored by ``max_by``.
    """
    known = _col(value)
    return F.max_by(known, F.when(known.isNotNull(), F.struct(*[_col(o) for o in order])))
