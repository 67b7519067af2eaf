"""Derived fact measures and due dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_HUNDREDTH_HOUR_US = 36_000_000

# Days until a transaction is due, by priority.
DUE_DAYS = {"Critical": 1, "High": 3, "Medium": 5}
DUE_DAYS_OTHERWISE = 7


def cycle_hours(created: str, completed: str) -> Column:
    """Hours from creation to completion with two decimals, halves away from zero; NULL while open.

    Whole hundredths of an hour are counted in integers: exact, without wide decimals.
    """
    elapsed = F.col(completed) - F.col(created)

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), elapsed)

    # from the interval's fields: a timestamp difference function would go through the session's zone
    us = (
        part("DAY").cast("bigint") * 86_400_000_000
        + part("HOUR").cast("bigint") * 3_600_000_000
        + part("MINUTE").cast("bigint") * 60_000_000
        + (part("SECOND") * 1_000_000).cast("bigint")
    )
    whole = F.call_function("div", us, F.lit(_HUNDREDTH_HOUR_US))
    rest = us % _HUNDREDTH_HOUR_US
    half = _HUNDREDTH_HOUR_US // 2
    hundredths = whole + F.when(rest >= half, 1).when(rest <= -half, -1).otherwise(0)
    return (hundredths.cast("decimal(14,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(12,2)")


def sla_breached(due: str, completed: str, as_of: Column) -> Column:
    """Whether the deadline was missed; open rows are measured against the run's clock."""
    return F.when(F.col(due).isNotNull(), F.coalesce(F.col(completed), as_of) > F.col(due))


def due_by_priority(
    created: str, priority: str, days: Mapping[str, int] = DUE_DAYS, otherwise: int = DUE_DAYS_OTHERWISE
) -> Column:
    allowance = F.lit(otherwise)
    for name, n in days.items():
        allowance = F.when(F.col(priority) == name, n).otherwise(allowance)
    return F.col(created) + F.make_dt_interval(days=allowance)
