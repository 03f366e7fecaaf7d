"""Advice computed from the cost envelope of a request."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and factors of the advice rules.
HIGH_COST = 8000
LOW_CAPACITY = 2000
HIGH_COST_PERCENT = 80
LOW_CAPACITY_PERCENT = 50
SMALLEST_PAGE = 10
DEFAULT_RESTORE_RATE = 500


def _shrunk(base: Column, percent: int) -> Column:
    reduced = (base * (percent / 100)).cast("bigint")
    return F.greatest(F.lit(SMALLEST_PAGE).cast("bigint"), reduced)


def page_size_advice(base: Column, requested: Column, available: Column) -> tuple[Column, Column]:
    """(page size, reason); a costly request is shrunk before a drained budget is."""
    size = (
        F.when(requested > HIGH_COST, _shrunk(base, HIGH_COST_PERCENT))
        .when(available < LOW_CAPACITY, _shrunk(base, LOW_CAPACITY_PERCENT))
        .otherwise(base.cast("bigint"))
    )
    reason = F.when(requested > HIGH_COST, F.lit("high_cost")).when(
        available < LOW_CAPACITY, F.lit("low_capacity")
    )
    return size, reason


def cooldown_seconds(requested: Column, available: Column, restore_rate: Column) -> Column:
    """Seconds until the budget covers the request, plus one; NULL when it does already."""
    need = F.coalesce(requested, F.lit(0)) - F.coalesce(available, F.lit(0))
    rate = F.coalesce(restore_rate, F.lit(DEFAULT_RESTORE_RATE))
    return F.when((need > 0) & (rate > 0), F.try_divide(need.cast("double"), rate) + 1)


def cost_accuracy(requested: Column, actual: Column) -> Column:
    """100 minus the relative miss in percent; may go below zero."""
    miss = F.abs(F.try_divide((actual - requested).cast("double"), actual.cast("double"))) * 100
    return F.when(actual > 0, 100 - miss).otherwise(F.lit(100.0))


def performance_grade(
    errors: Column, rows: Column, seconds: Column, peak_mb: Column, requests_per_second: Column
) -> Column:
    """Letter grade from a score of 100 less deductions."""
    rate = rows / F.greatest(seconds, F.lit(1.0))
    score = (
        F.lit(100)
        - F.greatest(errors, F.lit(0)) * 5
        - F.when(rate < 5, 20).when(rate < 10, 10).otherwise(0)
        - F.when(peak_mb > 1000, 10).otherwise(0)
        - F.when(requests_per_second > 8, 15).otherwise(0)
    )
    return (
        F.when(score >= 95, F.lit("A+"))
        .when(score >= 90, F.lit("A"))
        .when(score >= 80, F.lit("B"))
        .when(score >= 70, F.lit("C"))
        .when(score >= 60, F.lit("D"))
        .otherwise(F.lit("F"))
    )
