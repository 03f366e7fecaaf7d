"""Analytics over the request cost log and the request log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.costs import cooldown_seconds, cost_accuracy, page_size_advice
from tidemark.operators.ranking import running_totals, totals_at_end, top_per_key

HISTORY = 100


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def _percent(part: Column, whole: Column) -> Column:
    return _or_zero(F.try_divide(part * 100.0, whole))


def cost_records(costs: DataFrame) -> DataFrame:
    return costs.withColumn("cost_difference", F.col("actual_cost") - F.col("requested_cost"))


def last_rows(
    log: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = HISTORY
) -> DataFrame:
    """The newest `n` rows of every key."""
    return top_per_key(log, keys, [F.col(c).desc() for c in order], n, "_age").drop("_age")


def cost_by_type(costs: DataFrame) -> DataFrame:
    cooldown = cooldown_seconds(
        F.col("requested_cost"), F.col("currently_available"), F.col("restore_rate")
    )
    return costs.groupBy("query_type").agg(
        F.count(F.lit(1)).alias("query_count"),
        F.avg("actual_cost").alias("avg_cost"),
        F.max("actual_cost").alias("max_cost"),
        F.count_if(cooldown.isNotNull()).alias("throttle_count"),
    )


def cost_overview(costs: DataFrame, runtime_seconds: float) -> DataFrame:
    """One row over the whole log; an empty log gives zeros."""
    return costs.agg(
        _or_zero(F.avg("requested_cost")).alias("avg_requested_cost"),
        _or_zero(F.avg("actual_cost")).alias("avg_actual_cost"),
        F.coalesce(F.max("requested_cost"), F.lit(0)).alias("max_requested_cost"),
        F.coalesce(F.min("currently_available"), F.lit(0)).alias("min_available_points"),
        F.count(F.lit(1)).alias("total_requests"),
        _or_zero(F.try_divide(F.count(F.lit(1)), F.lit(float(runtime_seconds)))).alias(
            "requests_per_second"
        ),
    )


def _cost_aggregates() -> list[Column]:
    requested, actual = F.col("requested_cost"), F.col("actual_cost")
    return [
        F.count(F.lit(1)).alias("total_queries"),
        _or_zero(F.avg(requested)).alias("avg_requested_cost"),
        _or_zero(F.avg(actual)).alias("avg_actual_cost"),
        F.coalesce(F.min(actual), F.lit(0)).alias("min_actual_cost"),
        F.coalesce(F.max(actual), F.lit(0)).alias("max_actual_cost"),
        _or_zero(F.avg(actual - requested)).alias("avg_cost_difference"),
        _or_zero(F.avg(cost_accuracy(requested, actual))).alias("cost_accuracy_percentage"),
    ]


def cost_statistics(costs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return costs.groupBy(*keys).agg(*_cost_aggregates())


def _throttle_aggregates(order: Sequence[str]) -> list[Column]:
    complete = (
        F.col("maximum_available").isNotNull()
        & F.col("currently_available").isNotNull()
        & F.col("restore_rate").isNotNull()
    )
    at = F.when(complete, F.struct(*order))
    current = F.when(complete, F.col("currently_available"))
    return [
        F.count_if(complete).alias("queries_with_throttle_data"),
        F.min_by("maximum_available", at).alias("maximum_available"),
        F.avg(current).alias("avg_currently_available"),
        F.min(current).alias("min_currently_available"),
        F.min_by("restore_rate", at).alias("restore_rate"),
    ]


def throttle_statistics(
    costs: DataFrame, order: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Capacity use over rows that carry all three throttle fields.

    Capacity and restore rate are those of the first such row, not of each row.
    """
    agg = costs.groupBy(*keys).agg(*_throttle_aggregates(order))
    capacity = F.col("maximum_available")

    def used(available: Column) -> Column:
        share = F.try_divide((capacity - available) * 100.0, capacity)
        return F.when(capacity > 0, share).when(capacity.isNotNull(), F.lit(0.0))

    lowest = F.try_divide(F.col("min_currently_available") * 100.0, capacity)
    return agg.select(
        "*",
        used(F.col("avg_currently_available")).alias("avg_capacity_used_percentage"),
        F.when(capacity > 0, lowest)
        .when(capacity.isNotNull(), F.lit(0.0))
        .alias("lowest_capacity_percentage"),
    )


def _request_aggregates(uptime: Column | None) -> list[Column]:
    outcome, seconds = F.col("outcome"), F.col("seconds")
    span = F.max("at") - F.min("at") if uptime is None else uptime
    return [
        F.count_if(outcome.isin("ok", "rate_limited")).alias("total_requests"),
        F.count_if(outcome == "ok").alias("successful_requests"),
        F.count_if(outcome == "rate_limited").alias("rate_limit_errors"),
        F.count_if(outcome == "throttled").alias("throttled_requests"),
        F.count_if(outcome.isin("retry_ok", "retry_failed")).alias("retry_attempts"),
        F.count_if(outcome == "retry_ok").alias("successful_retries"),
        _or_zero(F.avg(F.when(outcome == "throttled", seconds))).alias("avg_throttle_seconds"),
        _or_zero(F.max(F.when(outcome == "throttled", seconds))).alias("max_throttle_seconds"),
        span.alias("uptime_seconds"),
    ]


def _request_shares() -> list[Column]:
    total, uptime = F.col("total_requests"), F.col("uptime_seconds")
    return [
        _or_zero(F.try_divide(total * 60.0, uptime)).alias("requests_per_minute"),
        _or_zero(F.try_divide(F.col("successful_requests") * 60.0, uptime)).alias("successful_per_minute"),
        _percent(F.col("rate_limit_errors"), total).alias("error_percentage"),
        _percent(F.col("throttled_requests"), total + F.col("throttled_requests")).alias("throttle_percentage"),
        _percent(F.col("successful_retries"), F.col("retry_attempts")).alias("retry_success_percentage"),
    ]


def request_rates(log: DataFrame, keys: Sequence[str] = (), uptime: Column | None = None) -> DataFrame:
    """Rates over a request log with outcome ok, rate_limited, throttled, retry_ok, retry_failed.

    `seconds` is the response or waiting time of a row. Throttled rows are waits and
    not requests; retries are not requests either.
    """
    return log.groupBy(*keys).agg(*_request_aggregates(uptime)).select("*", *_request_shares())


def run_metrics(log: DataFrame, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Request, cost and throttle measures of one log that carries all columns, in one scan."""
    aggregates = [*_request_aggregates(None), *_cost_aggregates(), *_throttle_aggregates(order)]
    return log.groupBy(*keys).agg(*aggregates).select("*", *_request_shares())


def with_advice(costs: DataFrame, base_page_size: Column) -> DataFrame:
    """Page size and cooldown advice for every row of the log."""
    requested, available = F.col("requested_cost"), F.col("currently_available")
    size, reason = page_size_advice(base_page_size, requested, available)
    return costs.withColumns(
        {
            "page_size": size,
            "reason": reason,
            "cooldown_seconds": cooldown_seconds(requested, available, F.col("restore_rate")),
        }
    )


def _throughput(entities: Column, throttled: Column) -> dict[str, Column]:
    return {
        "requests_made": F.lit(1).cast("bigint"),
        "entities_so_far": entities.cast("bigint"),
        "throttles_so_far": F.when(throttled, 1).otherwise(0).cast("bigint"),
    }


def throughput_at_end(
    log: DataFrame, keys: Sequence[str], entities: Column, throttled: Column, start: DataFrame | None = None
) -> DataFrame:
    """The totals of `running_throughput` after the last request of every key."""
    return totals_at_end(log, keys, _throughput(entities, throttled), start)


def running_throughput(
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    entities: Column,
    throttled: Column,
    start: DataFrame | None = None,
) -> DataFrame:
    """Requests, entities and throttles so far, per request, and the throttle rate; a log
    goes on from `start`, what `throughput_at_end` gave for the part before."""
    totals = running_totals(log, keys, order, _throughput(entities, throttled), start)
    return totals.withColumn(
        "throttle_rate",
        F.try_divide(F.col("throttles_so_far").cast("double"), F.col("requests_made")),
    )


def daily_rates(runs: DataFrame) -> DataFrame:
    """Processed and failed per day and kind, with the mean rate of the finished runs."""
    seconds = F.col("completed_at_s") - F.col("started_at_s")
    return (
        runs.where("completed_at_s is not null")
        .groupBy(F.to_date(F.timestamp_seconds("started_at_s")).cast("string").alias("date"), "entity_type")
        .agg(
            F.sum("entities_processed").alias("total_processed"),
            F.sum("entities_failed").alias("total_failed"),
            F.avg(F.try_divide(F.col("entities_processed").cast("double"), seconds)).alias(
                "avg_rate"
            ),
        )
    )
