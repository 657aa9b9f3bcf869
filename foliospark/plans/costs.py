"""Cost reports over metering tables."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Metered services and the names that belong to the document flow.
TASK_SERVICE = "SERVERLESS_TASK"
AI_SERVICE = "AI_SERVICES"
TASK_NAMES = ("PARSE_DOCUMENTS_TASK", "CLASSIFY_DOCUMENTS_TASK", "EXTRACT_DOCUMENTS_TASK", "CHUNK_DOCUMENTS_TASK")
FUNCTION_NAMES = {"parse_credits": "PARSE_DOCUMENT", "classify_credits": "CLASSIFY", "extract_credits": "EXTRACT"}
SEARCH_NAME = "DOCUMENT_SEARCH_SERVICE"


def in_period(column: str, start: date, end: date) -> Column:
    """Whole days from start to end, as bounds on the plain column so that scans can prune."""
    if start > end:
        raise ValueError("start date must not be after end date")
    col = F.col(column)
    return (col >= F.lit(start)) & (col < F.lit(end + timedelta(days=1)))


def name_has(column: str, *names: str) -> Column:
    upper = F.upper(F.col(column))
    return F.coalesce(reduce(lambda a, b: a | b, [upper.contains(n) for n in names]), F.lit(False))


def is_flow_task() -> Column:
    return (F.col("service_type") == TASK_SERVICE) & name_has("name", *TASK_NAMES)


def day() -> Column:
    return F.to_date("start_time").alias("usage_date")


def credits(column: str = "credits_used", digits: int = 4) -> Column:
    return F.round(F.sum(column), digits)


def totals(metering: DataFrame, start: date, end: date) -> DataFrame:
    """Task, AI and combined credits of the period."""
    rows = metering.filter(in_period("start_time", start, end) & F.col("service_type").isin(TASK_SERVICE, AI_SERVICE))
    used = F.col("credits_used")
    sums = rows.agg(
        F.coalesce(F.sum(F.when(is_flow_task(), used).otherwise(0.0)), F.lit(0.0)).alias("t"),
        F.coalesce(F.sum(F.when(F.col("service_type") == AI_SERVICE, used).otherwise(0.0)), F.lit(0.0)).alias("a"),
    )
    return sums.select(
        F.round("t", 4).alias("serverless_credits"),
        F.round("a", 4).alias("ai_services_credits"),
        F.round(F.col("t") + F.col("a"), 4).alias("total_credits"),
    )


def task_days(metering: DataFrame, start: date, end: date) -> DataFrame:
    rows = metering.filter(in_period("start_time", start, end) & is_flow_task())
    return rows.groupBy(F.col("name").alias("task_name"), day()).agg(credits().alias("credits_used"))


def task_totals(metering: DataFrame, start: date, end: date) -> DataFrame:
    rows = metering.filter(in_period("start_time", start, end) & is_flow_task())
    return rows.agg(
        F.coalesce(credits(), F.lit(0.0)).alias("total_task_credits"), F.count_distinct("name").alias("unique_tasks")
    )


def function_days(usage: DataFrame, start: date, end: date) -> DataFrame:
    rows = usage.filter(in_period("start_time", start, end) & name_has("function_name", *FUNCTION_NAMES.values()))
    return rows.groupBy("function_name", day()).agg(
        credits("token_credits").alias("token_credits"), F.count("*").alias("call_count")
    )


def function_totals(usage: DataFrame, start: date, end: date) -> DataFrame:
    """Credits per kind of function, all credits and all calls."""
    rows = usage.filter(in_period("start_time", start, end) & name_has("function_name", *FUNCTION_NAMES.values()))
    parts = [
        F.round(F.coalesce(F.sum(F.when(name_has("function_name", n), F.col("token_credits"))), F.lit(0.0)), 4).alias(c)
        for c, n in FUNCTION_NAMES.items()
    ]
    return rows.agg(
        *parts, F.coalesce(credits("token_credits"), F.lit(0.0)).alias("total_token_credits"), F.count("*").alias("total_calls")
    )


def search_days(usage: DataFrame, start: date, end: date) -> DataFrame:
    rows = usage.filter(F.col("usage_date").between(F.lit(start), F.lit(end)) & name_has("service_name", SEARCH_NAME))
    return rows.groupBy("service_name", "usage_date").agg(
        F.sum("tokens").alias("total_tokens"), credits("credits").alias("total_credits")
    )


def search_totals(usage: DataFrame, start: date, end: date) -> DataFrame:
    rows = usage.filter(F.col("usage_date").between(F.lit(start), F.lit(end)) & name_has("service_name", SEARCH_NAME))
    return rows.agg(
        F.sum("tokens").alias("total_tokens"),
        credits("credits").alias("total_credits"),
        F.count_distinct("service_name").alias("unique_services"),
    )


def task_trend(metering: DataFrame, start: date, end: date) -> DataFrame:
    rows = metering.filter(in_period("start_time", start, end) & is_flow_task())
    return rows.groupBy(day()).agg(credits().alias("total_credits"))


def ai_trend(metering: DataFrame, start: date, end: date) -> DataFrame:
    rows = metering.filter(in_period("start_time", start, end) & (F.col("service_type") == AI_SERVICE))
    return rows.groupBy(day()).agg(credits().alias("total_credits"))


def combined_trend(metering: DataFrame, start: date, end: date) -> DataFrame:
    kept = is_flow_task() | (F.col("service_type") == AI_SERVICE)
    rows = metering.filter(in_period("start_time", start, end) & kept)
    return rows.groupBy(day(), "service_type").agg(credits().alias("total_credits"))
