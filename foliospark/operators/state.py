"""State changes as functions from old rows and changes to new rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from .classify import ERROR_CLASS

# The states of each registry and the moves between them.
SPLIT_MOVES = {
    "pending": ("splitting",),
    "pending_split": ("splitting",),
    "pending_page_limit": ("splitting",),
    "requires_external_processing": ("splitting",),
    "splitting": ("no_split_needed", "split_complete", "unsplittable", "error", "pending"),
}
CSV_MOVES = {"pending": ("processing",), "processing": ("completed", "error", "pending")}
SPREADSHEET_MOVES = {"pending": ("converting",), "converting": ("converted", "error", "pending")}


def newest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key.

    A maximum over structs combines before the shuffle, so a key with very many
    rows costs one row per task, unlike a window.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    top = F.max(F.struct(*order, *rest)).alias("_top")
    return df.groupBy(*keys).agg(top).select(*keys, *[F.col(f"_top.{c}") for c in order + rest]).select(*df.columns)


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str], update: list[str]) -> DataFrame:
    """Upsert: matched rows take the source's ``update`` columns, others are added.

    Both sides are joined once on the key.  A source with repeated keys must be
    reduced first (``newest_per_key``).
    """
    t, s = target.alias("t"), source.alias("s")
    joined = t.withColumn("_old", F.lit(True)).alias("t").join(
        s.withColumn("_new", F.lit(True)).alias("s"), [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer"
    )
    is_new, is_old = F.col("s._new").isNotNull(), F.col("t._old").isNotNull()
    columns = []
    for c in target.columns:
        if c in keys:
            value = F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        elif c not in source.columns:
            value = F.col(f"t.{c}")
        elif c in update:
            value = F.when(is_new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        else:
            value = F.when(is_old, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        columns.append(value.alias(c))
    return joined.select(*columns)


def repeated_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that an upsert source holds more than once."""
    return source.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def mark_classified(parsed: DataFrame, classified: DataFrame) -> DataFrame:
    """Parsed rows that have a classification change to ``classified``, or to the error state."""
    failed = F.bool_and(F.coalesce(F.col("document_class") == ERROR_CLASS, F.lit(False)))
    done = classified.groupBy("document_id").agg(F.when(failed, ERROR_CLASS).otherwise("classified").alias("_done"))
    eligible = (
        (F.col("status") == "parsed") & F.col("content_text").isNotNull() & (F.length(F.trim("content_text")) > 0)
    )
    # Judged before the join, so that texts are shuffled only for a reader that asks for them.
    return (
        parsed.withColumn("_eligible", eligible)
        .join(done, "document_id", "left")
        .withColumn("status", F.when(F.col("_eligible"), F.coalesce("_done", "status")).otherwise(F.col("status")))
        .select(*parsed.columns)
    )


def is_legal_move(old: Column, new: Column, moves: dict[str, tuple[str, ...]]) -> Column:
    legal = F.lit(False)
    for state, targets in moves.items():
        legal = legal | ((old == state) & new.isin(*targets))
    return legal


def apply_status_events(
    registry: DataFrame, events: DataFrame, key: str, status: str, event_order: str = "event_time"
) -> DataFrame:
    """Registry rows with the state of their latest event.

    Events carry ``key``, ``status``, an order column and any registry columns
    they set; columns an event leaves null keep their value.
    """
    latest = newest_per_key(events, [key], [event_order])
    sets = [c for c in events.columns if c not in (key, event_order)]
    renamed = latest.select(key, F.col(event_order).alias("_at"), *[F.col(c).alias(f"_{c}") for c in sets])
    joined = registry.join(renamed, key, "left")
    out = {c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in sets if c in registry.columns}
    if "processed_timestamp" in registry.columns:
        out["processed_timestamp"] = F.coalesce("_at", "processed_timestamp")
    return joined.withColumns(out).select(*registry.columns)


def release_stuck(registry: DataFrame, status: str, running: str, as_of: datetime, minutes: int = 60) -> DataFrame:
    """Rows left in a running state by a crash go back to pending after a time."""
    limit = F.lit(as_of) - F.expr(f"interval {minutes} minutes")
    stuck = (F.col(status) == running) & (F.col("processed_timestamp") < limit)
    return registry.withColumn(status, F.when(stuck, "pending").otherwise(F.col(status)))


def apply_reviews(extractions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Approved values take the edited text and score 1; denied ones become null with score 0.

    ``reviews`` holds one row per document and attribute with ``action``
    (``approve`` or ``deny``) and ``edited_value``.
    """
    change = reviews.select("document_id", "attribute_name", "action", "edited_value")
    approve, deny = F.col("action") == "approve", F.col("action") == "deny"
    return (
        extractions.join(change, ["document_id", "attribute_name"], "left")
        .withColumns(
            {
                "attribute_value": F.when(approve, F.col("edited_value")).when(~F.coalesce(deny, F.lit(False)), F.col("attribute_value")),
                "confidence_score": F.when(approve, 1.0).when(deny, 0.0).otherwise(F.col("confidence_score")),
            }
        )
        .select(*extractions.columns)
    )


def review_low_scores(extractions: DataFrame, document: Column, threshold: float, action: str) -> DataFrame:
    """Approve or deny every attribute below the threshold of the chosen documents."""
    low = F.coalesce(document & (F.col("confidence_score") < threshold), F.lit(False))
    if action == "approve":
        return extractions.withColumn("confidence_score", F.when(low, 1.0).otherwise(F.col("confidence_score")))
    if action == "deny":
        return extractions.withColumns(
            {
                "attribute_value": F.when(~low, F.col("attribute_value")),
                "confidence_score": F.when(low, 0.0).otherwise(F.col("confidence_score")),
            }
        )
    raise ValueError(f"unknown review action: {action}")


def run_summary(routed: DataFrame, error: str = "error_information") -> DataFrame:
    """Counts of one ingestion run by route, in a single pass."""
    from .routing import hit_page_limit

    def count(condition: Column) -> Column:
        return F.count_if(condition).cast("bigint")

    route = F.col("route")
    return routed.agg(
        F.count("*").alias("stream_count"),
        count(route == "parse").alias("processed_count"),
        count(route == "large").alias("large_count"),
        count((route == "parse") & hit_page_limit(F.col(error))).alias("failed_parse_count"),
        count(route == "spreadsheet").alias("spreadsheet_count"),
        count(route == "csv").alias("csv_count"),
        count(route == "rejected").alias("rejected_count"),
    )
