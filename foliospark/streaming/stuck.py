"""Running registry rows that a crash left behind are released by timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..schemas import TABLES, columns_of, conform
from ..sources.tables import TableFolder

OUT = "key string, at bigint"
#: The newest event of each key of a bucket.
NEWEST = "keys array<string>, ats array<bigint>, statuses array<string>"
#: Keys share a call and a row of state by buckets; a checkpoint keeps its number of them.
BUCKETS = 1 << 12
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# State with timers is kept outside the JVM's heap.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _release(running: str, wait: int, clock: str):
    """Holds the newest event of each key of a bucket, and one timer for the first of them that is due."""
    def step(bucket: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        keys, ats, statuses = state.get if state.exists else ([], [], [])
        held = dict(zip(keys, zip(ats, statuses)))
        if not state.hasTimedOut:
            for part in parts:
                for key, at, status in zip(part["_key"].tolist(), part["_at"].tolist(), part["_status"].tolist()):
                    old = held.get(key)
                    if old is None or (at, status) > old:
                        held[key] = (at, status)
        now = state.getCurrentWatermarkMs() if clock == "eventTime" else state.getCurrentProcessingTimeMs()
        due = {key: at + wait for key, (at, status) in held.items() if status == running}
        over = {key: at for key, at in due.items() if at <= now}
        # A release is an event of its own; whatever comes for this row from then on is newer.
        held.update((key, (at, "pending")) for key, at in over.items())
        state.update((list(held), [at for at, _ in held.values()], [status for _, status in held.values()]))
        if len(due) > len(over):
            # Spark calls once the clock is past the timer, so it is set to the last moment before.
            first = min(at for at in due.values() if at > now) - 1
            if clock == "eventTime":
                state.setTimeoutTimestamp(max(1, first))
            else:
                state.setTimeoutDuration(max(1, first - now))
        if over:
            yield pd.DataFrame({"key": list(over), "at": list(over.values())})

    return step


def releases(events: DataFrame, key: str, status: str, running: str, minutes: int = 60, delay: str = "0 seconds", clock: str = "eventTime", event_order: str = "event_time", buckets: int = BUCKETS) -> DataFrame:
    """From a stream of status events, an event back to ``pending`` for every row that stays in ``running`` too long.

    ``key, status, event_time``; the time is when the wait was over.  With the
    clock ``eventTime`` that is told by the newest event of all less ``delay``, and an
    event older than that is too late to count; with ``processingTime`` by the
    machine.  The state is the newest event of each key, whatever the number of its events;
    keys are handled by hash bucket, so a batch costs a call for each bucket that it touches.
    Of events at one time the greatest status counts.  Events without a key or a time are left out.
    """
    timed = events.filter(F.col(key).isNotNull() & F.col(event_order).isNotNull())
    if clock == "eventTime":
        timed = timed.withWatermark(event_order, delay)
    at = F.unix_millis(F.col(event_order).cast("timestamp")).alias("_at")
    named = F.col(key).cast("string")
    rows = timed.select(F.pmod(F.xxhash64(named), F.lit(buckets)).cast("int").alias("_bucket"), named.alias("_key"), at, F.coalesce(status, F.lit("")).alias("_status"), event_order)
    timeout = GroupStateTimeout.EventTimeTimeout if clock == "eventTime" else GroupStateTimeout.ProcessingTimeTimeout
    found = rows.groupBy("_bucket").applyInPandasWithState(_release(running, minutes * 60_000, clock), OUT, NEWEST, "append", timeout)
    return found.select(F.col("key").alias(key), F.lit("pending").alias(status), F.timestamp_millis("at").alias(event_order))


def start_with_state(spark: SparkSession, start) -> StreamingQuery:
    """Start a stream that keeps timers; the store is set for this stream only."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def release_events(tables: TableFolder, table: str, status: str, running: str, checkpoint: str, minutes: int = 60, delay: str = "0 seconds", every: str | None = None) -> StreamingQuery:
    """Watch an event table of the flow and append releases to it.

    At an interval the machine's clock tells when a wait is over.  A single run
    ends, so it goes by the newest event less ``delay`` instead.  Releases are
    stored under negative batch ids, so they never meet a batch of the flow, and
    a batch that runs again replaces its own.
    """
    clock = "processingTime" if every else "eventTime"
    events = tables.spark.readStream.schema(f"{TABLES[table]}, batch_id bigint").parquet(tables.path(table)).select(columns_of(table).fieldNames())
    found = releases(events, "registry_id", status, running, minutes, delay, clock)

    def store(rows: DataFrame, batch: int) -> None:
        tables.write(table, conform(rows, table), -1 - batch)

    writer = found.writeStream.option("checkpointLocation", checkpoint).outputMode("append").foreachBatch(store)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return start_with_state(tables.spark, writer.start)
