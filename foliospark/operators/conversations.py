"""A log of conversation turns that takes every turn once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import BATCH, read_if_there

BUCKET = "bucket"


class ConversationLog:
    """Turns stored by batch and bucket of their session.

    A turn is known by session and turn number.  A batch that runs again replaces
    its own rows; a turn that another batch brought is not taken again, however
    late it is sent, so nothing is lost or doubled when a source repeats itself.
    A new batch looks at the two key columns of its sessions' buckets only.
    Null sessions and turn numbers are equal to themselves.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, session: str = "conv_id", turn: str = "turn", buckets: int = 64):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.session, self.turn, self.buckets = session, turn, buckets

    def _stored(self) -> DataFrame:
        schema = f"{self.schema}, {BATCH} bigint, {BUCKET} int"
        rows = read_if_there(self.spark, schema, self.root)
        return self.spark.createDataFrame([], schema) if rows is None else rows

    def read(self) -> DataFrame:
        return self._stored().drop(BATCH, BUCKET)

    def append(self, turns: DataFrame, batch: int) -> None:
        """Add the batch's new turns.  Of rows that repeat a turn within the batch the smallest stays."""
        keys = [self.session, self.turn]
        names = self.read().columns
        rest = [c for c in names if c not in keys]
        # A minimum combines before the shuffle, so a turn sent very often costs one row a task.
        once = turns.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
        rows = once.select(*names, F.pmod(F.xxhash64(self.session), F.lit(self.buckets)).cast("int").alias(BUCKET))
        rows = rows.persist()
        try:
            mine = [r[BUCKET] for r in rows.select(BUCKET).distinct().collect()]
            known = self._stored().filter(F.col(BUCKET).isin(mine) & (F.col(BATCH) != batch))
            known = known.select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
            fresh = rows.join(known, same, "left_anti").withColumn(BATCH, F.lit(batch).cast("bigint"))
            fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH, BUCKET).parquet(self.root)
        finally:
            rows.unpersist()

    def start(self, turns: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Append a stream of turns: at an interval, or once over all that is there."""
        writer = turns.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.append)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
