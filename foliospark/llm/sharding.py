"""Shards by vector bin packing: bytes, tokens and rows are balanced together.

Documents with equal texts form a group and stay in one shard.  Groups are
packed as bundles: a group that holds more than ``1 / pieces`` of a shard in
bytes, tokens or rows (there are at most ``3 * shards * pieces`` such groups)
is a bundle of its own; one of more than ``1 / whole`` of a shard, which would
spoil the balance, is cut by a hash of doc_id into bundles of about half that.
All other groups are dealt by a hash of their text to ``shards * pieces`` bundles.  So the driver packs a number of bundles that
depends on the parameters only.  It takes them by falling size and places each
where the dot product of its vector with the residual capacity is highest.

Null texts have no bytes and are equal to each other, not to empty texts.  Rows
with one doc_id are separate rows; equal ones share a bundle.  A null doc_id
is allowed.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

OVERHEAD = 8
BUNDLE = "bundle string, shard int, base long"


def _sizes(docs: DataFrame) -> DataFrame:
    """One narrow row per document: what packing needs of a text, read once."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.coalesce(F.size(F.split("text", r"\s+")), F.lit(0)).cast("long").alias("tokens"),
        F.when(F.col("text").isNull(), "null").otherwise(F.concat_ws("-", F.hex(F.xxhash64("text")), F.hex(F.hash("text")), F.octet_length("text"))).alias("text_key"),
    )


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each row of ``vectors``: the highest dot product with residual capacity.

    Vectors are shares of one shard's capacity, so that all dimensions weigh
    alike; capacities are equal.  Only shards with room in every dimension are
    asked as long as there are any; without one, the shard with most room in the
    first dimension (bytes) takes the group.  Ties go to the first shard.
    """
    totals = vectors.sum(axis=0)
    share = vectors / np.where(totals > 0, totals / shards, 1)
    left = np.ones((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), np.int32)
    for i in np.argsort(-share.max(axis=1, initial=0), kind="stable"):
        room = (left >= share[i] - 1e-12).all(axis=1)
        out[i] = np.argmax(np.where(room, left @ share[i], -np.inf)) if room.any() else np.argmax(left[:, 0])
        left[out[i]] -= share[i]
    return out


def assign_shards(docs: DataFrame, shards: int = 24, pieces: int = 64, whole: int = 4) -> DataFrame:
    """doc_id, size, text_crc32, tokens, shard and slot (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    rows = stored(_sizes(docs), "shard-sizes")
    measures = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = rows.agg(*measures).first()
    limits = {c: max(1.0, (total[c] or 0) / (shards * pieces)) for c in ("bytes", "tokens", "rows")}
    share = F.greatest(*[F.col(c) / F.lit(limit) for c, limit in limits.items()])
    large = rows.groupBy("text_key").agg(*measures).where((share > 1) & (F.col("rows") > 1)).select("text_key", F.when(share * whole <= pieces, 1).otherwise(F.ceil(share * 2 * whole / pieces)).cast("int").alias("parts"))
    large = stored(large, "shard-large-groups")
    small_bundle = F.concat(F.lit("s"), F.pmod(F.xxhash64("text_key"), F.lit(shards * pieces)).cast("string"))
    large_bundle = F.concat(F.lit("l"), F.col("text_key"), F.lit("-"), F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("string"))
    # At most 3 * shards * pieces rows: the bound that makes this broadcast safe.
    bundled = rows.join(F.broadcast(large), "text_key", "left").withColumn("bundle", F.when(F.col("parts").isNull(), small_bundle).otherwise(large_bundle)).drop("parts", "text_key")
    sums = sorted(tuple(r) for r in bundled.groupBy("bundle").agg(*measures).collect())
    chosen = pack(np.array([r[1:] for r in sums], float).reshape(-1, 3), shards)
    fill, placed = [0] * shards, []
    for (bundle, _, _, n), shard in zip(sums, chosen.tolist()):
        placed.append((bundle, shard, fill[shard]))
        fill[shard] += n
    within = Window.partitionBy("bundle").orderBy("doc_id", "size", "text_crc32")
    numbered = bundled.withColumn("nth", F.row_number().over(within) - 1)
    return numbered.join(F.broadcast(spark.createDataFrame(placed, BUNDLE)), "bundle").select(
        "doc_id", "size", "text_crc32", "tokens", "shard", (F.col("base") + F.col("nth")).alias("slot")
    )
