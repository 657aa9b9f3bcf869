"""Near-duplicate documents by one-permutation MinHash with optimal densification.

A document is the set of its distinct word shingles; two are linked if the
Jaccard similarity of the sets reaches ``similarity``.

1. One hash of every shingle fills ``BINS`` bins with their smallest values; an
   empty bin copies the first filled one in a fixed random order of its own.
   Each ``ROWS`` neighbouring bins make a band key.
2. Documents with equal sets are one class, a node with a number of its own.
   In every bucket of classes with one band key, the smallest is the centre,
   and only edges between the centre and each other member are candidates.
   Candidates are confirmed, or refuted, on the full sets: first each member with
   its smallest centre, then only edges between what is still apart.
3. A star can hide a link of a member that is not linked with its centre.  All
   members of such buckets go into finer ones, keyed by pairs of bands, which
   only similar documents share; stars again.  These only save work: every pair
   with a common band is settled after them.  Members near a common centre
   (``AROUND``) are compared around it if they are in different components.  Of a
   bucket with members farther from its centre, those are compared with all
   that the centre does not rule out.  Both happen in blocks of bounded size that
   give out only pairs to confirm.  Distances to the centre rule pairs out
   (Jaccard distance obeys the triangle inequality).
4. Components of the links are found by joins.

So a link is missed only if its pair shares no band, at a similarity of 0.75 with
a probability of about 5 in a million.  A null text or one without words is the empty set and linked
with nothing.  Rows are told apart by id and text, so texts of one id are nodes of
their own, and rows with a null id take part; a component is named by its smallest
id, or null if no row of it has one.  ``one_of_each`` keeps one row of each
component, of repeated rows too.  An empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_loop, distinct, list_array, stored, text_key, texts
from .components import components

BINS, ROWS = 128, 4
BANDS = BINS // ROWS
#: Up to this distance from a centre members are compared around it, else by bucket.
AROUND = 0.75
#: Distances between the two bands of a finer key.
STEPS = (1, 2, 3, 5)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_ODD = np.random.default_rng(5).integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: np.uint64 = np.uint64(0x9E3779B97F4A7C15)) -> np.ndarray:
    out = np.full(max(1, n), base)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts in order, and the number of words of each text."""
    raw = [t.encode("utf-8", "surrogatepass").translate(_LOWER) for t in batch]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    inside = data != 32
    edge = np.diff(inside.astype(np.int8), prepend=0)
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text_ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    counts = np.diff(np.searchsorted(begins, text_ends), prepend=0)
    if not len(begins):
        return np.zeros(0, np.uint64), counts
    lengths = ends - begins
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    terms = (data[inside].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64) * _ODD[63]), counts


def shingle_sets(batch: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than ``size`` words are one shingle."""
    words, counts = word_hashes(batch)
    n = len(words)
    joined = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        joined += words[k : k + len(joined)] * _ODD[k]
    joined = mix(joined)
    out, at = [], 0
    for count in counts.tolist():
        if count >= size:
            out.append(distinct(joined[at : at + count - size + 1]))
        elif count:
            out.append(mix(np.array([np.sum(words[at : at + count] * _ODD[32 : 32 + count]) + np.uint64(count)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out


def _orders() -> np.ndarray:
    """For each bin, the order in which others are asked when it is empty."""
    draw = np.random.default_rng(9)
    return np.stack([draw.permutation(BINS) for _ in range(BINS)])


def signatures(sets: list[np.ndarray], orders: np.ndarray) -> np.ndarray:
    """One row of BINS values for each set; empty sets stay empty."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), BINS), _EMPTY)
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    if not len(values):
        return out
    shift = np.uint64(64 - BINS.bit_length() + 1)
    place = np.repeat(np.arange(len(sets)), sizes) * BINS + (values >> shift).astype(np.int64)
    # Sets are sorted, so the first value of a bin is its smallest.
    first = np.flatnonzero(np.diff(place, prepend=-1))
    out.ravel()[place[first]] = values[first]
    filled = out != _EMPTY
    rows, bins = np.nonzero(~filled & (sizes > 0)[:, None])
    for t in range(BINS):
        if not len(rows):
            break
        asked = orders[bins, t]
        good = filled[rows, asked]
        out[rows[good], bins[good]] = out[rows[good], asked[good]]
        rows, bins = rows[~good], bins[~good]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    grouped = signature.reshape(len(signature), BANDS, ROWS)
    key = np.zeros(grouped.shape[:2], np.uint64)
    for r in range(ROWS):
        key += mix(grouped[:, :, r]) * _ODD[r]
    return mix(key + np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD[62]).view(np.int64)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.col("text").cast("string").alias("text"))


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """Two numbers for each set, 128 bits of a digest."""
    return np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8") for s in sets]).reshape(-1, 2)


def sketches(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, text_key, n_shingles, a 128-bit digest of the set (h1, h2) and the band keys."""

    def make():
        orders = _orders()

        def step(batch):
            sets = shingle_sets(texts(batch.column("text")), size)
            digest = _digests(sets)
            keys = band_keys(signatures(sets, orders))
            sizes = np.array([len(s) for s in sets], np.int64)
            keys_each = np.where(sizes > 0, BANDS, 0)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), list_array(keys[sizes > 0].ravel(), keys_each, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_shingles", "h1", "h2", "bands"])

        return step

    return _narrow(docs).mapInArrow(arrow_loop(make), "doc_id long, text_key binary, n_shingles long, h1 long, h2 long, bands array<long>")


def full_sets(texts_of: DataFrame, size: int = 5) -> DataFrame:
    """node and its set of shingle hashes, from node and text."""

    def make():
        def step(batch):
            sets = shingle_sets(texts(batch.column("text")), size)
            values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            return pa.RecordBatch.from_arrays([batch.column("node"), list_array(values, np.array([len(s) for s in sets], np.int64), pa.int64())], ["node", "shingles"])

        return step

    return texts_of.mapInArrow(arrow_loop(make), "node long, shingles array<long>")


def stars(keyed: DataFrame) -> DataFrame:
    """key, c and x of every bucket of ``keyed`` (key, node): its smallest node, and each other one."""
    centres = keyed.groupBy("key").agg(F.min("node").alias("c"), F.max("node").alias("z")).where("c < z").select("key", "c")
    return keyed.join(centres, "key").where("node <> c").select("key", "c", F.col("node").alias("x"))


def _apart(starred: DataFrame, found: DataFrame) -> DataFrame:
    """``starred`` with the components of centre and member; a node without links is its own."""
    for name in ("c", "x"):
        at = found.select(F.col("node").alias(name), F.col("component").alias(f"{name}_in"))
        starred = starred.join(at, name, "left").withColumn(f"{name}_in", F.coalesce(f"{name}_in", name))
    return starred


def _pointed(links: DataFrame) -> DataFrame:
    """node and a smaller node of its component, two links away at most.

    Less than components, which take many joins: nodes that it gives one number are
    in one component, and others may be, which only means more comparisons.
    """
    one = links.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component"))
    two = one.select(F.col("node").alias("component"), F.col("component").alias("further"))
    return one.join(two, "component", "left").select("node", F.coalesce("further", "component").alias("component"))


class _Confirm:
    """Exact similarities of candidate pairs; texts move once, and only for ``nodes``."""

    def __init__(self, docs: DataFrame, classes: DataFrame, nodes: DataFrame, size: int, scratch: Scratch):
        one = classes.join(nodes, "node", "left_semi").select("node", F.col("row.doc_id").alias("_id"), F.col("row.text_key").alias("_key"))
        rows = _narrow(docs)
        same = rows["doc_id"].eqNullSafe(one["_id"]) & (rows["text_key"] == one["_key"])
        found = full_sets(rows.join(one, same).select("node", "text"), size)
        # Rows with one id and one text are alike.
        self.sets, self.scratch = scratch.stored(found.dropDuplicates(["node"]), "near-dup-sets"), scratch

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """u, v, shared and total (sizes of intersection and union) of the distinct pairs."""
        sets = self.sets
        left = pairs.select("u", "v").distinct().join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
        both = left.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
        shared = F.size(F.array_intersect("a", "b"))
        return self.scratch.stored(both.select("u", "v", shared.alias("shared"), (F.size("a") + F.size("b") - shared).alias("total")), "near-dup-confirmed")


def _present(sets: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """For each set, which of the sorted ``words`` it has."""
    out = np.zeros((len(sets), len(words)), np.float32)
    for row, values in zip(out, sets):
        place = np.minimum(np.searchsorted(words, values), len(words) - 1)
        row[place[words[place] == values]] = 1
    return out


#: Members of a block that look for partners, and members that are looked through.
SEEKERS, SEEN = 128, 1024
#: Shingles of the seekers that are compared at a time.
CHUNK = 1 << 16


def _hidden(grouped: DataFrame, sets: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """u and v of pairs in one group that may be linked and are in different components.

    ``grouped``: kind and g (the group), x, d (distance to the group's centre), x_in
    (component) and seeks; in every pair one member seeks.  Sets are cut to 31 bits
    here; as many shingles more are allowed for as coincide in the smaller loss of both.
    """
    group = ["kind", "g"]
    counts = grouped.groupBy(group).agg(F.count(F.when(F.col("seeks"), 1)).alias("seekers"), F.count("*").alias("n"), F.min("x_in").alias("low"), F.max("x_in").alias("high"))
    parts = counts.where("seekers > 0 AND low < high").select(*group, F.ceil(F.col("seekers") / SEEKERS).cast("int").alias("ns"), F.ceil(F.col("n") / SEEN).cast("int").alias("nm"))
    short = sets.select(F.col("node").alias("x"), F.transform("shingles", lambda s: s.bitwiseAND(0x7FFFFFFF).cast("int")).alias("set"))
    rows = scratch.stored(grouped.join(parts, group).join(short, "x").select(*group, "x", "d", "x_in", "seeks", "ns", "nm", "set"), "near-dup-around")
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("x"), F.col(n)).cast("int")
    columns = [*group, "x", "d", "x_in", "set"]
    seeking = rows.where("seeks").select(*columns, F.lit(True).alias("seeks"), part("ns").alias("s"), up_to("nm").alias("m"))
    seen = rows.select(*columns, F.lit(False).alias("seeks"), up_to("ns").alias("s"), part("nm").alias("m"))
    limit = 1 - similarity + 1e-9

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        a, b = block[block["seeks"]], block[~block["seeks"]]
        out = []
        if len(a) and len(b):
            words = np.unique(np.concatenate(a["set"].to_list()))
            size_a, size_b = (np.array([len(v) for v in x["set"]], float) for x in (a, b))
            lost_a, lost_b = (size - [len(distinct(v)) for v in x["set"]] for size, x in ((size_a, a), (size_b, b)))
            close = np.abs(a["d"].to_numpy()[:, None] - b["d"].to_numpy()) <= limit
            close &= a["x_in"].to_numpy()[:, None] != b["x_in"].to_numpy()
            for at in range(0, len(b), 128):
                some = b["set"].iloc[at : at + 128].to_list()
                shared = np.zeros((len(a), len(some)))
                for low in range(0, len(words), CHUNK):
                    chunk = words[low : low + CHUNK]
                    shared += _present(a["set"].to_list(), chunk) @ _present(some, chunk).T
                shared += np.minimum(lost_a[:, None], lost_b[at : at + 128])
                total = size_a[:, None] + size_b[at : at + 128] - shared
                i, j = np.nonzero((shared >= similarity * total - 1e-6) & close[:, at : at + 128])
                out.append((a["x"].to_numpy()[i], b["x"].to_numpy()[at + j]))
        u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*out) if out else ((), ())))
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)})

    return seeking.unionByName(seen).groupBy(*group, "s", "m").applyInPandas(compare, "u long, v long")


def near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    rows, named = _grouped(docs, size, similarity)
    joined = rows.select("doc_id", "n_shingles", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("row.doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def one_of_each(docs: DataFrame, size: int = 5, similarity: float = 0.75) -> DataFrame:
    """The rows of ``docs`` that are kept: of each component the one with the smallest id, then text digest."""
    rows, named = _grouped(docs, size, similarity)
    each = rows.where("n_shingles > 0").groupBy("doc_id", "text_key", "h1", "h2").agg(F.count("*").alias("n")).join(named, ["h1", "h2"])
    this = F.col("doc_id").eqNullSafe(F.col("row.doc_id")) & (F.col("text_key") == F.col("row.text_key"))
    marks = each.where(~this | (F.col("n") > 1)).select(F.struct("doc_id", "text_key").alias("key"), this.alias("one"))
    marks = stored(marks, "near-dup-marks")
    # Whole rows travel as one column, so no name of theirs can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.struct(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key")).alias("key"))
    named_row = [F.col(f"row.`{c}`") for c in docs.columns]
    left = keyed.join(marks.select("key"), "key", "left_anti")
    repeated = keyed.join(marks.where("one").select("key"), "key").dropDuplicates(["key"])
    return left.select(*named_row).unionByName(repeated.select(*named_row))


def _grouped(docs: DataFrame, size: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """The sketched rows, and for each set (h1, h2) the first row (doc_id, text_key) of its component."""
    spark = docs.sparkSession
    percent = round(100 * similarity)
    linked = F.col("shared") * 100 >= F.col("total") * percent
    distance = (1 - F.col("shared") / F.col("total")).alias("d")
    first_row = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("row")
    as_pairs = lambda s: s.select(F.col("c").alias("u"), F.col("x").alias("v"))
    with Scratch(spark) as scratch:
        rows = scratch.keep(scratch.stored(sketches(docs, size), "near-dup-sketches"))
        sets = rows.where("n_shingles > 0").groupBy("h1", "h2").agg(first_row, F.first("bands").alias("bands"))
        classes = scratch.stored(sets.withColumn("node", F.monotonically_increasing_id()), "near-dup-classes")

        first = scratch.stored(stars(classes.select(F.explode("bands").alias("key"), "node")), "near-dup-stars")
        confirm = _Confirm(docs, classes, first.select(F.explode(F.array("c", "x")).alias("node")).distinct(), size, scratch)
        known = confirm(first.groupBy(F.col("x").alias("v")).agg(F.min("c").alias("u")))
        # What is read several times is stored: a plan that holds it each time costs the driver memory for every step of it.
        found = scratch.stored(_pointed(known.where(linked)), "near-dup-pointed")
        known = known.unionByName(confirm(as_pairs(_apart(first, found).where("x_in <> c_in")).distinct().join(known.select("u", "v"), ["u", "v"], "left_anti")))
        found = scratch.stored(_pointed(known.where(linked)), "near-dup-pointed")

        # What a star can hide is between a member that is not linked with its centre and any other of the bucket.
        stray = _apart(first, found).where("x_in <> c_in").select("key").distinct()
        crowded = scratch.stored(first.join(stray, "key", "left_semi"), "near-dup-crowded")
        crowd = crowded.select(F.explode(F.array("c", "x")).alias("node")).distinct()
        band = lambda i: F.element_at("bands", F.lit(i % BANDS + 1))
        fine_keys = F.array(*[F.xxhash64(F.lit(i * 100 + s), band(i), band(i + s)) for i in range(BANDS) for s in STEPS])
        second = stars(classes.join(crowd, "node", "left_semi").select(F.explode(fine_keys).alias("key"), "node")).select("c", "x").distinct()
        # Distances to the centres are needed in these buckets, of members that are linked with them by others too.
        wanted = as_pairs(_apart(second, found).where("x_in <> c_in")).unionByName(as_pairs(crowded)).distinct()
        known = known.unionByName(confirm(wanted.join(known.select("u", "v"), ["u", "v"], "left_anti")))
        links = known.where(linked).select("u", "v")
        found = scratch.stored(components(links, scratch), "near-dup-found")

        # A pair near a common centre is hidden there if its members are in different components.
        edges = known.select(F.col("u").alias("c"), F.col("v").alias("x"), distance)
        placed = _apart(edges.where(F.col("d") <= AROUND), found).select(F.lit(0).alias("kind"), F.col("c").alias("g"), "x", "d", "x_in", (F.col("x_in") != F.col("c_in")).alias("seeks"))
        # Any other one has a member farther away, and the second at most 1 - similarity nearer than that.
        far = F.col("d") > AROUND
        loose = crowded.join(edges.where(F.col("d") > AROUND - (1 - similarity) - 1e-9), ["c", "x"])
        buckets = loose.groupBy("key").agg(F.max("d").alias("d"), F.count("*").alias("n")).where(far & (F.col("n") > 1)).select("key")
        by_bucket = _apart(loose.join(buckets, "key"), found).select(F.lit(1).alias("kind"), F.col("key").alias("g"), "x", "d", "x_in", far.alias("seeks"))
        more = confirm(_hidden(placed.unionByName(by_bucket), confirm.sets, similarity, scratch))
        # The components found so far hold all older links, so the rounds go on from there.
        older = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
        found = scratch.stored(components(older.unionByName(more.where(linked).select("u", "v")), scratch), "near-dup-found")

        placed = classes.select("h1", "h2", "row", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        firsts = placed.groupBy("component").agg(F.min("row").alias("row"))
        named = scratch.keep(scratch.stored(placed.select("h1", "h2", "component").join(firsts, "component").select("h1", "h2", "row"), "near-dup-components"))
    return rows, named
