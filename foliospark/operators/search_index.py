"""A stored inverted index over chunks: posting lists, refresh by batch, compaction, block-max BM25.

Folders below the index root:

* ``chunks/segment=/part=``: number, length and the search columns of every chunk,
  parts by a hash of the block;
* ``postings/segment=/bucket=``: one row for each block of ``BLOCK`` neighbouring
  chunks and term bucket, with the terms, the number of entries of each, and the
  entries (offset in the block, frequency) as flat lists, and the chunks' lengths.
  A block that lies in two row groups of its file may have two rows of a bucket;
  ``bucket`` is a checksum of the term;
* ``terms/segment=/bucket=``: chunks that hold a term and its occurrences.
  Statistics are additive, so segments are never rewritten for new ones;
* ``manifest/version=``: the live segments.  A commit writes the next version,
  which fails if another writer took it; readers take the newest complete one.

A batch becomes one segment, so its cost does not depend on what is there.
``compact`` merges segments of about one size into one by copying rows: blocks
keep the name of the segment that they were made in.  A batch that was committed
before is left out when it comes again.

Lists are made where the chunks lie, batch by batch, so no occurrence of a word is
shuffled.  A search reads only the buckets of its terms, keeps the lists of those
terms, and brings them together by block.  A block is scored for every question and
gives the best ``k`` chunks of each, with what ties.  Texts are read for the chunks
found only.  There is no limit to k or to the number of questions, which go out in
slices of ``QUESTIONS``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.text import tokens
from ..session import work_folder
from .search import B, DEFAULT_K, INDEX_COLUMNS, K1, _bounded_slices, query_terms

#: Chunks of a block, term buckets, segments of one size that are merged.
BLOCK, BUCKETS, FAN = 2048, 16, 4
#: Questions that are sent to the tasks at a time.
QUESTIONS = 256
#: Scores are rounded to so many digits before they are ranked.
DIGITS = 4

_COLUMNS = ", ".join(f"{c} {'int' if c == 'chunk_index' else 'string'}" for c in INDEX_COLUMNS)
SCHEMAS = {
    "chunks": f"origin string, chunk_no long, chunk_len int, {_COLUMNS}, segment string, part int",
    "postings": "origin string, block long, lens array<int>, terms array<string>, sizes array<int>, uses array<long>, places array<int>, tfs array<int>, segment string, bucket int",
    "terms": "term string, df long, occurrences long, segment string, bucket int",
    "manifest": "segment string, chunks long, tokens long, batches array<long>, version long",
}


class Conflict(RuntimeError):
    """Another writer committed first."""


class SearchIndex:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.root, self.buckets, self.fan = spark, root.rstrip("/"), buckets, fan

    # --- versions ---------------------------------------------------------

    def _table(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[name])

    def version(self) -> int:
        """The newest complete version; 0 for an index that has none."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/version=*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return max((int(f.getPath().getParent().getName().split("=")[1]) for f in found or ()), default=0)

    def segments(self, version: int | None = None) -> list:
        """Live segments: some for each size, so their number grows with the logarithm of the index."""
        version = self.version() if version is None else version
        return self._table("manifest").where(F.col("version") == version).orderBy("segment").collect() if version else []

    def _commit(self, rows: list[tuple], base: int) -> int:
        """The next version after ``base``; refused if ``base`` is not the newest one any more."""
        if self.version() != base:
            raise Conflict(f"version {base} is outdated")
        schema = SCHEMAS["manifest"].removesuffix(", version long")
        try:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifest/version={base + 1}")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise Conflict(f"version {base + 1} is taken") from problem
        return base + 1

    def live(self, name: str, segments: list | None = None) -> DataFrame:
        segments = self.segments() if segments is None else segments
        return self._table(name).where(F.col("segment").isin([s["segment"] for s in segments]))

    # --- writing ----------------------------------------------------------

    def _write(self, df: DataFrame, name: str, segment: str, by: str, *order: str) -> None:
        # Files of a segment are its own; a retry of a batch writes them again.
        # Large parts are split over tasks, so a task's share does not grow with the batch.
        rows = df.hint("rebalance", F.col(by)).sortWithinPartitions(by, *order)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(by).parquet(f"{self.root}/{name}/segment={segment}")

    def add_batch(self, chunks: DataFrame, batch: int) -> bool:
        """Index the chunks as one segment; nothing happens if the batch was committed before."""
        base = self.version()
        live = self.segments(base)
        if any(lo <= batch <= hi for s in live for lo, hi in _ranges(s["batches"])):
            return False
        name = f"b{batch:012d}-{base:06d}"
        rows = chunks.select(*INDEX_COLUMNS, F.size(tokens(F.col("chunk_text"))).alias("chunk_len"))
        rows = rows.select(F.lit(name).alias("origin"), F.monotonically_increasing_id().alias("chunk_no"), "*")
        self._write(rows.withColumn("part", self._part("origin", _block("chunk_no"))), "chunks", name, "part", "origin", "chunk_no")
        mine = self._table("chunks").where(F.col("segment") == name)
        self._write(self._postings(mine, name), "postings", name, "bucket", "origin", "block")
        self._write(self._terms(name), "terms", name, "bucket", "term")
        total = mine.agg(F.count("*").alias("n"), F.coalesce(F.sum("chunk_len"), F.lit(0)).alias("t")).first()
        self._commit([*map(_state, live), (name, total["n"], total["t"], [batch, batch])], base)
        return True

    def _part(self, origin: str, block):
        return F.pmod(F.xxhash64(F.col(origin), block), F.lit(self.buckets)).cast("int")

    def _bucket(self, term: str):
        return F.pmod(F.crc32(F.col(term).cast("binary")), F.lit(self.buckets)).cast("int")

    def _postings(self, chunks: DataFrame, origin: str) -> DataFrame:
        """Chunks of a block are neighbours in their file, so a task makes its lists by itself."""
        read = chunks.select("chunk_no", tokens(F.col("chunk_text")).alias("words"))
        lists = read.mapInArrow(_inverted(self.buckets), LISTS)
        return lists.select(F.lit(origin).alias("origin"), *[c for c in lists.columns if c != "bucket"], "bucket")

    def _terms(self, segment: str) -> DataFrame:
        mine = self._table("postings").where(F.col("segment") == segment)
        each = mine.select("bucket", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("sizes").alias("df"), F.col("uses").alias("occurrences"))))
        return each.groupBy("bucket", "term").agg(F.sum("df").alias("df"), F.sum("occurrences").alias("occurrences")).select("term", "df", "occurrences", "bucket")

    def compact(self) -> int:
        """Merge segments of about one size until there are fewer than ``fan`` of each; the number of merges."""
        merges = 0
        while True:
            base = self.version()
            live = self.segments(base)
            tiers: dict[int, list] = {}
            for s in live:
                tiers.setdefault(_tier(s["chunks"], self.fan), []).append(s)
            full = next((t for t in sorted(tiers) if len(tiers[t]) >= self.fan), None)
            if full is None:
                return merges
            old = tiers[full]
            name = f"m{base:012d}-{full:03d}"
            self._write(self.live("chunks", old).drop("segment"), "chunks", name, "part", "origin", "chunk_no")
            self._write(self.live("postings", old).drop("segment"), "postings", name, "bucket", "origin", "block")
            terms = self.live("terms", old).groupBy("bucket", "term").agg(F.sum("df").alias("df"), F.sum("occurrences").alias("occurrences"))
            self._write(terms.select("term", "df", "occurrences", "bucket"), "terms", name, "bucket", "term")
            batches = _joined([r for s in old for r in _ranges(s["batches"])])
            new = (name, sum(s["chunks"] for s in old), sum(s["tokens"] for s in old), batches)
            self._commit([*(_state(s) for s in live if s not in old), new], base)
            merges += 1

    # --- reading ----------------------------------------------------------

    def statistics(self) -> DataFrame:
        """chunks and avg_len of the index."""
        live = self.segments()
        n, t = sum(s["chunks"] for s in live), sum(s["tokens"] for s in live)
        return self.spark.createDataFrame([(n, t / n if n else None)], "chunks long, avg_len double")

    def term_statistics(self) -> DataFrame:
        """Per term: number of chunks holding it and number of occurrences."""
        return self.live("terms").groupBy("term").agg(F.sum("df").alias("chunk_count"), F.sum("occurrences").alias("occurrences"))

    def rank(self, questions: DataFrame, k: int, where=None, query_id: str = "query_id", query_text: str = "query_text") -> DataFrame:
        """Best k chunks of each question: ``query_id, rank, score, chunk_id`` and where the chunk is stored.

        ``where`` is a condition on the search columns; statistics are those of the whole index.
        """
        if k < 1:
            raise ValueError("k must be at least 1")
        live = self.segments()
        total, length = sum(s["chunks"] for s in live), sum(s["tokens"] for s in live)
        average = length / total if total and length else 1.0
        wanted = query_terms(questions, query_id, query_text).withColumn("bucket", self._bucket("term"))
        # At most as many values as there are buckets; they choose the folders that are read.
        buckets = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]
        mine = lambda name: self.live(name, live).where(F.col("bucket").isin(buckets))
        df = mine("terms").join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
        idf = F.log(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
        # As many rows as there are questions; rows of one id are one question.
        weighted = wanted.join(df, "term").where(F.col("query_id").isNotNull()).groupBy("query_id").agg(F.collect_list(F.struct("term", idf.alias("idf"))).alias("terms"))
        lists = mine("postings").select("origin", "block", "lens", "terms", "sizes", "places", "tfs")
        allowed = None
        if where is not None:
            offset = F.pmod("chunk_no", F.lit(BLOCK)).cast("int")
            allowed = self.live("chunks", live).where(where).groupBy("origin", _block("chunk_no").alias("block")).agg(F.collect_list(offset).alias("allowed"))
        kind = wanted.schema["query_id"].dataType.simpleString()
        found = f"query_id {kind}, origin string, chunk_no long, score double"
        # Read twice below, and narrow: the best of each question, with all that ties, until their ids are known.
        path = work_folder(self.spark, "search-best")
        schema = f"{found}, part int"
        for part in _bounded_slices(weighted, "query_id", QUESTIONS):
            asked = [{t["term"]: 0.0 for t in r["terms"]} for r in part]
            for weights, r in zip(asked, part):
                for t in r["terms"]:
                    weights[t["term"]] += t["idf"]
            numbers = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
            kept = lists.mapInArrow(_kept(numbers), KEPT)
            kept = kept.join(allowed, ["origin", "block"]) if allowed is not None else kept.withColumn("allowed", F.lit(None).cast("array<int>"))
            weights = [[(numbers[t], w) for t, w in sorted(q.items())] for q in asked]
            scored = kept.groupBy("origin", "block").applyInArrow(_scored(weights, k, average), "query int, origin string, chunk_no long, score double")
            names = self.spark.createDataFrame([(i, r["query_id"]) for i, r in enumerate(part)], f"query int, query_id {kind}")
            by_score = Window.partitionBy("query").orderBy(F.desc("score"))
            best = scored.withColumn("score", F.round("score", DIGITS)).withColumn("place", F.rank().over(by_score)).where(F.col("place") <= k)
            best = best.join(F.broadcast(names), "query").select("query_id", "origin", "chunk_no", "score", self._part("origin", _block("chunk_no")).alias("part"))
            best.write.mode("append").parquet(path)
        best = self._stored(path, schema)
        named = best.join(self.live("chunks", live).select("origin", "chunk_no", "part", "chunk_id"), ["origin", "chunk_no", "part"])
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id")
        return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "score", "chunk_id", "origin", "chunk_no", "part")

    def _stored(self, path: str, schema: str) -> DataFrame:
        """What was written there, if anything was; its size is known, so small results are broadcast to the chunks."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def search(self, questions: DataFrame, k: int, where=None, query_id: str = "query_id", query_text: str = "query_text") -> DataFrame:
        """Best k chunks of each question: ``query_id, rank, score`` and the search columns."""
        found = self.rank(questions, k, where, query_id, query_text).drop("chunk_id")
        path = work_folder(self.spark, "search-found")
        found.write.parquet(path)
        found = self.spark.read.schema(found.schema).parquet(path)
        texts = self.live("chunks").drop("chunk_len", "segment")
        return found.join(texts, ["origin", "chunk_no", "part"]).select("query_id", "rank", "score", *INDEX_COLUMNS)

    def search_text(self, text: str, k: int = DEFAULT_K, where=None) -> DataFrame:
        """Best k chunks for one question."""
        question = self.spark.range(1).select(F.col("id").alias("query_id"), F.lit(text).alias("query_text"))
        return self.search(question, k, where).drop("query_id")


LISTS = "block long, lens array<int>, terms array<string>, sizes array<int>, uses array<long>, places array<int>, tfs array<int>, bucket int"
KEPT = "origin string, block long, lens array<int>, terms array<int>, sizes array<int>, places array<int>, tfs array<int>"


def _lists(bounds: np.ndarray, values) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def _inverted(buckets: int) -> Callable:
    """Chunk numbers and words in order become LISTS; the last block of a batch waits for the next batch."""

    def lists(rows: pa.Table) -> pa.RecordBatch:
        numbers = rows.column("chunk_no").to_numpy()
        words = rows.column("words").combine_chunks()
        lens = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
        coded = words.flatten().dictionary_encode()
        bucket = np.array([zlib.crc32(t.encode()) % buckets for t in coded.dictionary.to_pylist()], np.int64)
        blocks, block = np.unique(numbers // BLOCK, return_inverse=True)
        row = np.repeat(np.arange(len(numbers)), lens)
        code = coded.indices.to_numpy()
        n, terms = max(1, len(numbers)), max(1, len(bucket))
        key, tf = np.unique(((block[row] * buckets + bucket[code]) * terms + code) * n + row, return_counts=True)
        row, key = key % n, key // n
        term_at = np.flatnonzero(np.diff(key, prepend=-1))
        term, group = key[term_at] % terms, key[term_at] // terms
        at = np.flatnonzero(np.diff(group, prepend=-1))
        by_term, by_entry = np.append(at, len(term)), np.append(term_at[at], len(row))
        dense = []
        for b in range(len(blocks)):
            mine = np.flatnonzero(block == b)
            offset = numbers[mine] % BLOCK
            dense.append(np.zeros(offset.max() + 1, np.int32))
            dense[-1][offset] = lens[mine]
        of = group[at] // buckets
        uses = np.add.reduceat(tf, term_at) if len(term_at) else tf
        return pa.RecordBatch.from_arrays(
            [
                pa.array(blocks[of], pa.int64()),
                pa.array([dense[b] for b in of], pa.list_(pa.int32())),
                _lists(by_term, coded.dictionary.take(pa.array(term))),
                _lists(by_term, np.diff(np.append(term_at, len(row))).astype(np.int32)),
                _lists(by_term, uses.astype(np.int64)),
                _lists(by_entry, (numbers[row] % BLOCK).astype(np.int32)),
                _lists(by_entry, tf.astype(np.int32)),
                pa.array(group[at] % buckets, pa.int32()),
            ],
            names=[c.split()[0] for c in LISTS.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            block = held.column("chunk_no").to_numpy() // BLOCK
            cut = int(np.flatnonzero(np.diff(block, prepend=-1))[-1]) if len(block) else 0
            if cut:
                yield lists(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield lists(held)

    return run


def _kept(numbers: dict[str, int]) -> Callable:
    """KEPT: the lists of the numbered terms; rows that have none of them go."""
    terms = list(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(terms, pa.string())
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("lens", "terms", "sizes", "places", "tfs")}
                number = pc.fill_null(pc.index_in(row["terms"].values, wanted), -1).to_numpy()
                sizes, some = row["sizes"].values.to_numpy(), number >= 0
                if not some.any():
                    continue
                entries = np.repeat(some, sizes)
                flat = [number[some], sizes[some], *(row[c].values.to_numpy()[entries] for c in ("places", "tfs"))]
                columns = [pa.array([v], pa.list_(pa.int32())) for v in (row["lens"].values.to_numpy(), *flat)]
                yield pa.RecordBatch.from_arrays([batch.column("origin").slice(i, 1), batch.column("block").slice(i, 1), *columns], [c.split()[0] for c in KEPT.split(", ")])

    return run


def _scored(questions: list[list[tuple[int, float]]], k: int, average: float) -> Callable:
    """One block: for each question (its terms and their weights) the best k chunks and what may tie with the last of them."""
    names = ["query", "origin", "chunk_no", "score"]
    types = [pa.int32(), pa.string(), pa.int64(), pa.float64()]

    def run(key: tuple, block: pa.Table) -> pa.Table:
        parts = {c: [np.asarray(v, np.int64) for v in block.column(c).to_pylist()] for c in ("lens", "terms", "sizes", "places", "tfs")}
        lens = np.zeros(max(map(len, parts["lens"])), np.int64)
        for v in parts["lens"]:
            lens[: len(v)] = np.maximum(lens[: len(v)], v)
        sizes, places, tfs = (np.concatenate(parts[c]) for c in ("sizes", "places", "tfs"))
        points = tfs * (K1 + 1) / (tfs + K1 * (1 - B + B * lens[places] / average))
        ends = np.cumsum(sizes)
        spans: dict[int, list[slice]] = {}
        for term, size, end in zip(np.concatenate(parts["terms"]).tolist(), sizes.tolist(), ends.tolist()):
            spans.setdefault(term, []).append(slice(end - size, end))
        allowed = block.column("allowed")[0].as_py()
        mask = None if allowed is None else np.isin(np.arange(len(lens)), allowed)
        queries, found, scores = [], [], []
        for q, weights in enumerate(questions):
            mine = [(s, w) for term, w in weights for s in spans.get(term, ())]
            if not mine:
                continue
            score = np.bincount(np.concatenate([places[s] for s, _ in mine]), np.concatenate([points[s] * w for s, w in mine]), len(lens))
            if mask is not None:
                score = np.where(mask, score, 0)
            hit = np.flatnonzero(score > 0)
            if len(hit) > k:
                hit = hit[score[hit] >= np.partition(score[hit], -k)[-k] - 10.0**-DIGITS]
            queries.append(np.full(len(hit), q))
            found.append(hit)
            scores.append(score[hit])
        if not queries:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names)
        found = np.concatenate(found)
        origin, number = (v.as_py() for v in key)
        columns = [np.concatenate(queries), [origin] * len(found), found + number * BLOCK, np.concatenate(scores)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def _block(number: str):
    return F.floor(F.col(number) / BLOCK).cast("long")


def _state(s) -> tuple:
    return s["segment"], s["chunks"], s["tokens"], list(s["batches"])


def _tier(chunks: int, fan: int) -> int:
    """Powers of ``fan``; what is smaller than a block is one tier."""
    tier = 0
    while chunks >= BLOCK * fan ** (tier + 1):
        tier += 1
    return tier


def _ranges(bounds: list[int]) -> list[tuple[int, int]]:
    return list(zip(bounds[::2], bounds[1::2]))


def _joined(ranges: list[tuple[int, int]]) -> list[int]:
    """Batch numbers as bounds of ranges without gaps, so they stay few."""
    out: list[int] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1] + 1:
            out[-1] = max(out[-1], hi)
        else:
            out += [lo, hi]
    return out


def index_of(chunks: DataFrame) -> SearchIndex:
    """A new index of the chunks in the shared work folder."""
    index = SearchIndex(chunks.sparkSession, work_folder(chunks.sparkSession, "search-index"))
    index.add_batch(chunks, 0)
    return index


def bm25_search(chunks: DataFrame, questions: DataFrame, k: int = DEFAULT_K, document_class: str | None = None, query_id: str = "query_id", query_text: str = "query_text") -> DataFrame:
    """Best k chunks per question, of one class on request, from an index made for it: ``query_id, rank, score`` and the search columns."""
    corpus = chunks if document_class is None else chunks.where(F.col("document_class") == document_class)
    return index_of(corpus).search(questions, k, query_id=query_id, query_text=query_text)
