"""Structured Streaming queries.

The documents are written as arriving files in the shared folder, streamed
through the flow, and the stored tables are read back.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import search_index, splitting
from ..operators.routing import new_files
from ..sources.tables import TableFolder, read_if_there
from ..streaming.flow import DocumentFlow, Hooks, drain, stream_arrivals
from .catalog_documents import RULES, WORDS, BM25, CLASS_OF_ALL, CHUNKS, TOKENS
from .fixtures import Data
from .registry import query

AS_OF = datetime(2024, 3, 1)
# Two arrivals that together are all documents.
FIRST_AND_SECOND = ("lang <= 'en'", "lang > 'en'")
PARSE = r"regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX|JPE?G|PNG|TIFF?|HTML|TXT)$')"
LARGE = r"size > 104857600 AND regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX)$')"


def arrive(d: Data, folder: str, condition: str = "true") -> None:
    """Files that arrive now; plain text, so that HTML reading does not alter it."""
    rows = d.spread().staged.filter(condition)
    rows.select(F.replace("relative_path", F.lit(".html"), F.lit(".txt")).alias("relative_path"), "size", "file_url", F.col("text").alias("raw_text")).write.mode("append").parquet(folder)


def count_pages(registry):
    """Stand-in for a page counter: 800,000 bytes make a page."""
    return registry.withColumn("page_count", F.ceil(F.col("original_file_size") / F.lit(800000.0)).cast("bigint"))


def read_pages(d: Data):
    """Stand-in for a page reader: the text in as many pages as were counted."""
    texts = d.staged.select(F.col("relative_path").alias("original_file_path"), "text")

    def pages(planned):
        rows = planned.join(texts, "original_file_path").select("registry_id", "text", F.explode(F.sequence(F.lit(1).cast("bigint"), "page_count")).alias("page_number"))
        return rows.select("registry_id", "page_number", F.substring("text", F.col("page_number").cast("int") * 40 - 39, F.lit(40)).alias("page_text"))

    return pages


def new_flow(d: Data, arrivals: str | None = None, index=None) -> DocumentFlow:
    hooks = Hooks(count_pages=count_pages, read_pages=read_pages(d) if arrivals else None)
    tables = TableFolder(d.spark, d.folder("flow"))
    return DocumentFlow(tables, WORDS, RULES, hooks=hooks, feedback=arrivals, clock=lambda: AS_OF, index=index)


def run(flow: DocumentFlow, d: Data, arrivals: str, checkpoint: str) -> None:
    flow.start(stream_arrivals(d.spark, arrivals), checkpoint).awaitTermination()


@query("t1_incremental_discovery", "SELECT relative_path, size, CASE WHEN lang <= 'en' THEN 0 ELSE 1 END AS batch FROM staged", "staged")
def _(d: Data):
    """Two runs over a growing folder deliver every file once."""
    arrivals, checkpoint, seen = d.folder("arrivals"), d.folder("checkpoint"), d.folder("seen")

    def keep(df, batch):
        df.select("file_url", "size", F.lit(batch).cast("int").alias("batch")).write.mode("append").parquet(seen)

    for condition in FIRST_AND_SECOND:
        arrive(d, arrivals, condition)
        query = stream_arrivals(d.spark, arrivals).writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)
        query.trigger(availableNow=True).start().awaitTermination()
    got = d.spark.read.schema("file_url string, size bigint, batch int").parquet(seen)
    return got.join(d.staged.select("file_url", "relative_path"), "file_url").select("relative_path", "size", "batch")


@query("s2_new_file_stream", "SELECT replace(relative_path, '.html', '.txt') AS relative_path, size FROM staged", "staged")
def _(d: Data):
    arrivals, checkpoint, out = d.folder("arrivals"), d.folder("checkpoint"), d.folder("out")
    arrive(d, arrivals)
    rows = new_files(stream_arrivals(d.spark, arrivals)).select("relative_path", "size")
    rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return d.spark.read.schema(rows.schema).parquet(out)


@query("s4_drain_stream", "SELECT count(*) AS arrived, 0 AS delivered FROM staged", "staged")
def _(d: Data):
    arrivals, checkpoint, seen = d.folder("arrivals"), d.folder("checkpoint"), d.folder("seen")
    arrive(d, arrivals)
    drain(stream_arrivals(d.spark, arrivals), checkpoint)
    rows = stream_arrivals(d.spark, arrivals).select("file_url")
    rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch: df.write.mode("append").parquet(seen)
    ).trigger(availableNow=True).start().awaitTermination()
    after = read_if_there(d.spark, "file_url string", seen)
    delivered = 0 if after is None else after.count()
    return d.spark.read.schema("size bigint").parquet(arrivals).agg(F.count("*").alias("arrived")).withColumn("delivered", F.lit(delivered))


@query(
    "s3_captured_batch",
    f"SELECT count(*) AS stream_count, count(*) FILTER (size <= 104857600 AND {PARSE}) AS processed_count, count(*) FILTER ({LARGE}) AS large_count FROM staged",
    "staged",
)
def _(d: Data):
    flow, arrivals = new_flow(d), d.folder("arrivals")
    arrive(d, arrivals)
    run(flow, d, arrivals, d.folder("checkpoint"))
    metrics = flow.tables.read("run_metrics")
    return metrics.agg(*[F.sum(c).alias(c) for c in ("stream_count", "processed_count", "large_count")])


FLOW_STATUS = f"""SELECT 'Stream' AS stage, count(*) AS count, CAST(NULL AS VARCHAR) AS status FROM staged
  UNION ALL SELECT 'Parsed Documents', count(*), 'classified' FROM todo
  UNION ALL SELECT 'Classifications', count(*), document_class FROM labelled GROUP BY document_class
  UNION ALL SELECT 'Extractions', count(*), 'extracted' FROM todo
  UNION ALL SELECT 'Chunks', count(*), 'chunked' FROM chunks
  UNION ALL SELECT 'Large Documents', count(*), CASE WHEN ceil(size / 800000.0) > 200 THEN 'split_complete' ELSE 'unsplittable' END FROM staged WHERE {LARGE} GROUP BY 3
  UNION ALL SELECT 'CSV Files', count(*), 'pending' FROM staged WHERE upper(relative_path) LIKE '%.CSV'
  UNION ALL SELECT 'Excel Conversions', count(*), 'pending' FROM staged WHERE regexp_matches(upper(relative_path), '\\.XLS[XM]$') AND relative_path NOT LIKE 'converted_excel/%'"""
TODO = f", todo AS (SELECT concat('DOC_', doc_id) AS document_id, text AS content_text, 'parsed' AS status FROM staged WHERE size <= 104857600 AND {PARSE} AND length(trim(text)) > 0)"
STREAM_SQL = TODO + "," + CLASS_OF_ALL.replace("FROM parsed", "FROM todo") + CHUNKS.replace("FROM parsed", "FROM todo")


def full_run(d: Data, replay: bool = False, index=None) -> tuple[DocumentFlow, str]:
    flow, arrivals, checkpoint = new_flow(d, index=index), d.folder("arrivals"), d.folder("checkpoint")
    for condition in FIRST_AND_SECOND:
        arrive(d, arrivals, condition)
        run(flow, d, arrivals, checkpoint)
    if replay:
        # The second batch once more, as after a crash before its commit.
        rows = d.spread().staged.filter(FIRST_AND_SECOND[1]).select(
            F.replace("relative_path", F.lit(".html"), F.lit(".txt")).alias("relative_path"), "size", "file_url", F.col("text").alias("raw_text")
        )
        flow.run_batch(rows, 1)
    return flow, arrivals


@query("t3_stage_chain", STREAM_SQL + FLOW_STATUS, "staged")
def _(d: Data):
    flow, arrivals = full_run(d)
    return flow.status(d.spark.read.schema("size bigint").parquet(arrivals))


@query("t5_replay_adds_nothing", STREAM_SQL + FLOW_STATUS, "staged")
def _(d: Data):
    flow, arrivals = full_run(d, replay=True)
    return flow.status(d.spark.read.schema("size bigint").parquet(arrivals))


@query(
    "t4_split_feedback",
    f"""SELECT concat('split_documents/', regexp_replace(regexp_extract(relative_path, '[^/]+$'), '\\.[^.]*$', ''), '_part_', i, '_of_', n, '.pdf') AS file_path, i AS part_number,
          substring(text, (i - 1) * 8000 + 1, 8000) AS content_text
        FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM (SELECT relative_path, text, CAST(ceil(size / 160000000.0) AS BIGINT) AS n FROM staged WHERE {LARGE} AND size > 160000000) a) b""",
    "staged",
)
def _(d: Data):
    """Parts of split documents come back as new arrivals and are parsed as parts."""
    arrivals, checkpoint = d.folder("arrivals"), d.folder("checkpoint")
    flow = new_flow(d, arrivals)
    arrive(d, arrivals)
    run(flow, d, arrivals, checkpoint)
    run(flow, d, arrivals, checkpoint)
    back = flow.tables.read("parsed_documents").filter("is_split_part and file_path like 'split_documents/%'")
    linked = splitting.link_parts(back, flow.tables.read("document_split_parts"))
    return linked.select("file_path", "part_number", "content_text")


def refreshed(d: Data) -> search_index.SearchIndex:
    """The index after two batches of the flow, the second twice, and a compaction."""
    index = search_index.SearchIndex(d.spark, d.folder("index"), fan=2)
    full_run(d, replay=True, index=index)
    index.compact()
    return index


@query("t6_corpus_refresh", STREAM_SQL + TOKENS.lstrip() + " SELECT count(*) AS chunks, round(avg(len(t)), 4) AS avg_len FROM tk", "staged")
def _(d: Data):
    """Statistics of the search corpus after two batches."""
    return refreshed(d).statistics().select("chunks", F.round("avg_len", 4).alias("avg_len"))


@query("t6_refreshed_search", STREAM_SQL + BM25.removeprefix(CHUNKS) + " SELECT query_id, rank, score FROM ranked WHERE rank <= 10", "staged")
def _(d: Data):
    """Searches after two batches score as an index of everything does; ids are those of the flow, so ties differ."""
    return refreshed(d).rank(d.questions, 10).select("query_id", "rank", "score")


@query("t2_interval_trigger", "SELECT count(*) AS delivered FROM staged", "staged")
def _(d: Data):
    """The interval trigger delivers what is there and then waits."""
    arrivals, out = d.folder("arrivals"), d.folder("out")
    arrive(d, arrivals)
    rows = stream_arrivals(d.spark, arrivals).select("file_url")
    stream = rows.writeStream.option("checkpointLocation", d.folder("checkpoint")).trigger(processingTime="1 second").start(out)
    stream.processAllAvailable()
    stream.stop()
    return d.spark.read.schema(rows.schema).parquet(out).agg(F.count("*").alias("delivered"))
