"""The document flow as a stream: discover, route, parse, classify, extract, chunk, split.

Each micro-batch runs the batch operators in that order inside ``foreachBatch``.
A stage writes its rows to a stored table under the batch id and the next stage
reads them back, which cuts the lineage and lets a lost executor recompute one
stage only.  Every stage compares with the tables of *earlier* batches, so a
batch that runs again after a crash writes the same rows to the same place.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import paths
from ..functions.jsontext import path_value
from ..operators import chunking, classify, extract, routing, sheets, splitting, state
from ..operators.provider import Provider
from ..operators.search_index import SearchIndex
from ..schemas import conform, extraction_prompts
from ..seeds import CLASS_WORDS, EXTRACT_RULES, ClassWord, ExtractRule
from ..sources import csvfiles, documents, listing
from ..sources.tables import BATCH, TableFolder

ARRIVALS = "relative_path string, size bigint, file_url string, raw_text string"


def stream_arrivals(spark: SparkSession, folder: str, max_files: int = 100) -> DataFrame:
    """Files that arrive as rows with their raw text, e.g. from an upstream decoder."""
    source = spark.readStream.schema(ARRIVALS).option("recursiveFileLookup", True)
    return source.option("maxFilesPerTrigger", max_files).parquet(folder)


@contextmanager
def _adaptive(session: SparkSession, like: SparkSession) -> Iterator[None]:
    """Adaptive execution in a stream's session as in the session ``like``, for cached rows too, for the block.

    A stream turns it off for its state stores, and Spark for what is cached.  The rows of a
    batch have no state, and without it each step over them has all shuffle partitions, and as many files.
    """
    names = ("spark.sql.adaptive.enabled", "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning")
    before = [session.conf.get(name) for name in names]
    for name in names:
        session.conf.set(name, like.conf.get(names[0]))
    try:
        yield
    finally:
        for name, value in zip(names, before):
            session.conf.set(name, value)


class Hooks(NamedTuple):
    """What only a user's own code can supply; every hook may be missing.

    ``decode``: text of file contents that are not text or HTML.
    ``label``: class of a text.
    ``answer``: result object for a request of text and questions.
    ``count_pages``: registry rows of large files with ``page_count`` added.
    ``read_pages``: their pages as ``registry_id, page_number, page_text``.
    ``read_cells``: pending spreadsheets to a pair of frames, sheets
    (``registry_id, sheet_index, sheet_name``) and cells.
    """

    decode: Provider | None = None
    label: Provider | None = None
    answer: Provider | None = None
    count_pages: Callable[[DataFrame], DataFrame] | None = None
    read_pages: Callable[[DataFrame], DataFrame] | None = None
    read_cells: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None


class DocumentFlow:
    def __init__(
        self,
        tables: TableFolder,
        words: Sequence[ClassWord] = CLASS_WORDS,
        rules: Sequence[ExtractRule] = EXTRACT_RULES,
        chunk_mode: str = "packed",
        hooks: Hooks = Hooks(),
        feedback: str | None = None,
        csv_base: str | None = None,
        clock: Callable[[], datetime] | None = None,
        index: SearchIndex | None = None,
    ):
        self.tables = tables
        self.spark = tables.spark
        self.words = words
        self.rules = rules
        self.chunk_mode = chunk_mode
        self.hooks = hooks
        self.feedback = feedback
        self.csv_base = csv_base
        self.index = index
        self.clock = clock or (lambda: datetime.now(timezone.utc).replace(tzinfo=None))

    # --- one micro-batch ---------------------------------------------------

    def run_batch(self, arrived: DataFrame, batch: int) -> None:
        with _adaptive(arrived.sparkSession, self.spark):
            self._run_batch(arrived, batch)

    def _run_batch(self, arrived: DataFrame, batch: int) -> None:
        as_of = self.clock()
        captured = routing.first_per_path(routing.route_files(arrived)).persist()
        try:
            empty = captured.isEmpty()
            if not empty:
                self._register(captured, batch, as_of)
                self._parse(captured, batch, as_of)
                self._measure(captured, batch, as_of)
        finally:
            captured.unpersist()
        if self.csv_base:
            load_csv_batch(self.tables, self.csv_files(batch), self.csv_base, batch, as_of)
        if empty:
            return
        self._classify(batch, as_of)
        self._extract(batch, as_of)
        self._chunk(batch, as_of)
        self._split(batch, as_of)
        self._convert(batch, as_of)

    def _before(self, table: str, batch: int) -> DataFrame:
        return self.tables.read(table, before=batch)

    def _new(self, table: str, batch: int) -> DataFrame:
        return self.tables.read(table, only=batch)

    def _register(self, captured: DataFrame, batch: int, as_of: datetime) -> None:
        sheets = routing.register_spreadsheets(captured, self._before("excel_document_registry", batch), as_of)
        self.tables.write("excel_document_registry", sheets, batch)
        self.tables.write("csv_file_registry", routing.register_csv(captured, self._before("csv_file_registry", batch), as_of), batch)
        self.tables.write("rejected_files", routing.rejected_files(captured), batch)

    def _measure(self, captured: DataFrame, batch: int, as_of: datetime) -> None:
        """What is known after parsing: the split registry, with documents over the page limit, and the counts."""
        known = self._before("large_document_registry", batch)
        large = routing.register_large(captured, known, self._before("parsed_documents", batch), as_of)
        error = path_value(F.col("parsed_content"), "$.errorInformation").alias("error_information")
        failed = self._new("parsed_documents", batch).filter("status = 'parse_error'").select("file_path", "file_name", "file_size", error)
        self.tables.write("large_document_registry", large.unionByName(routing.register_page_limit(failed, known, as_of)), batch)
        rows = captured.select("relative_path", "route").join(failed.withColumnRenamed("file_path", "relative_path"), "relative_path", "left")
        self.tables.write("run_metrics", state.run_summary(rows), batch)

    def _parse(self, captured: DataFrame, batch: int, as_of: datetime) -> None:
        parsed, large = self._before("parsed_documents", batch), self._before("large_document_registry", batch)
        # Known files drop out of the narrow listing before any text is read or moved.
        routed = routing.unparsed(captured, parsed, large)
        if "raw_text" not in captured.columns:
            routed = self._read_text(routed)
        rows = routing.parsed_rows(documents.attach_text(routed), as_of)
        self.tables.write("parsed_documents", rows, batch)

    def _read_text(self, routed: DataFrame) -> DataFrame:
        """Join the batch's files with their text; at most one trigger's files."""
        textual = paths.has_extension(F.col("relative_path"), documents.TEXT_TYPES).alias("textual")
        files = routed.select("file_url", textual).collect()
        found = []
        if texts := [r["file_url"] for r in files if r["textual"]]:
            found.append(documents.read_texts(self.spark, texts).withColumn("error_information", F.lit(None).cast("string")))
        others = [r["file_url"] for r in files if not r["textual"]]
        if others and self.hooks.decode is not None:
            found.append(documents.read_decoded(self.spark, others, self.hooks.decode))
        if not found:
            return routed.withColumn("raw_text", F.lit(None).cast("string"))
        # Both sides name a file by its URI; only the slashes behind the scheme differ.
        key = F.regexp_replace("file_url", "^file:/+", "file:/")
        contents = reduce(DataFrame.unionByName, found).withColumnRenamed("content", "raw_text")
        return routed.withColumn("_k", key).join(contents.withColumn("_k", key).drop("file_url"), "_k", "left").drop("_k")

    def _classify(self, batch: int, as_of: datetime) -> None:
        rows = classify.classify(self._new("parsed_documents", batch), as_of, self.words, self.hooks.label)
        self.tables.write("document_classifications", rows, batch)

    def _extract(self, batch: int, as_of: datetime) -> None:
        todo = extract.extractable(
            self._new("document_classifications", batch),
            self._new("parsed_documents", batch),
            self._before("document_extractions", batch),
        )
        prompts = extraction_prompts(self.spark)
        if self.hooks.answer is None:
            rows = extract.extract(todo, prompts, as_of, self.rules)
        else:
            rows = extract.extract_by_provider(todo, prompts, self.hooks.answer, as_of)
        self.tables.write("document_extractions", rows, batch)

    def _chunk(self, batch: int, as_of: datetime) -> None:
        rows = chunking.chunk_documents(
            self._new("parsed_documents", batch),
            self._new("document_classifications", batch),
            self._before("document_chunks", batch),
            as_of,
            self.chunk_mode,
        )
        self.tables.write("document_chunks", rows, batch)
        if self.index is not None:
            # One segment a batch; full tiers of segments are merged, so their number stays small.
            self.index.add_batch(self._new("document_chunks", batch), batch)
            self.index.compact()

    def _split(self, batch: int, as_of: datetime) -> None:
        """Plan parts of large files that wait, of whatever batch; without page counts they go on waiting.

        With pages at hand the part texts go to the feedback folder and come back
        as arrivals.
        """
        waiting = splitting.pending_splits(self.large_documents(batch))
        if self.hooks.count_pages is None:
            external = waiting.filter("split_status <> 'requires_external_processing'").select(
                "registry_id", F.lit("requires_external_processing").alias("split_status"), F.lit(as_of).alias("event_time")
            )
            self.tables.write("split_events", conform(external, "split_events"), batch)
            return
        planned = splitting.plan_splits(self.hooks.count_pages(waiting))
        events = planned.select(
            "registry_id", "split_status", "split_count", F.col("page_count").alias("estimated_pages"), F.lit(_after(as_of)).alias("event_time")
        )
        begun = planned.select("registry_id", F.lit("splitting").alias("split_status"), F.lit(as_of).alias("event_time"))
        self.tables.write("split_events", conform(begun, "split_events").unionByName(conform(events, "split_events")), batch)
        self.tables.write("document_split_parts", splitting.part_rows(planned, as_of), batch)
        if self.hooks.read_pages is not None and self.feedback:
            parts = self._new("document_split_parts", batch)
            pages = self.hooks.read_pages(planned.filter(F.col("split_count") > 0))
            texts = splitting.split_pages(pages, "registry_id").select("registry_id", "part_number", "part_text")
            self._feed(parts.join(texts, ["registry_id", "part_number"]), "part_stage_path", "part_text", f"parts-{batch}")

    def _convert(self, batch: int, as_of: datetime) -> None:
        """Describe the sheets of spreadsheets that wait, of whatever batch, if their cells can be read.

        The whole text of a workbook goes to the feedback folder, in parts by row range.
        """
        if self.hooks.read_cells is None:
            return
        pending = self.spreadsheets(batch).filter("conversion_status = 'pending'")
        found, cells = self.hooks.read_cells(pending)
        self.tables.write("excel_sheet_metadata", sheets.sheet_metadata(found, cells, as_of), batch)
        metadata = self._new("excel_sheet_metadata", batch)
        counts = metadata.groupBy("registry_id").agg(F.count("*").alias("sheet_count"))
        rendered = sheets.workbook_parts(pending, metadata, cells)
        events = rendered.filter("part_number = 1").join(counts, "registry_id").withColumns(
            {"conversion_status": F.lit("converted"), "event_time": F.lit(_after(as_of))}
        )
        begun = events.select("registry_id", F.lit("converting").alias("conversion_status"), F.lit(as_of).alias("event_time"))
        self.tables.write("conversion_events", conform(begun, "conversion_events").unionByName(conform(events, "conversion_events")), batch)
        if self.feedback:
            self._feed(rendered, "converted_pdf_path", "document_text", f"sheets-{batch}")

    def _feed(self, rows: DataFrame, path: str, text: str, name: str) -> None:
        """Write texts as arrivals; a batch that runs again replaces its own."""
        rows.select(
            F.col(path).alias("relative_path"),
            F.octet_length(text).cast("bigint").alias("size"),
            F.col(path).alias("file_url"),
            F.col(text).alias("raw_text"),
        ).write.mode("overwrite").parquet(f"{self.feedback}/{name}")

    # --- streams -------------------------------------------------------------

    def start(self, arrived: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Run over a stream: at an interval, or once over all that is there."""
        writer = arrived.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.run_batch)
        writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
        return writer.start()

    # --- current state ---------------------------------------------------------

    def parsed(self) -> DataFrame:
        """Parsed documents with their present status."""
        return state.mark_classified(self.tables.read("parsed_documents"), self.tables.read("document_classifications"))

    def _states(self, registry: str, events: str, status: str, batch: int | None) -> DataFrame:
        """Registered files with their state; with ``batch``, as that batch finds them when it runs, or runs again."""
        files = self.tables.read(registry)
        if batch is not None:
            files = self._before(registry, batch).unionByName(self._new(registry, batch))
        return state.apply_status_events(files, self.tables.read(events, before=batch), "registry_id", status)

    def large_documents(self, batch: int | None = None) -> DataFrame:
        return self._states("large_document_registry", "split_events", "split_status", batch)

    def csv_files(self, batch: int | None = None) -> DataFrame:
        return self._states("csv_file_registry", "csv_events", "processing_status", batch)

    def spreadsheets(self, batch: int | None = None) -> DataFrame:
        return self._states("excel_document_registry", "conversion_events", "conversion_status", batch)

    def status(self, stream: DataFrame) -> DataFrame:
        from ..plans.reports import stage_status

        return stage_status(
            stream,
            self.parsed(),
            self.tables.read("document_classifications"),
            self.tables.read("document_extractions"),
            self.tables.read("document_chunks"),
            self.large_documents(),
            self.csv_files(),
            self.spreadsheets(),
        )


def drain(arrived: DataFrame, checkpoint: str) -> None:
    """Move a stream's position to its end without processing anything."""
    query = (
        arrived.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, batch: None)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _after(moment: datetime) -> datetime:
    """The time of a final state, behind that of the running state."""
    return moment + timedelta(milliseconds=1)


def _plain(path: str) -> str:
    """A path without scheme and leading slashes."""
    return re.sub("^([A-Za-z][A-Za-z0-9+.-]*:)?/*", "", path)


def _uri_key(uri: str) -> str:
    """What ``_plain`` makes of the path that a file URI spells."""
    return unquote(_plain(uri))


class _CsvGroup:
    """Files of one target table with the same columns, read together."""

    def __init__(self, spark: SparkSession, members: list, names: list[str], multi_line: bool):
        self.members, self.names = members, names
        self.raw = csvfiles.read_csv(spark, [m["url"] for m in members], names, multi_line)
        self.kinds = {(_uri_key(r["_file"]), r["column_order"]): r["kind"] for r in csvfiles.column_kinds(self.raw, names).collect()}

    def kind(self, member, i: int) -> str:
        return self.kinds.get((member["key"], i), "string")


def load_csv_batch(tables: TableFolder, registry: DataFrame, base: str, batch: int, as_of: datetime, limit: int | None = None) -> dict[str, int]:
    """Load all pending CSV files (or the oldest ``limit``) and report what happened.

    One pass over the files finds headers and quoted line breaks.  Files of one
    target table with equal headers are read together with their own names, and
    columns meet in the table by name, whatever their order; a new column is
    added.  A value that does not fit the table's type leaves out its row.  Files
    that fail are marked with their error while the others go on.  Rows, columns
    and states are written once per batch, so a batch that runs again replaces
    its own.  The driver holds paths and headers, never rows.
    """
    spark = tables.spark
    chosen = csvfiles.pending_files(registry, limit).select("registry_id", "file_path", "file_name", paths.table_name(F.col("file_name")).alias("table"))
    members = [r.asDict() for r in chosen.collect()]
    errors: dict[str, str] = {}
    groups: dict[tuple, list[dict]] = {}
    for m in members:
        m["url"] = f"{base.rstrip('/')}/{m['file_path']}"
        m["key"] = _plain(m["url"])
    facts = {_uri_key(r["_file"]): r for r in _each(lambda ms: csvfiles.file_facts(spark, [m["url"] for m in ms]).collect(), members, errors)}
    for m in members:
        names = csvfiles.header_names(facts[m["key"]]["header"] or "") if m["key"] in facts else []
        if not names:
            errors.setdefault(m["registry_id"], "no columns found in file")
            continue
        groups.setdefault((m["table"], tuple(names), facts[m["key"]]["multi_line"]), []).append(m)
    read: dict[str, list[_CsvGroup]] = {}
    for (table, names, multi_line), of in groups.items():
        for group in _each(lambda ms: [_CsvGroup(spark, ms, list(names), multi_line)], of, errors):  # noqa: B023
            read.setdefault(table, []).append(group)
    master = meta = loaded = None

    def add(whole: DataFrame | None, part: DataFrame) -> DataFrame:
        return part if whole is None else whole.unionByName(part)

    for table, parts in read.items():
        schema = _table_schema(tables, table, batch, parts)
        typed = None
        for group in parts:
            own = {f.name.lower(): f for f in schema.fields}
            kinds = T.StructType([T.StructField(n, own[n.lower()].dataType) for n in group.names])
            good = csvfiles.accepted(csvfiles.typed_rows(group.raw, kinds))
            typed = add(typed, csvfiles.align(good.drop("_file", "_block", "_row_in_block"), schema))
            ids = spark.createDataFrame([(m["key"], m["registry_id"], m["file_path"], m["file_name"]) for m in group.members], "_key string, registry_id string, file_path string, file_name string")
            # A plus sign stands for itself in a path.
            keyed = good.withColumn("_key", F.url_decode(F.replace(F.regexp_replace("_file", "^([A-Za-z][A-Za-z0-9+.-]*:)?/*", ""), F.lit("+"), F.lit("%2B"))))
            sources = keyed.select("_file", "_key").distinct().join(ids, "_key").drop("_key")
            master = add(master, csvfiles.master_rows(good, sources, group.names, as_of))
            columns = [
                (f"{m['registry_id']}_COL_{i}", m["registry_id"], n, group.kind(m, i), i, True, as_of) for m in group.members for i, n in enumerate(group.names)
            ]
            meta = add(meta, conform(spark.createDataFrame(columns, COLUMN_ROWS), "csv_column_metadata"))
            loaded = add(loaded, spark.createDataFrame([(m["registry_id"], table) for m in group.members], "registry_id string, target_table_name string"))
        typed.write.mode("overwrite").parquet(f"{tables.root}/csv_tables/{table}/{BATCH}={batch}")
    started = [(m["registry_id"], "processing", None, as_of) for m in members]
    ended = _after(as_of)
    failed = [(i, "error", message[:1900], ended) for i, message in errors.items()]
    if not members:
        return {"processed": 0, "errors": 0}
    events = conform(spark.createDataFrame(started + failed, "registry_id string, processing_status string, error_message string, event_time timestamp"), "csv_events")
    if master is not None:
        tables.write("csv_data_master", master, batch)
        tables.write("csv_column_metadata", meta, batch)
        counts = tables.read("csv_data_master", only=batch).groupBy("registry_id").agg(F.count("*").alias("row_count"))
        done = loaded.join(csvfiles.schema_json(tables.read("csv_column_metadata", only=batch)), "registry_id").join(counts, "registry_id", "left")
        done = done.withColumns({"processing_status": F.lit("completed"), "row_count": F.coalesce("row_count", F.lit(0)), "event_time": F.lit(ended)})
        events = events.unionByName(conform(done, "csv_events"))
    tables.write("csv_events", events, batch)
    return {"processed": len(members) - len(errors), "errors": len(errors)}


COLUMN_ROWS = """metadata_id string, registry_id string, column_name string, column_type string, column_order bigint,
    nullable boolean, created_timestamp timestamp"""


def _each(work: Callable[[list[dict]], list], members: list[dict], errors: dict[str, str]) -> list:
    """``work`` on all files together; if that fails on halves, down to the files that are to blame."""
    if not members:
        return []
    try:
        return work(members)
    except Exception as problem:
        if len(members) == 1:
            errors[members[0]["registry_id"]] = str(problem)
            return []
        half = len(members) // 2
        return _each(work, members[:half], errors) + _each(work, members[half:], errors)


def _table_schema(tables: TableFolder, table: str, batch: int, parts: list[_CsvGroup]) -> T.StructType:
    """The columns that earlier batches gave the table, then new ones in the order of their files."""
    fields: dict[str, T.StructField] = {}
    try:
        stored = tables.spark.read.option("mergeSchema", True).parquet(f"{tables.root}/csv_tables/{table}")
        if not stored.filter(F.col(BATCH) < batch).isEmpty():
            before = tables.spark.read.option("mergeSchema", True).option("basePath", f"{tables.root}/csv_tables/{table}").parquet(
                *[f"{tables.root}/csv_tables/{table}/{BATCH}={r[0]}" for r in stored.filter(F.col(BATCH) < batch).select(BATCH).distinct().collect()]
            )
            fields = {f.name.lower(): f for f in before.schema.fields if f.name != BATCH}
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    new: dict[str, tuple[str, set[str]]] = {}
    for group in parts:
        for i, name in enumerate(group.names):
            if name.lower() not in fields:
                new.setdefault(name.lower(), (name, set()))[1].update(group.kind(m, i) for m in group.members)
    added = [T.StructField(name, T._parse_datatype_string(csvfiles.common_kind(kinds))) for name, kinds in new.values()]
    return T.StructType([*fields.values(), *added])
