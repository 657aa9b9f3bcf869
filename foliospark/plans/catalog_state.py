"""Upsert, status, review and registration queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import routing, state
from ..operators.search_index import Conflict
from ..schemas import empty
from ..sources.versioned import VersionedTable
from ..streaming import stuck
from .fixtures import Data
from .registry import query

AS_OF = datetime(2024, 3, 1)
CHANGES = """, changes AS (SELECT document_id, attribute_name, arg_max(attribute_value, event_id) AS attribute_value, CAST(max(confidence_score) AS DOUBLE) AS confidence_score
    FROM (SELECT concat('DOC_', user_id % 90 + 30) AS document_id, event_type AS attribute_name, concat('new ', event_id) AS attribute_value, CAST(event_id % 10 AS DOUBLE) / 10 AS confidence_score, event_id
          FROM events) c GROUP BY document_id, attribute_name)"""


def changes(d: Data):
    rows = d.events.select(
        F.concat(F.lit("DOC_"), F.col("user_id") % 90 + 30).alias("document_id"),
        F.col("event_type").alias("attribute_name"),
        F.concat(F.lit("new "), "event_id").alias("attribute_value"),
        (F.col("event_id") % 10 / 10).alias("confidence_score"),
        "event_id",
    )
    top = rows.groupBy("document_id", "attribute_name").agg(
        F.max_by("attribute_value", "event_id").alias("attribute_value"), F.max("confidence_score").alias("confidence_score")
    )
    return top


MERGED = CHANGES + """ SELECT coalesce(t.document_id, s.document_id) AS document_id, coalesce(t.attribute_name, s.attribute_name) AS attribute_name, t.file_name,
    CASE WHEN s.document_id IS NOT NULL THEN s.attribute_value ELSE t.attribute_value END AS attribute_value,
    CASE WHEN s.document_id IS NOT NULL THEN s.confidence_score ELSE t.confidence_score END AS confidence_score
    FROM extraction_state t FULL JOIN changes s ON t.document_id = s.document_id AND t.attribute_name = s.attribute_name"""


@query("m1_merge_extractions", MERGED, "extraction_state")
def _(d: Data):
    target = d.extraction_state.select("document_id", "attribute_name", "file_name", "attribute_value", "confidence_score")
    return state.merge_rows(target, changes(d), ["document_id", "attribute_name"], ["attribute_value", "confidence_score"])


STATE_COLUMNS = "document_id string, attribute_name string, file_name string, attribute_value string, confidence_score double"


@query(
    "m1_versioned_upsert",
    MERGED.replace(" SELECT coalesce", ", merged AS (SELECT coalesce", 1)
    + """) SELECT 1 AS version, true AS outdated_refused, document_id, attribute_name, file_name, attribute_value, confidence_score FROM extraction_state
       UNION ALL SELECT 2, true, document_id, attribute_name, file_name, attribute_value, confidence_score FROM merged""",
    "extraction_state",
)
def _(d: Data):
    """Two commits; a third that was computed from the first version is refused, and both versions stay readable."""
    table = VersionedTable(d.spark, d.folder("versions"), STATE_COLUMNS, ["document_id", "attribute_name"], buckets=16)
    values = ["attribute_value", "confidence_score"]
    first = table.merge(d.extraction_state.select("document_id", "attribute_name", "file_name", *values), values)
    table.merge(changes(d), values)
    try:
        table.merge(changes(d), values, base=first)
        refused = False
    except Conflict:
        refused = True
    both = [table.read(v).select(F.lit(v).alias("version"), F.lit(refused).alias("outdated_refused"), "*") for v in (1, 2)]
    return both[0].unionByName(both[1])


@query(
    "m1_repeated_keys",
    "SELECT document_id, attribute_name, count(*) AS row_count FROM extractions GROUP BY 1, 2 HAVING count(*) > 1",
    "extractions",
)
def _(d: Data):
    return state.repeated_keys(d.extractions, ["document_id", "attribute_name"])


@query("j14_keyed_upsert", MERGED, "extraction_state")
def _(d: Data):
    """The same change applied twice leaves the same table."""
    target = d.extraction_state.select("document_id", "attribute_name", "file_name", "attribute_value", "confidence_score")
    keys, values = ["document_id", "attribute_name"], ["attribute_value", "confidence_score"]
    once = d.stored(state.merge_rows(target, changes(d), keys, values), "merged")
    return state.merge_rows(once, changes(d), keys, values)


@query(
    "m2_mark_classified",
    """SELECT document_id, CASE WHEN status = 'parsed' AND length(trim(content_text)) > 0 AND doc_id IN (SELECT doc_id FROM labels) THEN CASE WHEN doc_id % 12 = 10 THEN 'classification_error' ELSE 'classified' END ELSE status END AS status FROM parsed""",
    "parsed",
)
def _(d: Data):
    done = d.classified.join(d.labels.select("doc_id"), "doc_id", "left_semi")
    return state.mark_classified(d.parsed, done).select("document_id", "status")


LATEST = """, latest AS (SELECT *, row_number() OVER (PARTITION BY registry_id ORDER BY event_time DESC, processing_status DESC, error_message DESC NULLS LAST) AS rn FROM status_events)"""


@query(
    "m4_csv_states",
    LATEST + """ SELECT r.registry_id, coalesce(e.processing_status, r.processing_status) AS processing_status, e.error_message
      FROM file_registry r LEFT JOIN latest e ON r.registry_id = e.registry_id AND e.rn = 1""",
    "file_registry status_events",
)
def _(d: Data):
    registry = d.file_registry.withColumn("error_message", F.lit(None).cast("string"))
    events = d.status_events.select("registry_id", "processing_status", "error_message", "event_time")
    rows = state.apply_status_events(registry, events, "registry_id", "processing_status")
    return rows.select("registry_id", "processing_status", "error_message")


@query(
    "m3_split_states",
    """SELECT r.registry_id, coalesce(e.split_status, r.split_status) AS split_status, coalesce(e.split_count, 0) AS split_count FROM large_registry r
       LEFT JOIN (SELECT registry_id, CASE WHEN page_count <= 200 AND original_file_size <= 94371840 THEN 'no_split_needed' WHEN page_count <= 200 THEN 'unsplittable' ELSE 'split_complete' END AS split_status,
                    CASE WHEN page_count > 200 THEN CAST(ceil(page_count / 200.0) AS BIGINT) ELSE 0 END AS split_count
                  FROM large_registry WHERE split_status IN ('pending', 'pending_split', 'pending_page_limit', 'requires_external_processing') AND split_required) e
       ON r.registry_id = e.registry_id""",
    "large_registry",
)
def _(d: Data):
    from ..operators import splitting

    registry = d.large_registry.withColumn("split_count", F.lit(0).cast("bigint"))
    planned = splitting.plan_splits(splitting.pending_splits(registry))
    events = planned.select("registry_id", "split_status", "split_count", F.lit(AS_OF).alias("event_time"))
    return state.apply_status_events(registry, events, "registry_id", "split_status").select("registry_id", "split_status", "split_count")


@query(
    "m5_conversion_states",
    LATEST + """ SELECT r.registry_id, CASE coalesce(e.processing_status, 'pending') WHEN 'processing' THEN 'converting' WHEN 'completed' THEN 'converted' ELSE coalesce(e.processing_status, 'pending') END AS conversion_status
      FROM file_registry r LEFT JOIN latest e ON r.registry_id = e.registry_id AND e.rn = 1""",
    "file_registry status_events",
)
def _(d: Data):
    registry = d.file_registry.withColumn("conversion_status", F.lit("pending"))
    kind = F.col("processing_status")
    # Named so that the order of states at equal times stays that of the source.
    latest = state.newest_per_key(d.status_events.select("registry_id", "event_time", "processing_status", "error_message"), ["registry_id"], ["event_time"])
    events = latest.select(
        "registry_id",
        "event_time",
        F.when(kind == "processing", "converting").when(kind == "completed", "converted").otherwise(kind).alias("conversion_status"),
    )
    return state.apply_status_events(registry, events, "registry_id", "conversion_status").select("registry_id", "conversion_status")


@query(
    "m3_legal_moves",
    """SELECT old_status, new_status, old_status = 'pending' AND new_status = 'processing' OR old_status = 'processing' AND new_status IN ('completed', 'error', 'pending') AS legal, count(*) AS moves
       FROM (SELECT r.processing_status AS old_status, e.processing_status AS new_status FROM file_registry r JOIN status_events e ON r.registry_id = e.registry_id) m GROUP BY 1, 2""",
    "file_registry status_events",
)
def _(d: Data):
    old = d.file_registry.select("registry_id", F.col("processing_status").alias("old_status"))
    new = d.status_events.select("registry_id", F.col("processing_status").alias("new_status"))
    moves = old.join(new, "registry_id").groupBy("old_status", "new_status").agg(F.count("*").alias("moves"))
    return moves.withColumn("legal", state.is_legal_move(F.col("old_status"), F.col("new_status"), state.CSV_MOVES))


@query(
    "m3_release_stuck",
    """SELECT registry_id, CASE WHEN processing_status = 'processing' AND created_timestamp < TIMESTAMP '2004-01-01 00:00:00' - INTERVAL 60 MINUTE THEN 'pending' ELSE processing_status END AS processing_status
       FROM file_registry""",
    "file_registry",
)
def _(d: Data):
    registry = d.file_registry.withColumn("processed_timestamp", F.col("created_timestamp"))
    return state.release_stuck(registry, "processing_status", "processing", datetime(2004, 1, 1)).select("registry_id", "processing_status")


@query(
    "m3_release_timers",
    """, newest AS (SELECT registry_id, max(event_time) AS seen, arg_max(processing_status, (event_time, processing_status)) AS processing_status FROM status_events GROUP BY registry_id)
       SELECT registry_id, 'pending' AS processing_status, seen + INTERVAL 60 MINUTE AS event_time FROM newest
       WHERE processing_status = 'processing' AND seen + INTERVAL 60 MINUTE <= (SELECT max(event_time) FROM status_events)""",
    "status_events",
)
def _(d: Data):
    """All status events as a stream; what runs on for an hour is released by its timer."""
    source, target = d.folder("events"), d.folder("releases")
    d.status_events.select("registry_id", "processing_status", F.col("event_time").cast("timestamp").alias("event_time")).write.parquet(source)
    events = d.spark.readStream.schema(d.spark.read.parquet(source).schema).parquet(source)
    found = stuck.releases(events, "registry_id", "processing_status", "processing")
    writer = found.writeStream.option("checkpointLocation", d.folder("releases_checkpoint")).trigger(availableNow=True).format("parquet").option("path", target)
    stuck.start_with_state(d.spark, writer.start).awaitTermination()
    return d.spark.read.schema(found.schema).parquet(target)


REVIEWS = """, reviews AS (SELECT concat('DOC_', user_id) AS document_id, event_type AS attribute_name, CASE WHEN max(event_id) % 3 = 0 THEN 'deny' ELSE 'approve' END AS action, concat('edited ', max(event_id)) AS edited_value
      FROM events WHERE value > 60 GROUP BY 1, 2)"""


@query(
    "m6_apply_reviews",
    REVIEWS + """ SELECT e.document_id, e.attribute_name, CASE WHEN r.action = 'approve' THEN r.edited_value WHEN r.action = 'deny' THEN NULL ELSE e.attribute_value END AS attribute_value,
      CASE WHEN r.action = 'approve' THEN 1.0 WHEN r.action = 'deny' THEN 0.0 ELSE e.confidence_score END AS confidence_score
      FROM extraction_state e LEFT JOIN reviews r ON e.document_id = r.document_id AND e.attribute_name = r.attribute_name""",
    "extraction_state",
)
def _(d: Data):
    last = F.max("event_id")
    reviews = d.events.filter("value > 60").groupBy(F.concat(F.lit("DOC_"), "user_id").alias("document_id"), F.col("event_type").alias("attribute_name")).agg(
        F.when(last % 3 == 0, "deny").otherwise("approve").alias("action"), F.concat(F.lit("edited "), last.cast("string")).alias("edited_value")
    )
    rows = state.apply_reviews(d.extraction_state, reviews)
    return rows.select("document_id", "attribute_name", "attribute_value", "confidence_score")


@query(
    "m7_review_low_scores",
    """SELECT event_id, CASE WHEN confidence_score < 0.5 THEN NULL ELSE attribute_value END AS attribute_value, CASE WHEN confidence_score < 0.5 THEN 0.0 ELSE confidence_score END AS denied,
         CASE WHEN confidence_score < 0.5 AND document_id = 'DOC_7' THEN 1.0 ELSE confidence_score END AS approved FROM extractions""",
    "extractions",
)
def _(d: Data):
    kept = d.extractions.withColumn("_score", F.col("confidence_score"))
    first = state.review_low_scores(kept, F.col("document_id") == "DOC_7", 0.5, "approve").withColumn("approved", F.col("confidence_score"))
    second = state.review_low_scores(first.withColumn("confidence_score", F.col("_score")), F.lit(True), 0.5, "deny")
    return second.select("event_id", "attribute_value", F.col("confidence_score").alias("denied"), "approved")


def _listing(d: Data):
    """The listing with every labelled file a second time, as after a repeated event."""
    again = d.staged.join(d.labels.select("doc_id"), "doc_id", "left_semi")
    return d.staged.unionByName(again)


def _known(d: Data, column: str):
    return d.staged.filter("lang = 'de'").select(F.col("relative_path").alias(column))


@query(
    "m8_register_large",
    r"""SELECT concat('REG_', md5(relative_path), '_2024-03-01_000000') AS registry_id, relative_path AS original_file_path, size AS original_file_size, 'pending' AS split_status
        FROM staged WHERE size > 104857600 AND regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX)$') AND lang <> 'de'""",
    "staged",
)
def _(d: Data):
    routed = routing.route_files(_listing(d))
    rows = routing.register_large(routed, _known(d, "original_file_path"), empty(d.spark, "parsed_documents"), AS_OF)
    return rows.select("registry_id", "original_file_path", "original_file_size", "split_status")


@query(
    "m8_register_spreadsheets",
    r"""SELECT relative_path AS original_file_path, regexp_extract(relative_path, '[^/]+$') AS original_file_name, 'pending' AS conversion_status
        FROM staged WHERE regexp_matches(upper(relative_path), '\.XLS[XM]$') AND relative_path NOT LIKE 'converted_excel/%' AND lang <> 'de'""",
    "staged",
)
def _(d: Data):
    rows = routing.register_spreadsheets(routing.route_files(_listing(d)), _known(d, "original_file_path"), AS_OF)
    return rows.select("original_file_path", "original_file_name", "conversion_status")


@query(
    "m9_register_from_listing",
    """SELECT relative_path AS file_path, size AS file_size, 'pending' AS processing_status FROM staged WHERE upper(relative_path) LIKE '%.CSV' AND lang <> 'de'""",
    "staged",
)
def _(d: Data):
    rows = routing.register_csv(routing.route_files(_listing(d)), _known(d, "file_path"), AS_OF)
    return rows.select("file_path", "file_size", "processing_status")


@query(
    "m10_register_page_limit",
    """SELECT file_path AS original_file_path, file_size AS original_file_size, 'pending_page_limit' AS split_status FROM parsed
       WHERE error_information LIKE '%pages exceeded%' AND lang <> 'de'""",
    "parsed",
)
def _(d: Data):
    rows = routing.register_page_limit(d.parsed, _known(d, "original_file_path"), AS_OF)
    return rows.select("original_file_path", "original_file_size", "split_status")


@query(
    "m11_error_isolation",
    """SELECT doc_id, CASE WHEN n_chars > 3000 THEN NULL ELSE CAST(n_chars * 2 AS VARCHAR) END AS result, CASE WHEN n_chars > 3000 THEN concat('text of ', n_chars, ' characters') END AS error FROM documents""",
)
def _(d: Data):
    from ..operators.provider import apply_provider

    def parse(texts):
        long = texts[texts.str.len() > 3000]
        if len(long):
            raise ValueError(f"text of {len(long.iloc[0])} characters")
        return (texts.str.len() * 2).astype(str)

    return apply_provider(d.documents.select("doc_id", "text"), "text", parse).select("doc_id", "result", "error")


@query(
    "m12_run_summary",
    r"""SELECT count(*) AS stream_count, count(*) FILTER (r = 'parse') AS processed_count, count(*) FILTER (r = 'large') AS large_count,
          count(*) FILTER (r = 'parse' AND n_chars > 5000) AS failed_parse_count, count(*) FILTER (r = 'sheet') AS spreadsheet_count, count(*) FILTER (r = 'csv') AS csv_count,
          count(*) FILTER (r = 'none') AS rejected_count
        FROM (SELECT n_chars, CASE WHEN size > 104857600 AND regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX)$') THEN 'large'
            WHEN size <= 104857600 AND regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX|JPE?G|PNG|TIFF?|HTML|TXT)$') THEN 'parse'
            WHEN regexp_matches(upper(relative_path), '\.XLS[XM]$') AND relative_path NOT LIKE 'converted_excel/%' THEN 'sheet' WHEN upper(relative_path) LIKE '%.CSV' THEN 'csv' ELSE 'none' END AS r FROM staged) x""",
    "staged",
)
def _(d: Data):
    failed = F.when(F.col("n_chars") > 5000, "Maximum number of 500 pages exceeded")
    return state.run_summary(routing.route_files(d.staged).withColumn("error_information", failed))


@query(
    "m9_rejected_files",
    r"""SELECT relative_path AS file_path, CASE WHEN regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX|JPE?G|PNG|TIFF?|HTML|TXT)$') THEN 'too large for its type'
          WHEN regexp_matches(upper(relative_path), '\.XLS[XM]$') THEN 'already converted' ELSE 'unsupported type' END AS reason FROM staged
        WHERE NOT (size > 104857600 AND regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX)$'))
          AND NOT (size <= 104857600 AND regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX|JPE?G|PNG|TIFF?|HTML|TXT)$'))
          AND NOT (regexp_matches(upper(relative_path), '\.XLS[XM]$') AND relative_path NOT LIKE 'converted_excel/%') AND upper(relative_path) NOT LIKE '%.CSV'""",
    "staged",
)
def _(d: Data):
    return routing.rejected_files(routing.route_files(d.staged)).select("file_path", "reason")
