"""Report queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..operators import sheets
from . import costs, evaluation, reports
from .catalog_documents import CHUNKS, chunk_table
from .catalog_relational import CLASS_LABEL, FLAT, FLAT_STRICT, FLOW_TASK, IN_PERIOD, LABEL, PERIOD
from .fixtures import Data
from .registry import query

AS_OF = datetime(2024, 3, 1)


def _summary_sql(flat: str) -> str:
    return f""", flat AS ({flat}) SELECT c.document_id, c.file_name, c.document_type, {LABEL.format("c.document_class")} AS document_classification, f.attribute_name, f.attribute_value, f.confidence_score
        FROM classified c LEFT JOIN flat f ON c.document_id = f.document_id"""


SUMMARY_COLUMNS = ("document_id", "file_name", "document_type", "document_classification", "attribute_name", "attribute_value", "confidence_score")


@query("v1_processing_summary", _summary_sql(FLAT), "classified extractions")
def _(d: Data):
    return reports.processing_summary(d.classified, d.extractions).select(*SUMMARY_COLUMNS)


@query("v1_processing_summary_strict", _summary_sql(FLAT_STRICT), "classified extractions")
def _(d: Data):
    return reports.processing_summary(d.classified, d.extractions, strict=True).select(*SUMMARY_COLUMNS)


@query(
    "v2_large_document_status",
    """SELECT r.registry_id, round(r.original_file_size / 1048576.0, 2) AS size_mb, r.split_status, count(p.part_id) AS parts_created, count(*) FILTER (p.status = 'processed') AS parts_processed
       FROM large_registry r LEFT JOIN split_parts p ON r.registry_id = p.registry_id GROUP BY r.registry_id, r.original_file_size, r.split_status""",
    "large_registry split_parts",
)
def _(d: Data):
    missing = {c: F.lit(None).cast("string") for c in ("estimated_pages", "split_count", "processed_timestamp")}
    rows = reports.large_document_status(d.large_registry.withColumns(missing), d.split_parts)
    return rows.select("registry_id", "size_mb", "split_status", "parts_created", "parts_processed")


STAGES = f"""SELECT 'Stream' AS stage, count(*) AS count, CAST(NULL AS VARCHAR) AS status FROM staged
  UNION ALL SELECT 'Parsed Documents', count(*), status FROM parsed GROUP BY status
  UNION ALL SELECT 'Classifications', count(*), {CLASS_LABEL} FROM classified GROUP BY 3
  UNION ALL SELECT 'Extractions', count(DISTINCT document_id), 'extracted' FROM extractions
  UNION ALL SELECT 'Chunks', count(*), 'chunked' FROM chunks
  UNION ALL SELECT 'Large Documents', count(*), split_status FROM large_registry GROUP BY split_status
  UNION ALL SELECT 'CSV Files', count(*), processing_status FROM file_registry GROUP BY processing_status
  UNION ALL SELECT 'Excel Conversions', count(*), split_status FROM large_registry WHERE split_required GROUP BY split_status"""


@query("v3_stage_status", CHUNKS + STAGES, "classified extractions large_registry file_registry parsed")
def _(d: Data):
    large = d.large_registry
    return reports.stage_status(
        d.staged, d.parsed, d.classified, d.extractions, chunk_table(d), large, d.file_registry,
        large.filter("split_required").withColumnRenamed("split_status", "conversion_status"),
    )


@query("u1_union_of_counts", CHUNKS + STAGES + " ORDER BY stage, status", "classified extractions large_registry file_registry parsed")
def _(d: Data):
    large = d.large_registry
    rows = reports.stage_status(
        d.staged, d.parsed, d.classified, d.extractions, chunk_table(d), large, d.file_registry,
        large.filter("split_required").withColumnRenamed("split_status", "conversion_status"),
    )
    return rows.orderBy("stage", "status")


@query(
    "v4_merged_documents_strict",
    """SELECT original_file_path, registry_id, count(*) AS total_parts, string_agg(json_extract_string(parsed_content, '$.content'), ' ' ORDER BY part_number, parsed_content) AS merged_content
       FROM split_parts WHERE parsed_content NOT ILIKE '%errorInformation%' GROUP BY original_file_path, registry_id""",
    "split_parts",
)
def _(d: Data):
    from ..operators.splitting import merged_documents

    parts = d.split_parts
    stored = parts.select(F.col("part_stage_path").alias("file_path"), "parsed_content")
    return merged_documents(parts.drop("parsed_content"), stored, strict=True)


@query(
    "v4_ordered_parts_strict",
    """SELECT original_file_path, registry_id, part_number, json_extract_string(parsed_content, '$.content') AS part_text,
         count(*) OVER (PARTITION BY original_file_path, registry_id) AS total_parts
       FROM split_parts WHERE parsed_content NOT ILIKE '%errorInformation%'""",
    "split_parts",
)
def _(d: Data):
    from ..operators.splitting import merged_parts

    parts = d.split_parts
    stored = parts.select(F.col("part_stage_path").alias("file_path"), "parsed_content")
    return merged_parts(parts.drop("parsed_content"), stored, strict=True)


@query(
    "v5_csv_status",
    "SELECT registry_id, file_name, round(file_size / 1024.0, 2) AS size_kb, processing_status, created_timestamp FROM file_registry",
    "file_registry",
)
def _(d: Data):
    missing = {c: F.lit(None).cast("string") for c in ("target_table_name", "column_count", "row_count", "error_message", "processed_timestamp", "inferred_schema")}
    rows = reports.csv_status(d.file_registry.withColumns(missing))
    return rows.select("registry_id", "file_name", "size_kb", "processing_status", "created_timestamp")


@query(
    "v6_csv_schema_details",
    """SELECT r.file_name, upper(r.file_name) AS target_table_name, concat('col_', l.l_linenumber) AS column_name, 'int' AS column_type, CAST(l.l_linenumber AS BIGINT) AS column_order, true AS nullable, r.processing_status
       FROM file_registry r JOIN lineitem l ON r.o_orderkey = l.l_orderkey""",
    "file_registry",
)
def _(d: Data):
    columns = d.lineitem.select(
        F.concat(F.lit("FILE_"), "l_orderkey").alias("registry_id"), F.concat(F.lit("col_"), "l_linenumber").alias("column_name"),
        F.lit("int").alias("column_type"), F.col("l_linenumber").cast("bigint").alias("column_order"), F.lit(True).alias("nullable"),
    )
    return reports.csv_schema_details(d.file_registry.withColumn("target_table_name", F.upper("file_name")), columns)


@query(
    "v8_conversion_status",
    """SELECT r.registry_id, round(r.original_file_size / 1048576.0, 2) AS size_mb, count(s.sheet_index) AS sheets_recorded
       FROM (SELECT concat('XL_', doc_id) AS registry_id, n_chars * 20000 AS original_file_size FROM documents) r LEFT JOIN sheets s ON r.registry_id = s.registry_id GROUP BY ALL""",
    "sheets",
)
def _(d: Data):
    registry = d.documents.select(F.concat(F.lit("XL_"), "doc_id").alias("registry_id"), (F.col("n_chars") * 20000).alias("original_file_size"))
    missing = ("original_file_path", "original_file_name", "sheet_count", "conversion_status", "converted_pdf_path", "error_message", "created_timestamp", "processed_timestamp")
    registry = registry.withColumns({c: F.lit(None).cast("string") for c in missing})
    metadata = sheets.sheet_metadata(d.sheets, d.cells, AS_OF)
    return reports.conversion_status(registry, metadata).select("registry_id", "size_mb", "sheets_recorded")


STATS = """, st AS (SELECT count(*) AS total_documents, count(*) FILTER (status = 'parsed') AS parsed_count, count(*) FILTER (status = 'classified') AS classified_count,
    count(*) FILTER (status = 'classification_error') AS error_count FROM (SELECT CASE WHEN status = 'parsed' AND doc_id % 3 <> 1 THEN 'classified' ELSE status END AS status FROM parsed) p),
  ex AS (SELECT count(DISTINCT document_id) AS extracted_count FROM extractions), ch AS (SELECT count(*) AS total_chunks, count(DISTINCT document_id) AS chunked_documents FROM chunks)"""


def stats(d: Data):
    status = F.when((F.col("status") == "parsed") & (F.col("doc_id") % 3 != 1), "classified").otherwise(F.col("status"))
    return reports.processing_stats(d.parsed.withColumn("status", status), d.extractions, chunk_table(d))


@query("v9_processing_stats", CHUNKS + STATS + " SELECT * FROM st, ex, ch", "parsed extractions")
def _(d: Data):
    return stats(d)


@query(
    "v9_status_bars",
    CHUNKS + STATS + """ SELECT 'Parsed' AS status, parsed_count AS count FROM st UNION ALL SELECT 'Classified', classified_count FROM st UNION ALL SELECT 'Extracted', extracted_count FROM ex
      UNION ALL SELECT 'Chunked', chunked_documents FROM ch UNION ALL SELECT 'Errors', error_count FROM st""",
    "parsed extractions",
)
def _(d: Data):
    return reports.status_bars(stats(d))


@query(
    "v9_class_breakdown",
    f"""SELECT {CLASS_LABEL} AS document_class, count(*) AS count FROM classified WHERE document_class NOT LIKE 'ERR_%' AND document_class <> 'classification_error' GROUP BY 1""",
    "classified",
)
def _(d: Data):
    return reports.class_counts(d.classified)


@query(
    "v10_document_info",
    """SELECT c.document_id, c.file_name, c.file_path, c.file_size, c.document_type, c.document_class, p.content_text, p.status FROM classified c JOIN parsed p ON c.document_id = p.document_id
       WHERE c.document_id = 'DOC_12'""",
    "classified",
)
def _(d: Data):
    return reports.document_info(d.classified, d.parsed, "DOC_12").drop("classification_timestamp")


@query(
    "v10_document_attributes",
    """SELECT attribute_name, attribute_value, confidence_score, coalesce(confidence_score < 0.5, false) AS is_low FROM extractions WHERE document_id = 'DOC_12'""",
    "extractions",
)
def _(d: Data):
    return reports.document_attributes(d.extractions, "DOC_12").drop("band", "extraction_timestamp")


@query("v10_document_chunks", CHUNKS + " SELECT chunk_index, chunk_text, length(chunk_text) AS chunk_size FROM chunks WHERE document_id = 'DOC_12' ORDER BY chunk_index LIMIT 3", "parsed")
def _(d: Data):
    return reports.document_chunks(chunk_table(d), "DOC_12", 3)


@query(
    "v11_timeline",
    """SELECT CAST(classification_timestamp AS DATE) AS process_date, count(*) AS documents_processed FROM classified WHERE classification_timestamp >= DATE '2024-01-31' GROUP BY 1""",
    "classified",
)
def _(d: Data):
    return reports.timeline(d.classified, date(2024, 3, 1))


@query(
    "v11_success_rates",
    CHUNKS + STATS + " SELECT classified_count AS success, error_count AS errors, total_documents - classified_count - error_count AS pending, round(100.0 * classified_count / total_documents, 2) AS success_rate, round(100.0 * error_count / total_documents, 2) AS error_rate FROM st",
    "parsed",
)
def _(d: Data):
    return reports.success_rates(stats(d))


@query("v11_attribute_counts", f", flat AS ({FLAT}) SELECT f.attribute_name, count(*) AS count FROM classified c JOIN flat f ON c.document_id = f.document_id GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", "classified extractions")
def _(d: Data):
    return reports.attribute_counts(reports.processing_summary(d.classified, d.extractions))


@query("v11_summary_metrics", f", flat AS ({FLAT}), s AS (SELECT c.document_id, {LABEL.format('c.document_class')} AS l, f.attribute_name FROM classified c LEFT JOIN flat f ON c.document_id = f.document_id)"
       " SELECT count(DISTINCT document_id) AS total_documents, count(DISTINCT l) AS unique_classifications, count(DISTINCT attribute_name) AS unique_attributes, count(*) AS total_rows FROM s", "classified extractions")
def _(d: Data):
    return reports.summary_metrics(reports.processing_summary(d.classified, d.extractions))


@query(
    "v11_summary_page",
    f", flat AS ({FLAT}) SELECT c.document_id, f.attribute_name, f.attribute_value FROM classified c LEFT JOIN flat f ON c.document_id = f.document_id ORDER BY 1, 2 NULLS FIRST, 3 NULLS FIRST, f.confidence_score NULLS FIRST LIMIT 500",
    "classified extractions",
)
def _(d: Data):
    return reports.summary_page(reports.processing_summary(d.classified, d.extractions)).select("document_id", "attribute_name", "attribute_value")


# --- cost -------------------------------------------------------------------


@query(
    "v12_cost_totals",
    f"""SELECT round(t, 4) AS serverless_credits, round(a, 4) AS ai_services_credits, round(t + a, 4) AS total_credits FROM (
        SELECT coalesce(sum(credits_used) FILTER (service_type = 'SERVERLESS_TASK' AND {FLOW_TASK}), 0) AS t, coalesce(sum(credits_used) FILTER (service_type = 'AI_SERVICES'), 0) AS a
        FROM metering WHERE {IN_PERIOD}) x""",
    "metering",
)
def _(d: Data):
    return costs.totals(d.metering, *PERIOD)


@query(
    "v12_task_totals",
    f"SELECT round(sum(credits_used), 4) AS total_task_credits, count(DISTINCT name) AS unique_tasks FROM metering WHERE service_type = 'SERVERLESS_TASK' AND {IN_PERIOD} AND {FLOW_TASK}",
    "metering",
)
def _(d: Data):
    return costs.task_totals(d.metering, *PERIOD)


@query(
    "v12_function_days",
    f"""SELECT function_name, CAST(start_time AS DATE) AS usage_date, round(sum(token_credits), 4) AS token_credits, count(*) AS call_count FROM function_usage
        WHERE {IN_PERIOD} AND function_name <> 'COMPLETE' GROUP BY 1, 2""",
    "function_usage",
)
def _(d: Data):
    return costs.function_days(d.function_usage, *PERIOD)


@query(
    "v12_search_days",
    """SELECT service_name, usage_date, CAST(sum(tokens) AS BIGINT) AS total_tokens, round(sum(credits), 4) AS total_credits FROM search_usage
       WHERE usage_date BETWEEN DATE '2024-01-05' AND DATE '2024-02-20' AND service_name ILIKE '%document_search_service%' GROUP BY 1, 2""",
    "search_usage",
)
def _(d: Data):
    return costs.search_days(d.search_usage, *PERIOD)


@query(
    "v12_search_totals",
    """SELECT CAST(sum(tokens) AS BIGINT) AS total_tokens, round(sum(credits), 4) AS total_credits, count(DISTINCT service_name) AS unique_services FROM search_usage
       WHERE usage_date BETWEEN DATE '2024-01-05' AND DATE '2024-02-20' AND service_name ILIKE '%document_search_service%'""",
    "search_usage",
)
def _(d: Data):
    return costs.search_totals(d.search_usage, *PERIOD)


@query(
    "v12_task_trend",
    f"SELECT CAST(start_time AS DATE) AS usage_date, round(sum(credits_used), 4) AS total_credits FROM metering WHERE service_type = 'SERVERLESS_TASK' AND {IN_PERIOD} AND {FLOW_TASK} GROUP BY 1",
    "metering",
)
def _(d: Data):
    return costs.task_trend(d.metering, *PERIOD)


@query("v12_ai_trend", f"SELECT CAST(start_time AS DATE) AS usage_date, round(sum(credits_used), 4) AS total_credits FROM metering WHERE service_type = 'AI_SERVICES' AND {IN_PERIOD} GROUP BY 1", "metering")
def _(d: Data):
    return costs.ai_trend(d.metering, *PERIOD)


@query(
    "v12_combined_trend",
    f"""SELECT CAST(start_time AS DATE) AS usage_date, service_type, round(sum(credits_used), 4) AS total_credits FROM metering
        WHERE {IN_PERIOD} AND (service_type = 'AI_SERVICES' OR service_type = 'SERVERLESS_TASK' AND {FLOW_TASK}) GROUP BY 1, 2""",
    "metering",
)
def _(d: Data):
    return costs.combined_trend(d.metering, *PERIOD)


# --- evaluation -------------------------------------------------------------

OF_SOURCE = "app_name = 'OCR_EVL' AND source_table = 'parsed_documents'"


def own_results(d: Data):
    return evaluation.of_source(d.eval_scores, "OCR_EVL", "parsed_documents")


@query("v13_result_rows", f"SELECT document_id, ocr_accuracy_score, ocr_completeness_score, substring(ocr_text, 1, 50) AS text_preview, evaluation_timestamp, run_name FROM eval_scores WHERE {OF_SOURCE}", "eval_scores")
def _(d: Data):
    return evaluation.result_rows(own_results(d))


@query(
    "v13_run_statistics",
    f"""SELECT app_name, run_name, count(*) AS total_documents, round(avg(ocr_accuracy_score), 3) AS avg_accuracy, round(stddev(ocr_completeness_score), 3) AS std_completeness,
          max(evaluation_timestamp) AS evaluated_at FROM eval_scores WHERE {OF_SOURCE} GROUP BY 1, 2""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.run_statistics(own_results(d)).select("app_name", "run_name", "total_documents", "avg_accuracy", "std_completeness", "evaluated_at")


@query(
    "v13_reasoning_rows",
    f"""SELECT document_id, substring(ocr_text, 1, 50) AS text_preview, ocr_accuracy_score, ocr_accuracy_reasoning, ocr_completeness_score, ocr_completeness_reasoning, run_name FROM eval_scores WHERE {OF_SOURCE}""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.reasoning_rows(own_results(d))


@query(
    "v13_low_scores",
    f"""SELECT document_id, ocr_accuracy_score, ocr_completeness_score, ocr_accuracy_reasoning, substring(ocr_text, 1, 100) AS text_preview FROM eval_scores
        WHERE {OF_SOURCE} AND (ocr_accuracy_score < 0.95 OR ocr_completeness_score < 0.95)""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.low_scores(own_results(d))


@query(
    "v14_filtered_rows",
    "SELECT document_id, ocr_accuracy_score, ocr_completeness_score, run_name FROM eval_scores WHERE run_name = 'run_src3' AND ocr_accuracy_score >= 0.7 AND ocr_completeness_score >= 0.7",
    "eval_scores",
)
def _(d: Data):
    return evaluation.scatter_points(d.eval_scores.filter(evaluation.chosen("run_src3", 0.7, 0.7)))


@query("v14_scatter_points", "SELECT document_id, ocr_accuracy_score, ocr_completeness_score, run_name FROM eval_scores", "eval_scores")
def _(d: Data):
    return evaluation.scatter_points(d.eval_scores.filter(evaluation.chosen()))


@query(
    "v14_dashboard_cards",
    """SELECT *, CASE WHEN avg_accuracy >= 0.97 THEN 'Excellent' WHEN avg_accuracy >= 0.9 THEN 'Good' ELSE 'Needs Review' END AS accuracy_verdict,
         CASE WHEN avg_completeness >= 0.97 THEN 'Excellent' WHEN avg_completeness >= 0.9 THEN 'Good' ELSE 'Needs Review' END AS completeness_verdict, round(100.0 * low_count / total_documents, 1) AS low_share
       FROM (SELECT count(*) AS total_documents, round(avg(ocr_accuracy_score), 4) AS avg_accuracy, round(avg(ocr_completeness_score), 4) AS avg_completeness,
               count(*) FILTER (ocr_accuracy_score < 0.95 OR ocr_completeness_score < 0.95) AS low_count FROM eval_scores) x""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.dashboard_cards(d.eval_scores)


@query(
    "v14_run_comparison",
    """SELECT run_name, round(avg(ocr_accuracy_score), 3) AS avg_accuracy, round(min(ocr_accuracy_score), 3) AS min_accuracy, round(max(ocr_accuracy_score), 3) AS max_accuracy, round(stddev(ocr_accuracy_score), 3) AS std_accuracy,
         round(avg(ocr_completeness_score), 3) AS avg_completeness, round(min(ocr_completeness_score), 3) AS min_completeness, round(max(ocr_completeness_score), 3) AS max_completeness,
         round(stddev(ocr_completeness_score), 3) AS std_completeness, count(document_id) AS doc_count FROM eval_scores GROUP BY run_name""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.run_comparison(d.eval_scores)


@query(
    "v15_source_audit",
    """SELECT count(*) AS total_rows, count(*) FILTER (document_id IS NULL) AS null_document_ids, count(*) FILTER (t IS NULL) AS null_texts, count(*) FILTER (t = '') AS empty_texts
       FROM (SELECT document_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN '' ELSE content_text END AS t FROM parsed) p""",
    "parsed",
)
def _(d: Data):
    n = F.col("doc_id") % 7
    body = F.when(n == 1, "").when(n != 0, F.col("content_text"))
    return evaluation.source_audit(d.parsed.withColumn("content_text", body), "content_text")


@query("v15_source_preview", "SELECT document_id, substring(content_text, 1, 100) AS text_preview, length(content_text) AS text_length FROM parsed", "parsed")
def _(d: Data):
    return evaluation.source_preview(d.parsed, "content_text")


@query(
    "v16_error_free_parts",
    "SELECT original_file_path, parsed_content FROM split_parts WHERE json_extract_string(parsed_content, '$.errorInformation') IS NULL",
    "split_parts",
)
def _(d: Data):
    parts = d.split_parts
    stored = parts.select(F.col("part_stage_path").alias("file_path"), "parsed_content")
    return reports.error_free_parts(parts.drop("parsed_content"), stored)


@query("v16_linked_parts", "SELECT part_stage_path AS file_path, registry_id AS parent_registry_id, part_number FROM split_parts", "split_parts")
def _(d: Data):
    from ..operators.splitting import link_parts

    parts = d.split_parts
    parsed = parts.select(F.col("part_stage_path").alias("file_path"), F.lit(None).cast("string").alias("parent_registry_id"), F.lit(None).cast("bigint").alias("part_number"))
    return link_parts(parsed, parts)
