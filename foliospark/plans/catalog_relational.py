"""Join, aggregation, window, limit and set queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from .. import seeds
from ..functions import jsontext
from ..operators import extract, judge, routing, splitting, state
from ..schemas import extraction_prompts
from ..sources import csvfiles
from . import costs, evaluation, reports
from .fixtures import Data
from .registry import query


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PROMPTS = (
    "(SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join(_literal(c) for c in row) + ")" for row in seeds.QUESTIONS)
    + ") AS v(document_class, attribute_name, question_text))"
)
LABEL = "CASE WHEN json_valid({0}) THEN json_extract_string({0}, '$.labels[0]') ELSE {0} END"
KEY = "lower(replace(replace(trim({0}), ' ', '_'), '-', '_'))"
CLASS_LABEL = LABEL.format("document_class")
CLASS_KEY = KEY.format(LABEL.format("c.document_class"))

# --- joins ------------------------------------------------------------------


@query(
    "j1_classified_parsed",
    "SELECT c.document_id, c.document_class, length(p.content_text) AS n FROM classified c JOIN parsed p ON c.document_id = p.document_id",
    "classified",
)
def _(d: Data):
    texts = d.parsed.select("document_id", F.length("content_text").alias("n"))
    return d.classified.select("document_id", "document_class").join(texts, "document_id")


@query(
    "j2_class_questions",
    f"""SELECT c.document_id, p.attribute_name, p.question_text FROM classified c JOIN {PROMPTS} p
        ON {KEY.format("p.document_class")} = {CLASS_KEY}""",
    "classified",
)
def _(d: Data):
    asked = extract.with_questions(d.classified.select("document_id", "document_class"), extraction_prompts(d.spark))
    return asked.select("document_id", F.explode("questions").alias("attribute_name", "question_text"))


@query(
    "j3_class_or_default",
    f"""SELECT p.document_id, coalesce({LABEL.format("c.document_class")}, 'unclassified') AS document_class
        FROM parsed p LEFT JOIN (SELECT * FROM classified WHERE doc_id IN (SELECT doc_id FROM labels)) c ON p.document_id = c.document_id""",
    "classified",
)
def _(d: Data):
    classes = d.classified.join(d.labels.select("doc_id"), "doc_id", "left_semi").select(
        "document_id", jsontext.unwrap_label(F.col("document_class")).alias("document_class")
    )
    joined = d.parsed.select("document_id").join(classes, "document_id", "left")
    return joined.withColumn("document_class", F.coalesce("document_class", F.lit("unclassified")))


@query(
    "j4_without_extraction",
    """SELECT count(*) AS documents, count(*) FILTER (length(p.content_text) > 1000) AS long_documents FROM parsed p
       LEFT JOIN (SELECT DISTINCT document_id FROM extractions) e ON p.document_id = e.document_id WHERE e.document_id IS NULL""",
    "parsed extractions",
)
def _(d: Data):
    narrow = d.parsed.select("document_id", (F.length("content_text") > 1000).alias("long"))
    alone = routing.not_in(narrow, "document_id", d.extractions, "document_id")
    return alone.agg(F.count("*").alias("documents"), F.count_if("long").alias("long_documents"))


@query(
    "j5_not_in_registry",
    """SELECT relative_path FROM staged WHERE relative_path NOT IN (SELECT file_path FROM parsed WHERE file_path IS NOT NULL AND status = 'parsed')""",
    "staged parsed",
)
def _(d: Data):
    known = d.parsed.select(F.when(F.col("status") == "parsed", F.col("file_path")).alias("file_path"))
    return routing.not_in(d.staged, "relative_path", known, "file_path").select("relative_path")


@query(
    "j6_semi_join",
    "SELECT document_id, status FROM parsed WHERE document_id IN (SELECT document_id FROM extractions)",
    "parsed extractions",
)
def _(d: Data):
    return d.parsed.select("document_id", "status").join(d.extractions.select("document_id"), "document_id", "left_semi")


@query(
    "j7_load_once",
    """SELECT concat('FILE_', l_orderkey) AS registry_id, l_partkey FROM lineitem l
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')""",
)
def _(d: Data):
    incoming = d.lineitem.select(F.concat(F.lit("FILE_"), "l_orderkey").alias("registry_id"), "l_partkey")
    loaded = d.orders.filter("o_orderstatus = 'F'").select(F.concat(F.lit("FILE_"), "o_orderkey").alias("registry_id"))
    return csvfiles.load_master(loaded, incoming)


@query(
    "j8_registry_parts",
    """SELECT r.registry_id, count(p.part_id) AS parts_created, CAST(coalesce(sum(CASE WHEN p.status = 'processed' THEN 1 ELSE 0 END), 0) AS BIGINT) AS parts_processed
       FROM (SELECT concat('REG_', o_orderkey) AS registry_id FROM orders) r LEFT JOIN split_parts p ON r.registry_id = p.registry_id GROUP BY r.registry_id""",
    "split_parts",
)
def _(d: Data):
    counted = d.split_parts.groupBy("registry_id").agg(
        F.count("part_id").alias("parts_created"), F.count_if(F.col("status") == "processed").alias("parts_processed")
    )
    registry = d.orders.select(F.concat(F.lit("REG_"), "o_orderkey").alias("registry_id"))
    return registry.join(counted, "registry_id", "left").fillna(0, ["parts_created", "parts_processed"])


@query(
    "j9_schema_columns",
    """SELECT r.file_name, l.l_linenumber AS column_order, concat('col_', l.l_partkey) AS column_name, r.processing_status
       FROM file_registry r JOIN lineitem l ON r.o_orderkey = l.l_orderkey""",
    "file_registry",
)
def _(d: Data):
    columns = d.lineitem.select(
        F.concat(F.lit("FILE_"), "l_orderkey").alias("registry_id"),
        F.col("l_linenumber").alias("column_order"),
        F.concat(F.lit("col_"), "l_partkey").alias("column_name"),
        F.lit("string").alias("column_type"),
        F.lit(True).alias("nullable"),
    )
    registry = d.file_registry.withColumn("target_table_name", F.lit(None).cast("string"))
    return reports.csv_schema_details(registry, columns).select("file_name", "column_order", "column_name", "processing_status")


@query(
    "j10_part_paths",
    """SELECT p.original_file_path, p.part_number, q.parsed_content FROM split_parts p JOIN split_parts q ON p.part_stage_path = q.part_stage_path""",
    "split_parts",
)
def _(d: Data):
    stored = d.split_parts.select("part_stage_path", "parsed_content")
    return d.split_parts.select("part_stage_path", "original_file_path", "part_number").join(stored, "part_stage_path").drop("part_stage_path")


@query(
    "j11_keep_documents",
    """SELECT c.document_id, e.attribute_name, e.event_id FROM classified c LEFT JOIN extractions e ON c.document_id = e.document_id""",
    "classified extractions",
)
def _(d: Data):
    own = d.extractions.select("document_id", "attribute_name", "event_id")
    return reports.keep_all_left(d.classified.select("document_id"), own, "document_id")


@query(
    "j12_lateral_unnest",
    """SELECT p.doc_id, w.i AS chunk_index FROM parsed p, LATERAL (SELECT unnest(generate_series(0, greatest(0, CAST(ceil((length(p.content_text) - 1000) / 800.0) AS BIGINT)))) AS i) w""",
    "parsed",
)
def _(d: Data):
    from ..operators.chunking import window_count

    last = window_count(F.length("content_text")) - 1
    return d.parsed.select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).alias("chunk_index"))


@query(
    "j13_registry_with_parts",
    """SELECT r.registry_id, p.part_id, p.part_stage_path FROM (SELECT concat('REG_', o_orderkey) AS registry_id FROM orders) r
       LEFT JOIN split_parts p ON r.registry_id = p.registry_id""",
    "split_parts",
)
def _(d: Data):
    registry = d.orders.select(F.concat(F.lit("REG_"), "o_orderkey").alias("registry_id"))
    return reports.registry_with_parts(registry, d.split_parts).select("registry_id", "part_id", "part_stage_path")


# --- aggregates -------------------------------------------------------------


@query("a1_counts", "SELECT count(*) AS row_count, count(*) FILTER (document_class IS NULL) AS without_class FROM classified", "classified")
def _(d: Data):
    return d.classified.agg(F.count("*").alias("row_count"), F.count_if(F.col("document_class").isNull()).alias("without_class"))


@query("a2_distinct_documents", "SELECT count(DISTINCT document_id) AS documents, count(*) AS row_count FROM extractions", "extractions")
def _(d: Data):
    return d.extractions.agg(F.count_distinct("document_id").alias("documents"), F.count("*").alias("row_count"))


@query(
    "a3_conditional_counts",
    """SELECT count(*) AS total, count(CASE WHEN status = 'parsed' THEN 1 END) AS parsed_count, count(CASE WHEN status = 'parse_error' THEN 1 END) AS error_count,
         CAST(sum(CASE WHEN content_text = '' THEN 1 ELSE 0 END) AS BIGINT) AS empty_texts FROM parsed""",
    "parsed",
)
def _(d: Data):
    return d.parsed.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "parsed").alias("parsed_count"),
        F.count_if(F.col("status") == "parse_error").alias("error_count"),
        F.sum(F.when(F.col("content_text") == "", 1).otherwise(0)).alias("empty_texts"),
    )


@query("a4_count_by_column", "SELECT document_type, count(*) AS count FROM parsed GROUP BY document_type", "parsed")
def _(d: Data):
    return reports.count_by(d.parsed, "document_type")


@query("a5_count_by_label", f"SELECT {CLASS_LABEL} AS status, count(*) AS count FROM classified GROUP BY 1", "classified")
def _(d: Data):
    return reports.count_by(d.classified.select(jsontext.unwrap_label(F.col("document_class")).alias("status")), "status")


@query(
    "a6_top_attributes",
    """SELECT attribute_name, count(*) AS extraction_count, count(DISTINCT document_id) AS unique_documents FROM extractions
       GROUP BY attribute_name ORDER BY extraction_count DESC, attribute_name LIMIT 20""",
    "extractions",
)
def _(d: Data):
    return reports.top_attributes(d.extractions)


@query("a7_by_date", "SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1")
def _(d: Data):
    return d.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("events"))


@query(
    "a8_run_statistics",
    """SELECT app_name, run_name, count(*) AS total_documents, round(avg(ocr_accuracy_score), 3) AS avg_accuracy, round(avg(ocr_completeness_score), 3) AS avg_completeness,
         round(min(ocr_accuracy_score), 3) AS min_accuracy, round(max(ocr_accuracy_score), 3) AS max_accuracy, round(stddev(ocr_accuracy_score), 3) AS std_accuracy,
         round(stddev(ocr_completeness_score), 3) AS std_completeness, max(evaluation_timestamp) AS evaluated_at FROM eval_scores GROUP BY app_name, run_name""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.run_statistics(d.eval_scores)


@query(
    "a9_metric_summary",
    """SELECT metric, count(*) AS records, round(avg(score), 3) AS mean, round(median(score), 3) AS median, min(score) AS min, max(score) AS max, round(stddev(score), 3) AS std
       FROM (SELECT 'ocr_accuracy_score' AS metric, ocr_accuracy_score AS score FROM eval_scores
             UNION ALL SELECT 'ocr_completeness_score', ocr_completeness_score FROM eval_scores) s GROUP BY metric""",
    "eval_scores",
)
def _(d: Data):
    return judge.metric_summary(d.eval_scores)


@query(
    "a10_runs",
    """SELECT DISTINCT run_name, app_name, app_version, max(evaluation_timestamp) AS last_eval, count(*) AS doc_count
       FROM eval_scores GROUP BY run_name, app_name, app_version""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.runs(d.eval_scores)


@query(
    "a11_merge_parts",
    """SELECT original_file_path, registry_id, count(*) AS total_parts, string_agg(json_extract_string(parsed_content, '$.content'), ' ' ORDER BY part_number, parsed_content) AS merged_content
       FROM split_parts WHERE json_extract_string(parsed_content, '$.errorInformation') IS NULL GROUP BY original_file_path, registry_id""",
    "split_parts",
)
def _(d: Data):
    parts = d.split_parts
    stored = parts.select(F.col("part_stage_path").alias("file_path"), "parsed_content")
    return splitting.merged_documents(parts.drop("parsed_content"), stored)


@query(
    "a11_ordered_parts",
    """SELECT original_file_path, registry_id, part_number, json_extract_string(parsed_content, '$.content') AS part_text,
         count(*) OVER (PARTITION BY original_file_path, registry_id) AS total_parts
       FROM split_parts WHERE json_extract_string(parsed_content, '$.errorInformation') IS NULL""",
    "split_parts",
)
def _(d: Data):
    parts = d.split_parts
    stored = parts.select(F.col("part_stage_path").alias("file_path"), "parsed_content")
    return splitting.merged_parts(parts.drop("parsed_content"), stored)


@query(
    "a12_question_objects",
    f"""SELECT c.document_id, concat('{{', string_agg(concat('"', p.attribute_name, '":"', p.question_text, '"'), ',' ORDER BY p.attribute_name), '}}') AS questions
        FROM classified c JOIN {PROMPTS} p ON p.document_class = {CLASS_KEY} GROUP BY c.document_id""",
    "classified",
)
def _(d: Data):
    asked = extract.with_questions(d.classified.select("document_id", "document_class"), extraction_prompts(d.spark))
    return asked.select("document_id", F.to_json("questions").alias("questions"))


@query(
    "a13_schema_template",
    """SELECT concat('FILE_', l_orderkey) AS registry_id, concat('[', string_agg(concat('{"order":', l_linenumber, ',"name":"col_', l_partkey, '"}'), ',' ORDER BY l_linenumber, l_partkey), ']') AS template
       FROM lineitem GROUP BY l_orderkey""",
)
def _(d: Data):
    entry = F.struct(F.col("l_linenumber").alias("order"), "l_partkey")
    ordered = F.array_sort(F.collect_list(entry))
    named = F.transform(ordered, lambda e: F.struct(e["order"].alias("order"), F.concat(F.lit("col_"), e["l_partkey"]).alias("name")))
    return d.lineitem.groupBy(F.concat(F.lit("FILE_"), "l_orderkey").alias("registry_id")).agg(F.to_json(named).alias("template"))


@query(
    "a14_histogram",
    """SELECT metric, bin, round(bin / 20.0, 4) AS bin_start, round((bin + 1) / 20.0, 4) AS bin_end, count(*) AS count
       FROM (SELECT 'ocr_accuracy_score' AS metric, CAST(least(19, floor(ocr_accuracy_score * 20)) AS INTEGER) AS bin FROM eval_scores
             UNION ALL SELECT 'ocr_completeness_score', CAST(least(19, floor(ocr_completeness_score * 20)) AS INTEGER) FROM eval_scores) b GROUP BY metric, bin""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.histogram(d.eval_scores)


@query(
    "a15_category_counts",
    """SELECT metric, CASE WHEN score >= 0.97 THEN 'Excellent (≥97%)' WHEN score >= 0.9 THEN 'Good (90-96%)' WHEN score >= 0.7 THEN 'Average (70-89%)' ELSE 'Needs Review (<70%)' END AS category,
         count(*) AS count FROM (SELECT 'ocr_accuracy_score' AS metric, ocr_accuracy_score AS score FROM eval_scores
         UNION ALL SELECT 'ocr_completeness_score', ocr_completeness_score FROM eval_scores) s GROUP BY 1, 2""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.category_counts(d.eval_scores)


@query(
    "a16_low_share",
    """SELECT count(*) AS total_documents, count(*) FILTER (ocr_accuracy_score < 0.95 OR ocr_completeness_score < 0.95) AS low_count,
         round(100.0 * count(*) FILTER (ocr_accuracy_score < 0.95 OR ocr_completeness_score < 0.95) / count(*), 1) AS low_share FROM eval_scores""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.dashboard_cards(d.eval_scores).select("total_documents", "low_count", "low_share")


PERIOD = (date(2024, 1, 5), date(2024, 2, 20))
IN_PERIOD = "CAST(start_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-02-20'"
FLOW_TASK = "(" + " OR ".join(f"upper(name) LIKE '%{n}%'" for n in costs.TASK_NAMES) + ")"


@query(
    "a17_metering_sums",
    f"""SELECT name AS task_name, CAST(start_time AS DATE) AS usage_date, round(sum(credits_used), 4) AS credits_used FROM metering
        WHERE service_type = 'SERVERLESS_TASK' AND {IN_PERIOD} AND {FLOW_TASK} GROUP BY 1, 2""",
    "metering",
)
def _(d: Data):
    return costs.task_days(d.metering, *PERIOD)


@query(
    "a18_metering_subtotals",
    f"""SELECT coalesce(round(sum(token_credits) FILTER (upper(function_name) LIKE '%PARSE_DOCUMENT%'), 4), 0) AS parse_credits,
          coalesce(round(sum(token_credits) FILTER (upper(function_name) LIKE '%CLASSIFY%'), 4), 0) AS classify_credits,
          coalesce(round(sum(token_credits) FILTER (upper(function_name) LIKE '%EXTRACT%'), 4), 0) AS extract_credits,
          round(sum(token_credits), 4) AS total_token_credits, count(*) AS total_calls FROM function_usage
        WHERE {IN_PERIOD} AND (upper(function_name) LIKE '%PARSE_DOCUMENT%' OR upper(function_name) LIKE '%CLASSIFY%' OR upper(function_name) LIKE '%EXTRACT%')""",
    "function_usage",
)
def _(d: Data):
    return costs.function_totals(d.function_usage, *PERIOD)


@query(
    "a19_summary_metrics",
    """SELECT count(DISTINCT c.document_id) AS total_documents, count(DISTINCT document_class) AS unique_classifications, count(DISTINCT attribute_name) AS unique_attributes, count(*) AS total_rows
       FROM classified c LEFT JOIN (SELECT document_id, attribute_name FROM extractions) e ON c.document_id = e.document_id""",
    "classified extractions",
)
def _(d: Data):
    own = d.extractions.select("document_id", "attribute_name")
    rows = reports.keep_all_left(d.classified.select("document_id", F.col("document_class").alias("document_classification")), own, "document_id")
    return reports.summary_metrics(rows)


@query(
    "a20_success_rates",
    """SELECT s AS success, e AS errors, t - s - e AS pending, round(100.0 * s / t, 2) AS success_rate, round(100.0 * e / t, 2) AS error_rate
       FROM (SELECT count(*) AS t, count(*) FILTER (status = 'parsed') AS s, count(*) FILTER (status = 'parse_error') AS e FROM parsed) x""",
    "parsed",
)
def _(d: Data):
    stats = d.parsed.agg(
        F.count("*").alias("total_documents"),
        F.count_if(F.col("status") == "parsed").alias("classified_count"),
        F.count_if(F.col("status") == "parse_error").alias("error_count"),
    )
    return reports.success_rates(stats)


# --- limits -----------------------------------------------------------------


@query(
    "l1_ordered_status",
    """SELECT registry_id, file_name, created_timestamp FROM file_registry ORDER BY created_timestamp DESC, registry_id""",
    "file_registry",
)
def _(d: Data):
    rows = d.file_registry.select("registry_id", "file_name", "created_timestamp")
    return rows.orderBy(F.desc("created_timestamp"), "registry_id")


@query(
    "l2_recent_documents",
    f"""SELECT c.document_id, c.file_name, c.file_path, {LABEL.format("c.document_class")} AS document_class, c.classification_timestamp, p.status, c.document_type
        FROM classified c JOIN parsed p ON c.document_id = p.document_id ORDER BY c.classification_timestamp DESC, c.document_id LIMIT 10""",
    "classified",
)
def _(d: Data):
    return reports.recent_documents(d.classified, d.parsed)


@query(
    "l3_oldest_pending",
    """SELECT registry_id, file_path FROM file_registry WHERE processing_status = 'pending' ORDER BY created_timestamp, registry_id LIMIT 10""",
    "file_registry",
)
def _(d: Data):
    return csvfiles.pending_files(d.file_registry).select("registry_id", "file_path")


@query(
    "l4_sample_rows",
    "SELECT document_id, substring(content_text, 1, 100) AS text_preview, length(content_text) AS text_length FROM parsed ORDER BY document_id LIMIT 5",
    "parsed",
)
def _(d: Data):
    """Five rows, the first by document_id so that each run shows the same."""
    return evaluation.source_preview(d.parsed, "content_text").orderBy("document_id").limit(5)


@query(
    "l5_lowest_scores",
    """SELECT document_id, ocr_accuracy_score, ocr_completeness_score, ocr_accuracy_reasoning, substring(ocr_text, 1, 100) AS text_preview FROM eval_scores
       WHERE ocr_accuracy_score < 0.95 OR ocr_completeness_score < 0.95 ORDER BY ocr_accuracy_score, document_id LIMIT 10""",
    "eval_scores",
)
def _(d: Data):
    return evaluation.lowest(d.eval_scores)


# --- set operations ---------------------------------------------------------

FLAT = """SELECT document_id, attribute_name, attribute_value, confidence_score FROM extractions
          WHERE attribute_value IS NULL OR NOT json_valid(attribute_value) OR json_type(attribute_value) <> 'OBJECT'
          UNION ALL SELECT document_id, k, json_extract_string(attribute_value, concat('$.', k)), confidence_score
          FROM (SELECT document_id, attribute_value, confidence_score, unnest(json_keys(attribute_value)) AS k FROM extractions
                WHERE attribute_value IS NOT NULL AND json_valid(attribute_value) AND json_type(attribute_value) = 'OBJECT') o"""
FLAT_STRICT = """SELECT document_id, attribute_name, attribute_value, confidence_score FROM extractions
          WHERE attribute_value IS NULL OR NOT json_valid(attribute_value)
          UNION ALL SELECT document_id, k, json_extract_string(attribute_value, concat('$.', k)), confidence_score
          FROM (SELECT document_id, attribute_value, confidence_score, unnest(json_keys(attribute_value)) AS k FROM extractions
                WHERE attribute_value IS NOT NULL AND json_valid(attribute_value) AND json_type(attribute_value) = 'OBJECT') o
          UNION ALL SELECT document_id, NULL, unnest(['1', '2']), confidence_score FROM extractions WHERE attribute_value = '[1,2]'"""


@query("u2_flatten_attributes", FLAT, "extractions")
def _(d: Data):
    return extract.flatten_attributes(d.extractions).select("document_id", "attribute_name", "attribute_value", "confidence_score")


@query("u2_flatten_strict", FLAT_STRICT, "extractions")
def _(d: Data):
    return extract.flatten_attributes(d.extractions, strict=True).select("document_id", "attribute_name", "attribute_value", "confidence_score")


@query(
    "u3_seed_rows",
    f"""SELECT p.document_class, count(DISTINCT p.attribute_name) AS questions, count(DISTINCT c.document_id) AS documents
        FROM {PROMPTS} p LEFT JOIN classified c ON p.document_class = {CLASS_KEY} GROUP BY p.document_class""",
    "classified",
)
def _(d: Data):
    per_class = d.classified.select(jsontext.class_key(jsontext.unwrap_label(F.col("document_class"))).alias("document_class")).groupBy("document_class").agg(
        F.count("*").alias("documents")
    )
    asked = extraction_prompts(d.spark).groupBy("document_class").agg(F.count("*").alias("questions"))
    return asked.join(per_class, "document_class", "left").fillna(0, ["documents"])


@query("u4_distinct", "SELECT DISTINCT run_name, app_name FROM eval_scores", "eval_scores")
def _(d: Data):
    return d.eval_scores.select("run_name", "app_name").distinct()
