"""Scalar, predicate and JSON queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import jsontext, paths, scores, text
from ..operators import routing, splitting
from . import costs, evaluation, reports
from .fixtures import Data
from .registry import query

AS_OF = datetime(2024, 3, 1)


def _path():
    return F.col("relative_path")

# --- predicates -------------------------------------------------------------


@query(
    "p1_route_large",
    r"SELECT doc_id, regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX)$') AS large_type FROM staged",
    "staged",
)
def _(d: Data):
    return d.staged.select("doc_id", paths.is_large_type(_path()).alias("large_type"))


@query(
    "p2_route_parse",
    r"SELECT relative_path, size FROM staged WHERE regexp_matches(upper(relative_path), '\.(PDF|DOCX|PPTX|JPE?G|PNG|TIFF?|HTML|TXT)$')",
    "staged",
)
def _(d: Data):
    return d.staged.filter(paths.is_parse_type(_path())).select("relative_path", "size")


@query(
    "p3_route_spreadsheet",
    r"""SELECT relative_path, size FROM staged
        WHERE regexp_matches(upper(relative_path), '\.XLS[XM]$') AND relative_path NOT LIKE 'converted_excel/%'""",
    "staged",
)
def _(d: Data):
    return d.staged.filter(paths.is_spreadsheet(_path())).select("relative_path", "size")


@query("p4_route_csv", "SELECT relative_path, size FROM staged WHERE upper(relative_path) LIKE '%.CSV'", "staged")
def _(d: Data):
    return d.staged.filter(paths.is_csv(_path())).select("relative_path", "size")


@query(
    "p5_size_threshold",
    """SELECT CASE WHEN size > 104857600 THEN 'large' ELSE 'normal' END AS size_class, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes
       FROM staged GROUP BY 1""",
    "staged",
)
def _(d: Data):
    kind = F.when(F.col("size") > paths.LARGE_FILE_BYTES, "large").otherwise("normal")
    return d.staged.groupBy(kind.alias("size_class")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


@query(
    "p6_file_type",
    r"""SELECT doc_id, CASE lower(regexp_extract(relative_path, '\.[^.]+$')) WHEN '.pdf' THEN 'pdf' WHEN '.docx' THEN 'docx'
          WHEN '.pptx' THEN 'pptx' WHEN '.jpg' THEN 'jpeg' WHEN '.jpeg' THEN 'jpeg' WHEN '.png' THEN 'png' WHEN '.tiff' THEN 'tiff'
          WHEN '.tif' THEN 'tiff' WHEN '.html' THEN 'html' WHEN '.txt' THEN 'txt' ELSE 'unknown' END AS document_type FROM staged""",
    "staged",
)
def _(d: Data):
    return d.staged.select("doc_id", paths.file_type(_path()).alias("document_type"))


@query(
    "p7_split_part",
    r"""SELECT doc_id, relative_path LIKE '%_part_%_of_%.pdf' AS is_split_part,
          regexp_matches(relative_path, '_part_[0-9]+_of_[0-9]+\.pdf$') AS is_numbered_part FROM staged""",
    "staged",
)
def _(d: Data):
    return d.staged.select(
        "doc_id", paths.is_split_part(_path()).alias("is_split_part"), paths.is_split_part(_path(), strict=False).alias("is_numbered_part")
    )


@query(
    "p8_page_limit",
    """SELECT document_id, error_information FROM parsed
       WHERE error_information LIKE '%500 pages%' OR error_information LIKE '%Maximum number of%pages exceeded%'""",
    "parsed",
)
def _(d: Data):
    return d.parsed.filter(routing.hit_page_limit(F.col("error_information"))).select("document_id", "error_information")


@query(
    "p9_classifiable",
    "SELECT document_id, length(content_text) AS n FROM parsed WHERE status = 'parsed' AND length(trim(content_text)) > 0",
    "parsed",
)
def _(d: Data):
    from ..operators.classify import classifiable

    rows = d.parsed.withColumn("parsed_content", F.col("content_text"))
    return classifiable(rows).select("document_id", F.length("content_text").alias("n"))


@query(
    "p10_extractable",
    """SELECT c.document_id, c.document_class FROM classified c JOIN parsed p ON c.document_id = p.document_id
       WHERE c.file_path <> '' AND p.content_text IS NOT NULL
         AND NOT EXISTS (SELECT 1 FROM extractions e WHERE e.document_id = c.document_id)""",
    "classified extractions",
)
def _(d: Data):
    from ..operators.extract import extractable

    return extractable(d.classified, d.parsed, d.extractions).select("document_id", "document_class")


@query(
    "p11_chunkable",
    "SELECT document_id FROM parsed WHERE length(trim(content_text)) > 100 AND status <> 'parse_error'",
    "parsed",
)
def _(d: Data):
    from ..operators.chunking import chunkable

    return chunkable(d.parsed).select("document_id")


@query(
    "p12_without_error_text",
    "SELECT part_id, parsed_content FROM split_parts WHERE parsed_content NOT ILIKE '%errorInformation%'",
    "split_parts",
)
def _(d: Data):
    return d.split_parts.filter(~F.col("parsed_content").ilike("%errorInformation%")).select("part_id", "parsed_content")


@query(
    "p13_json_split",
    """SELECT coalesce(json_valid(attribute_value), false) AS is_json, count(*) AS row_count, count(attribute_value) AS value_count
       FROM extractions GROUP BY 1""",
    "extractions",
)
def _(d: Data):
    kind = jsontext.is_json(F.col("attribute_value")).alias("is_json")
    return d.extractions.groupBy(kind).agg(F.count("*").alias("row_count"), F.count("attribute_value").alias("value_count"))


@query(
    "p14_valid_class",
    """SELECT document_id, document_class FROM classified
       WHERE document_class NOT LIKE 'ERR_%' AND document_class <> 'classification_error'""",
    "classified",
)
def _(d: Data):
    return d.classified.filter(reports.is_valid_class(F.col("document_class"))).select("document_id", "document_class")


@query(
    "p15_pending_states",
    """SELECT registry_id, split_status FROM large_registry
       WHERE split_status IN ('pending', 'pending_split', 'pending_page_limit', 'requires_external_processing') AND split_required""",
    "large_registry",
)
def _(d: Data):
    return splitting.pending_splits(d.large_registry).select("registry_id", "split_status")


@query(
    "p16_score_filters",
    """SELECT document_id, ocr_accuracy_score < 0.95 OR ocr_completeness_score < 0.95 AS is_low FROM eval_scores
       WHERE ocr_accuracy_score >= 0.7 AND ocr_completeness_score >= 0.75""",
    "eval_scores",
)
def _(d: Data):
    kept = d.eval_scores.filter(evaluation.chosen(None, 0.7, 0.75))
    low = scores.is_low_score(F.col("ocr_accuracy_score"), F.col("ocr_completeness_score"))
    return kept.select("document_id", low.alias("is_low"))


@query("p17_id_search", "SELECT document_id, run_name FROM eval_scores WHERE contains(lower(document_id), 'c_1')", "eval_scores")
def _(d: Data):
    return evaluation.search_by_id(d.eval_scores, "C_1").select("document_id", "run_name")


@query(
    "p18_metering_filter",
    """SELECT name, service_type, round(sum(credits_used), 4) AS credits FROM metering
       WHERE CAST(start_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND service_type IN ('SERVERLESS_TASK', 'AI_SERVICES')
         AND (upper(name) LIKE '%PARSE_DOCUMENTS_TASK%' OR upper(name) LIKE '%EXTRACT_DOCUMENTS_TASK%') GROUP BY ALL""",
    "metering",
)
def _(d: Data):
    rows = d.metering.filter(
        costs.in_period("start_time", datetime(2024, 1, 5).date(), datetime(2024, 1, 20).date())
        & F.col("service_type").isin(costs.TASK_SERVICE, costs.AI_SERVICE)
        & costs.name_has("name", "PARSE_DOCUMENTS_TASK", "EXTRACT_DOCUMENTS_TASK")
    )
    return rows.groupBy("name", "service_type").agg(costs.credits().alias("credits"))


@query(
    "p19_last_days",
    "SELECT document_id, CAST(classification_timestamp AS DATE) AS day FROM classified WHERE classification_timestamp >= DATE '2024-01-31'",
    "classified",
)
def _(d: Data):
    recent = F.col("classification_timestamp") >= F.date_sub(F.lit(AS_OF.date()), 30)
    return d.classified.filter(recent).select("document_id", F.to_date("classification_timestamp").alias("day"))


@query(
    "p20_previews",
    """SELECT document_id, substring(content_text, 1, 50) AS short, substring(content_text, 1, 100) AS middle,
         substring(content_text, 1, 200) AS long, length(content_text) AS text_length FROM parsed""",
    "parsed",
)
def _(d: Data):
    body = F.col("content_text")
    return d.parsed.select(
        "document_id",
        text.preview(body, 50).alias("short"),
        text.preview(body, 100).alias("middle"),
        text.preview(body, 200).alias("long"),
        F.length(body).alias("text_length"),
    )


@query(
    "p21_confidence_bands",
    """SELECT event_id, coalesce(confidence_score < 0.5, false) AS is_low,
         CASE WHEN confidence_score IS NULL THEN 'gray' WHEN confidence_score < 0.3 THEN 'red' WHEN confidence_score < 0.4 THEN 'orange'
              WHEN confidence_score < 0.5 THEN 'yellow' ELSE 'green' END AS band FROM extractions""",
    "extractions",
)
def _(d: Data):
    score = F.col("confidence_score")
    return d.extractions.select(
        "event_id", scores.is_low_confidence(score, 0.5).alias("is_low"), scores.confidence_band(score, 0.5).alias("band")
    )


@query(
    "p22_score_categories",
    """SELECT document_id, CASE WHEN ocr_accuracy_score >= 0.97 THEN 'Excellent (≥97%)' WHEN ocr_accuracy_score >= 0.9 THEN 'Good (90-96%)'
         WHEN ocr_accuracy_score >= 0.7 THEN 'Average (70-89%)' ELSE 'Needs Review (<70%)' END AS category,
         CASE WHEN ocr_completeness_score >= 0.97 THEN 'Excellent' WHEN ocr_completeness_score >= 0.9 THEN 'Good' ELSE 'Needs Review' END AS verdict
       FROM eval_scores""",
    "eval_scores",
)
def _(d: Data):
    return d.eval_scores.select(
        "document_id",
        scores.score_category(F.col("ocr_accuracy_score")).alias("category"),
        scores.run_verdict(F.col("ocr_completeness_score")).alias("verdict"),
    )


@query(
    "p23_point_lookup",
    """SELECT c.document_id, c.file_name, c.document_type, p.status, length(p.content_text) AS text_length
       FROM classified c JOIN parsed p ON c.document_id = p.document_id WHERE c.document_id = 'DOC_11'""",
    "classified",
)
def _(d: Data):
    info = reports.document_info(d.classified, d.parsed, "DOC_11")
    return info.select("document_id", "file_name", "document_type", "status", F.length("content_text").alias("text_length"))


# --- scalar functions -------------------------------------------------------


@query(
    "f1_f11_ids",
    """SELECT doc_id, concat('REG_', md5(relative_path), '_2024-03-01_000000') AS registry_id,
         'DOC_2024-03-01_000000_' || md5(relative_path) AS document_id FROM staged""",
    "staged",
)
def _(d: Data):
    return d.staged.select(
        "doc_id", paths.registry_id("REG", _path(), AS_OF).alias("registry_id"), paths.document_id(_path(), AS_OF).alias("document_id")
    )


@query(
    "f2_class_key",
    "SELECT document_id, lower(replace(replace(trim(document_class), ' ', '_'), '-', '_')) AS class_key FROM classified",
    "classified",
)
def _(d: Data):
    return d.classified.select("document_id", jsontext.class_key(F.col("document_class")).alias("class_key"))


@query(
    "f3_f4_f5_case_trim_length",
    """SELECT doc_id, upper(concat(source, '/', lang)) AS upper_path, md5(lower(text)) AS lower_md5, length(trim(text)) AS trimmed_length, length(text) AS text_length
       FROM documents""",
)
def _(d: Data):
    return d.documents.select(
        "doc_id",
        F.upper(F.concat("source", F.lit("/"), "lang")).alias("upper_path"),
        F.md5(F.lower("text")).alias("lower_md5"),
        F.length(F.trim("text")).alias("trimmed_length"),
        F.length("text").alias("text_length"),
    )


@query("f6_left", "SELECT doc_id, left(text, 100) AS head, left(lang, 1) AS initial FROM documents")
def _(d: Data):
    return d.documents.select("doc_id", text.preview(F.col("text"), 100).alias("head"), F.left("lang", F.lit(1)).alias("initial"))


@query(
    "f7_base_name",
    "SELECT page_id, nullif(regexp_extract(url, '[^/]+$'), '') AS page_name FROM pages",
)
def _(d: Data):
    return d.pages.select("page_id", paths.base_name(F.col("url")).alias("page_name"))


@query(
    "f8_extension",
    r"SELECT page_id, nullif(regexp_extract(url, '\.[^.]+$'), '') AS extension FROM pages",
)
def _(d: Data):
    return d.pages.select("page_id", paths.extension(F.col("url")).alias("extension"))


@query(
    "f9_like",
    """SELECT lang, count(*) FILTER (text LIKE '%tion%') AS has_like, count(*) FILTER (text NOT LIKE '%license%') AS not_like,
         count(*) FILTER (text ILIKE '%LICENSE%') AS has_ilike, count(*) FILTER (text NOT ILIKE '%The %') AS not_ilike FROM documents GROUP BY lang""",
)
def _(d: Data):
    body = F.col("text")
    return d.documents.groupBy("lang").agg(
        F.count_if(body.like("%tion%")).alias("has_like"),
        F.count_if(~body.like("%license%")).alias("not_like"),
        F.count_if(body.ilike("%LICENSE%")).alias("has_ilike"),
        F.count_if(~body.ilike("%The %")).alias("not_ilike"),
    )


@query("f10_path_hash", "SELECT doc_id, md5(relative_path) AS path_hash FROM staged", "staged")
def _(d: Data):
    return d.staged.select("doc_id", paths.path_hash(_path()).alias("path_hash"))


@query(
    "f12_rounding",
    """SELECT doc_id, round(size / 1024.0, 2) AS size_kb, round(size / 1048576.0, 2) AS size_mb FROM staged""",
    "staged",
)
def _(d: Data):
    size = F.col("size")
    return d.staged.select(
        "doc_id", text.size_in(size, reports.KB).alias("size_kb"), text.size_in(size, reports.MB).alias("size_mb")
    )


@query(
    "f13_f14_case_coalesce",
    """SELECT document_id, coalesce(CASE WHEN json_valid(document_class) THEN json_extract_string(document_class, '$.labels[0]') ELSE document_class END,
         'unclassified') AS document_class FROM classified""",
    "classified",
)
def _(d: Data):
    name = F.coalesce(jsontext.unwrap_label(F.col("document_class")), F.lit("unclassified"))
    return d.classified.select("document_id", name.alias("document_class"))


@query(
    "f15_casts",
    """SELECT event_id, try_cast(attribute_value AS DOUBLE) AS number, CAST(event_id AS VARCHAR) AS event_text FROM extractions""",
    "extractions",
)
def _(d: Data):
    return d.extractions.select(
        "event_id", F.col("attribute_value").try_cast("double").alias("number"), F.col("event_id").cast("string").alias("event_text")
    )


@query("f16_json_text", "SELECT part_id, parsed_content AS json_text FROM split_parts", "split_parts")
def _(d: Data):
    return d.split_parts.select("part_id", F.to_json(F.parse_json("parsed_content")).alias("json_text"))


@query(
    "f17_dates",
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(ts AS DATE) - 30 AS month_before, CAST(CAST(ts AS DATE) + INTERVAL 7 DAY AS DATE) AS week_after FROM events""",
)
def _(d: Data):
    day = F.to_date("ts")
    return d.events.select(
        "event_id", day.alias("day"), F.date_sub(day, 30).alias("month_before"), F.date_add(day, 7).alias("week_after")
    )


@query(
    "f18_strip_extension",
    r"SELECT document_id, regexp_replace(file_name, '\.[^.]*$', '') AS stem FROM parsed",
    "parsed",
)
def _(d: Data):
    return d.parsed.select("document_id", paths.strip_extension(F.col("file_name")).alias("stem"))


@query(
    "f19_table_name",
    r"""SELECT page_id, concat('CSV_', CASE WHEN regexp_matches(n, '^[0-9]') THEN 'T_' ELSE '' END, n) AS table_name
        FROM (SELECT page_id, upper(regexp_replace(regexp_replace(regexp_extract(url, '[^/]+$'), '\.[^.]*$', ''), '[^\p{L}\p{N}_]', '_', 'g')) AS n FROM pages) t""",
)
def _(d: Data):
    name = F.regexp_extract("url", "[^/]+$", 0)
    return d.pages.select("page_id", paths.table_name(name).alias("table_name"))


@query(
    "f20_f21_part_names",
    r"""SELECT registry_id, CAST(ceil(page_count / 200.0) AS BIGINT) AS part_count,
          concat(regexp_replace(original_file_name, '\.[^.]*$', ''), '_part_1_of_', CAST(ceil(page_count / 200.0) AS BIGINT), '.pdf') AS first_part,
          concat(registry_id, '_PART_', CAST(ceil(page_count / 200.0) AS BIGINT)) AS last_part_id FROM large_registry""",
    "large_registry",
)
def _(d: Data):
    total = F.ceil(F.col("page_count") / F.lit(splitting.PAGES_PER_PART)).cast("bigint")
    return d.large_registry.select(
        "registry_id",
        total.alias("part_count"),
        paths.part_file_name(F.col("original_file_name"), F.lit(1), total).alias("first_part"),
        paths.member_id(F.col("registry_id"), "PART", total).alias("last_part_id"),
    )


@query(
    "f22_clip_cell",
    """SELECT doc_id, CASE WHEN length(t) > 100 THEN concat(substring(t, 1, 97), '...') ELSE t END AS cell
       FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 3 THEN '' ELSE text END AS t FROM documents) x""",
)
def _(d: Data):
    value = F.when(F.col("doc_id") % 5 != 3, F.col("text"))
    return d.documents.select("doc_id", text.clip_cell(value).alias("cell"))


@query(
    "f23_display_path",
    """SELECT page_id, CASE WHEN length(url) > 30 THEN concat('...', right(url, 27)) ELSE url END AS shown,
         regexp_replace(concat('s3://', split_part(url, '//', 2)), '^s3://[^/]+/', '') AS key FROM pages""",
)
def _(d: Data):
    url = F.col("url")
    as_s3 = F.concat(F.lit("s3://"), F.split_part(url, F.lit("//"), F.lit(2)))
    return d.pages.select("page_id", paths.display_path(url).alias("shown"), paths.strip_bucket(as_s3).alias("key"))


@query("f24_clip_error", "SELECT doc_id, substring(text, 1, 1900) AS error_message, length(substring(text, 1, 100)) AS n FROM documents")
def _(d: Data):
    body = F.col("text")
    return d.documents.select("doc_id", text.clip_error(body).alias("error_message"), F.length(text.clip_error(body, 100)).alias("n"))


@query(
    "f25_clamp",
    "SELECT event_id, least(1.0::DOUBLE, greatest(0.0::DOUBLE, (value - 20) / 50)) AS score FROM events",
)
def _(d: Data):
    return d.events.select("event_id", scores.clamp((F.col("value") - 20) / 50).alias("score"))


# --- JSON -------------------------------------------------------------------


@query(
    "n1_path_access",
    """SELECT part_id, json_extract_string(parsed_content, '$.content') AS content, json_extract_string(parsed_content, '$.errorInformation') AS error
       FROM split_parts""",
    "split_parts",
)
def _(d: Data):
    stored = F.col("parsed_content")
    return d.split_parts.select(
        "part_id", jsontext.path_value(stored, "$.content").alias("content"), jsontext.path_value(stored, "$.errorInformation").alias("error")
    )


@query(
    "n2_dynamic_path",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN value END AS score
       FROM events""",
)
def _(d: Data):
    stored = F.to_json(F.struct(F.struct(F.struct(F.col("value").alias("view")).alias("scores")).alias("output_details")))
    return d.events.select(
        "event_id", jsontext.keyed_value(stored, "$.output_details.scores", F.col("event_type")).alias("score")
    )


@query(
    "n3_parse_json",
    """SELECT event_id, CASE WHEN json_valid(attribute_value) THEN json_type(attribute_value) IN ('OBJECT') ELSE false END AS is_object,
         coalesce(json_valid(attribute_value), false) AS is_json FROM extractions""",
    "extractions",
)
def _(d: Data):
    value = F.col("attribute_value")
    return d.extractions.select(
        "event_id", jsontext.is_json_object(value).alias("is_object"), jsontext.is_json(value).alias("is_json")
    )


@query(
    "n4_explode_json",
    """SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events
       UNION ALL SELECT event_id, 'v', CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) FROM events""",
)
def _(d: Data):
    merged = F.concat(F.substring("props", F.lit(1), F.length("props") - 1), F.lit(',"v":"'), F.col("value").cast("decimal(12,2)").cast("string"), F.lit('"}'))
    return jsontext.explode_json(d.events.select("event_id", merged.alias("j")), "j").select("event_id", "key", "value")


@query(
    "n5_row_object",
    """SELECT o_orderkey, concat('{"o_orderkey":', o_orderkey, ',"o_orderpriority":"', o_orderpriority, '"',
         CASE WHEN o_orderstatus = 'F' THEN ',"o_orderstatus":"F"' ELSE '' END, '}') AS row_data FROM orders""",
)
def _(d: Data):
    status = F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).alias("o_orderstatus")
    rows = d.orders.select("o_orderkey", "o_orderpriority", status)
    return rows.select("o_orderkey", jsontext.row_object(["o_orderkey", "o_orderpriority", "o_orderstatus"]).alias("row_data"))


@query(
    "n6_object_and_array_agg",
    """SELECT n_regionkey, concat('{', string_agg(concat('"', n_name, '":', n_nationkey), ',' ORDER BY n_name), '}') AS object,
         concat('[', string_agg(concat('"', n_name, '"'), ',' ORDER BY n_nationkey), ']') AS array FROM nation GROUP BY n_regionkey""",
)
def _(d: Data):
    pairs = F.array_sort(F.collect_list(F.struct("n_name", "n_nationkey")))
    ordered = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    return d.nation.groupBy("n_regionkey").agg(
        F.to_json(F.map_from_entries(pairs)).alias("object"),
        F.to_json(F.transform(ordered, lambda x: x["n_name"])).alias("array"),
    )


@query(
    "n7_unwrap_label",
    """SELECT document_id, CASE WHEN json_valid(document_class) THEN json_extract_string(document_class, '$.labels[0]') ELSE document_class END AS label,
         CASE WHEN json_valid(document_class) THEN coalesce(json_extract_string(document_class, '$.labels[0]'), document_class) ELSE document_class END AS label_or_raw
       FROM classified""",
    "classified",
)
def _(d: Data):
    name = F.col("document_class")
    return d.classified.select(
        "document_id", jsontext.unwrap_label(name).alias("label"), jsontext.unwrap_label(name, keep_unlabelled=True).alias("label_or_raw")
    )


@query(
    "n8_judge_replies",
    """SELECT r.document_id, CASE r.doc_id % 8 WHEN 0 THEN CAST(concat('0.', d.n_chars % 100 + 100) AS DOUBLE) WHEN 1 THEN CAST(concat('0.', d.n_chars % 100 + 100) AS DOUBLE)
         WHEN 2 THEN 1.0 WHEN 3 THEN 0.0 WHEN 4 THEN 0.0 ELSE 0.5 END AS score,
         CASE r.doc_id % 8 WHEN 0 THEN concat('clear ', d.lang) WHEN 1 THEN 'inner' WHEN 2 THEN 'too high' WHEN 3 THEN 'no score'
           WHEN 4 THEN 'No reasoning provided' ELSE 'No reasoning captured' END AS reasoning
       FROM judge_replies r JOIN documents d ON r.doc_id = d.doc_id""",
    "judge_replies",
)
def _(d: Data):
    parsed = d.judge_replies.withColumn("r", jsontext.judge_reply(F.col("reply")))
    return parsed.select("document_id", "r.score", "r.reasoning")


@query(
    "n9_schema_list",
    """SELECT n_regionkey, concat('[', string_agg(concat('{"order":', n_nationkey, ',"column_name":"', n_name, '","type":"string","nullable":true}'), ',' ORDER BY n_nationkey), ']') AS inferred_schema,
         count(*) AS column_count FROM nation GROUP BY n_regionkey""",
)
def _(d: Data):
    from ..sources.csvfiles import schema_json

    columns = d.nation.select(
        F.col("n_regionkey").alias("registry_id"),
        F.col("n_nationkey").alias("column_order"),
        F.col("n_name").alias("column_name"),
        F.lit("string").alias("column_type"),
        F.lit(True).alias("nullable"),
    )
    return schema_json(columns).withColumnRenamed("registry_id", "n_regionkey")
