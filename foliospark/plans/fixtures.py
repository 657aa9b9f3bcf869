"""Views derived from the given tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import spread, work_folder

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {
    # Every route, size class and name form.
    "staged": """
        SELECT doc_id, text, lang, source, n_chars,
               concat(CASE WHEN doc_id % 32 = 10 THEN 'converted_excel' ELSE source END, '/', lang, '/doc_', doc_id,
                 CASE doc_id % 16 WHEN 0 THEN '.pdf' WHEN 1 THEN '.docx' WHEN 2 THEN '.pptx' WHEN 3 THEN '.jpeg'
                      WHEN 4 THEN '.jpg' WHEN 5 THEN '.png' WHEN 6 THEN '.tiff' WHEN 7 THEN '.tif' WHEN 8 THEN '.html'
                      WHEN 9 THEN '.txt' WHEN 10 THEN '.xlsx' WHEN 11 THEN '.xlsm' WHEN 12 THEN '.csv'
                      WHEN 13 THEN '.zip' WHEN 14 THEN '.PDF' ELSE '_part_1_of_3.pdf' END) AS relative_path,
               n_chars * 20000 AS size,
               concat('stage://', doc_id) AS file_url
        FROM documents""",
    "parsed": """
        SELECT concat('DOC_', doc_id) AS document_id, doc_id, lang, source,
               regexp_extract(relative_path, '[^/]+$', 0) AS file_name,
               relative_path AS file_path, size AS file_size, file_url,
               CASE WHEN doc_id % 16 IN (0, 14, 15) THEN 'pdf' WHEN doc_id % 16 = 9 THEN 'txt' ELSE 'html' END AS document_type,
               text AS content_text,
               CASE WHEN doc_id % 50 = 8 THEN 'Maximum number of 500 pages exceeded'
                    WHEN doc_id % 50 = 7 THEN 'File is damaged' END AS error_information,
               CASE WHEN doc_id % 50 IN (7, 8) THEN 'parse_error' ELSE 'parsed' END AS status
        FROM staged""",
    # Stored classes in all the forms readers must cope with.
    "classified": """
        SELECT document_id, file_name, file_path, file_size, file_url, document_type, doc_id,
               CASE doc_id % 12 WHEN 0 THEN 'w2' WHEN 1 THEN '{"labels":["vendor_contract"]}' WHEN 2 THEN ' Sales Report '
                    WHEN 3 THEN 'sales-report' WHEN 4 THEN 'HR_POLICY' WHEN 5 THEN '{"labels":[]}' WHEN 6 THEN '{"x":1}'
                    WHEN 7 THEN '7' WHEN 8 THEN NULL WHEN 9 THEN 'ERR_TIMEOUT' WHEN 10 THEN 'classification_error'
                    ELSE 'case_study' END AS document_class,
               CAST('2024-03-01 00:00:00' AS TIMESTAMP) - doc_id * INTERVAL '37' MINUTE AS classification_timestamp
        FROM parsed""",
    "extractions": """
        SELECT concat('DOC_', user_id) AS document_id, concat('doc_', user_id, '.pdf') AS file_name,
               concat('src/doc_', user_id, '.pdf') AS file_path, 'w2' AS document_class, event_id,
               event_type AS attribute_name,
               CASE event_id % 7 WHEN 0 THEN props WHEN 1 THEN CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR(20)) WHEN 2 THEN 'Net 30'
                    WHEN 3 THEN '12,062' WHEN 4 THEN concat('{"k":', event_id, ',"note":"n', user_id, '","none":null}')
                    WHEN 5 THEN NULL ELSE '[1,2]' END AS attribute_value,
               CASE WHEN event_id % 13 = 5 THEN NULL ELSE CAST(event_id % 101 AS DOUBLE) / 100 END AS confidence_score,
               ts AS extraction_timestamp
        FROM events""",
    # Unique per document and attribute.
    "extraction_state": """
        SELECT document_id, min(file_name) AS file_name, min(file_path) AS file_path, min(document_class) AS document_class, attribute_name,
               max(attribute_value) AS attribute_value, CAST(max(confidence_score) AS DOUBLE) AS confidence_score
        FROM extractions GROUP BY document_id, attribute_name""",
    "eval_scores": """
        SELECT concat('DOC_', d.doc_id) AS document_id, d.text AS ocr_text,
               CAST(100 - d.n_chars % 40 AS DOUBLE) / 100 AS ocr_accuracy_score, concat('accuracy of ', d.lang) AS ocr_accuracy_reasoning,
               CAST(100 - d.doc_id % 35 AS DOUBLE) / 100 AS ocr_completeness_score, concat('completeness of ', d.lang) AS ocr_completeness_reasoning,
               CASE WHEN d.doc_id % 9 = 4 THEN 'OTHER_APP' ELSE 'OCR_EVL' END AS app_name, 'v1' AS app_version,
               concat('run_', d.source) AS run_name, 'parsed_documents' AS source_table,
               CAST('2024-02-01 00:00:00' AS TIMESTAMP) + d.doc_id * INTERVAL '5' MINUTE AS evaluation_timestamp
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    # Model replies as object, object inside a string, partial object and junk.
    "judge_replies": """
        SELECT concat('DOC_', doc_id) AS document_id, doc_id,
               CASE doc_id % 8 WHEN 0 THEN concat('{"score":0.', n_chars % 100 + 100, ',"reasoning":"clear ', lang, '"}')
                    WHEN 1 THEN replace(concat('"{~"score~":0.', n_chars % 100 + 100, ',~"reasoning~":~"inner~"}"'), '~', chr(92))
                    WHEN 2 THEN '{"score":1.7,"reasoning":"too high"}' WHEN 3 THEN '{"reasoning":"no score"}'
                    WHEN 4 THEN '{"score":-0.1}' WHEN 5 THEN 'I would say 0.9' WHEN 6 THEN '{"score":null}'
                    ELSE NULL END AS reply
        FROM documents""",
    "metering": """
        SELECT CASE event_type WHEN 'purchase' THEN 'AI_SERVICES' WHEN 'error' THEN 'WAREHOUSE' ELSE 'SERVERLESS_TASK' END AS service_type,
               CASE event_type WHEN 'view' THEN CASE event_id % 2 WHEN 0 THEN 'Parse_Documents_Task' ELSE 'CLASSIFY_DOCUMENTS_TASK' END
                    WHEN 'click' THEN CASE event_id % 2 WHEN 0 THEN 'EXTRACT_DOCUMENTS_TASK' ELSE 'chunk_documents_task_2' END
                    WHEN 'signup' THEN CASE event_id % 2 WHEN 0 THEN 'NIGHTLY_LOAD' END ELSE 'SOMETHING_ELSE' END AS name,
               ts AS start_time, value AS credits_used
        FROM events""",
    "function_usage": """
        SELECT CASE event_type WHEN 'view' THEN 'DOC_PARSE_DOCUMENT' WHEN 'click' THEN 'doc_classify' WHEN 'purchase' THEN 'DOC_EXTRACT'
                    ELSE 'COMPLETE' END AS function_name, ts AS start_time, value AS token_credits
        FROM events""",
    "search_usage": """
        SELECT CASE event_type WHEN 'error' THEN 'OTHER_SERVICE' WHEN 'view' THEN 'document_search_service' ELSE 'DOCUMENT_SEARCH_SERVICE' END AS service_name,
               CAST(ts AS DATE) AS usage_date, event_id % 1000 AS tokens, value AS credits
        FROM events""",
    "large_registry": """
        SELECT concat('REG_', doc_id) AS registry_id, concat('docs/report_', doc_id, '.pdf') AS original_file_path,
               concat('report_', doc_id, '.pdf') AS original_file_name, n_chars * 20000 AS original_file_size,
               CAST(ceil(n_chars / 40.0) AS BIGINT) AS page_count, n_chars % 5 <> 0 AS split_required,
               CASE doc_id % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'pending_split' WHEN 2 THEN 'pending_page_limit'
                    WHEN 3 THEN 'requires_external_processing' WHEN 4 THEN 'splitting' ELSE 'split_complete' END AS split_status,
               CAST('2024-01-01 00:00:00' AS TIMESTAMP) + doc_id * INTERVAL '1' MINUTE AS created_timestamp
        FROM documents""",
    "split_parts": """
        SELECT concat(o.registry_id, '_PART_', l.l_linenumber) AS part_id, o.registry_id, o.original_file_path, l.l_orderkey, l.l_partkey, l.l_suppkey,
               CAST(l.l_linenumber AS BIGINT) AS part_number,
               concat('split_documents/p_', l.l_orderkey, '_', l.l_linenumber, '_', l.l_partkey, '_', l.l_suppkey, '.pdf') AS part_stage_path,
               CASE WHEN l.l_returnflag = 'R' THEN 'processed' ELSE 'uploaded' END AS status,
               CASE WHEN l.l_returnflag = 'A' AND l.l_linenumber = 2 THEN concat('{"errorInformation":"part ', l.l_partkey, ' failed"}')
                    WHEN l.l_linenumber = 3 THEN concat('{"content":"errorInformation is a word here ', l.l_partkey, '"}')
                    ELSE concat('{"content":"text ', l.l_partkey, ' of ', l.l_suppkey, '"}') END AS parsed_content
        FROM (SELECT concat('REG_', o_orderkey) AS registry_id, o_orderkey, concat('docs/order_', o_orderkey, '.pdf') AS original_file_path FROM orders) o
        JOIN (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, max(l_returnflag) AS l_returnflag FROM lineitem
              GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey) l ON l.l_orderkey = o.o_orderkey""",
    # A registry of files with CSV or spreadsheet states.
    "file_registry": """
        SELECT concat('FILE_', o_orderkey) AS registry_id, concat('in/', o_orderpriority, '/file_', o_orderkey, '.csv') AS file_path,
               concat('file_', o_orderkey, '.csv') AS file_name, CAST(round(o_totalprice * 100) AS BIGINT) AS file_size,
               CASE o_orderstatus WHEN 'F' THEN 'pending' WHEN 'O' THEN 'completed' ELSE 'processing' END AS processing_status,
               o_orderdate AS created_timestamp, o_custkey, o_orderkey
        FROM orders""",
    "status_events": """
        SELECT concat('FILE_', l_orderkey) AS registry_id,
               l_shipdate + l_linenumber * INTERVAL '1' HOUR + (l_partkey % 3600) * INTERVAL '1' SECOND AS event_time, l_linenumber, l_partkey,
               CASE WHEN l_returnflag = 'A' THEN 'error' WHEN l_returnflag = 'R' THEN 'processing' ELSE 'completed' END AS processing_status,
               CASE WHEN l_returnflag = 'A' THEN concat('failed on part ', l_partkey) END AS error_message
        FROM lineitem""",
    # Spreadsheet cells: one sheet per supplier and line number, 17 columns.
    "cells": """
        SELECT concat('XL_', l_suppkey) AS registry_id, CAST(l_linenumber AS BIGINT) AS sheet_index, l_orderkey + 1 AS row, col,
               CASE col WHEN 1 THEN CAST(l_orderkey AS VARCHAR(20)) WHEN 2 THEN CAST(l_partkey AS VARCHAR(20)) WHEN 3 THEN l_returnflag
                    WHEN 4 THEN l_linestatus WHEN 5 THEN repeat('long text ', l_linenumber * 5) WHEN 6 THEN NULL
                    ELSE concat('c', col, '-', l_partkey) END AS value
        FROM (SELECT l_orderkey, l_suppkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_returnflag) AS l_returnflag,
                     max(l_linestatus) AS l_linestatus, SERIES(1,17) AS col
              FROM lineitem GROUP BY l_orderkey, l_suppkey, l_linenumber) c""",
    "sheets": """
        SELECT concat('XL_', s_suppkey) AS registry_id, sheet_index, concat('Sheet ', sheet_index) AS sheet_name
        FROM (SELECT s_suppkey, SERIES(1,8) AS sheet_index FROM supplier) s""",
    "questions": """
        SELECT item_id AS query_id, text AS query_text FROM benchmark""",
}

# Which views a view reads.
PARENTS = {
    "parsed": ["staged"],
    "classified": ["parsed"],
    "extraction_state": ["extractions"],
}


def chain(*names: str) -> list[str]:
    """The views with everything they read, parents first."""
    out: list[str] = []

    def add(name: str) -> None:
        for parent in PARENTS.get(name, []):
            add(parent)
        if name not in out:
            out.append(name)

    for name in names:
        add(name)
    return out


# How each engine turns a range into rows.
SERIES = {
    "spark": r"explode(sequence(CAST(\1 AS BIGINT), CAST(\2 AS BIGINT)))",
    "duckdb": r"unnest(generate_series(CAST(\1 AS BIGINT), CAST(\2 AS BIGINT)))",
}


def with_clause(*names: str, engine: str = "duckdb") -> str:
    if not names:
        return ""
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in chain(*names))
    return "WITH " + re.sub(r"SERIES\((\d+),(\d+)\)", SERIES[engine], views) + "\n"


# Schemas of the given files, each read once.
_SCHEMAS: dict[str, StructType] = {}


class Data:
    """The given tables and the derived views as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str, spread_texts: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.spread_texts = spread_texts

    def spread(self) -> Data:
        """The same data with small text tables spread over the cores."""
        return Data(self.spark, self.sf_dir, True)

    def _table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        df = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        return spread(df) if self.spread_texts and name in ("documents", "pages") else df

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self._table(name)
        if name in VIEWS:
            return self.sql(f"{with_clause(name, engine='spark')} SELECT * FROM {name}")
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        for table in TABLES:
            if re.search(rf"\b(FROM|JOIN) {table}\b", text):
                self._table(table).createOrReplaceTempView(table)
        return self.spark.sql(text)

    def folder(self, purpose: str) -> str:
        return work_folder(self.spark, purpose)

    def stored(self, df: DataFrame, purpose: str) -> DataFrame:
        """The rows written to the shared folder and read back, as a stage leaves them."""
        path = self.folder(purpose)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
