"""Table schemas and typed empty tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from . import seeds

# Columns of the stored tables.
TABLES = {
    "parsed_documents": """document_id string, file_name string, file_path string, file_size bigint,
        file_url string, document_type string, parsed_content string, content_text string,
        is_split_part boolean, parent_registry_id string, part_number bigint, parse_timestamp timestamp,
        status string""",
    "document_classifications": """document_id string, file_name string, file_path string, file_size bigint,
        file_url string, document_type string, parsed_content string, document_class string,
        classification_confidence double, classification_timestamp timestamp""",
    "document_extractions": """document_id string, file_name string, file_path string, document_class string,
        attribute_name string, attribute_value string, confidence_score double, extraction_json string,
        extraction_timestamp timestamp""",
    "extraction_prompts": "document_class string, attribute_name string, question_text string",
    "document_chunks": """chunk_id string, document_id string, file_name string, file_path string,
        document_class string, chunk_index int, chunk_text string, chunk_size int, created_timestamp timestamp""",
    "large_document_registry": """registry_id string, original_file_path string, original_file_name string,
        original_file_size bigint, estimated_pages bigint, split_required boolean, split_count bigint,
        split_status string, error_message string, created_timestamp timestamp, processed_timestamp timestamp""",
    "document_split_parts": """part_id string, registry_id string, original_file_path string, part_number bigint,
        total_parts bigint, part_stage_path string, part_size bigint, page_start bigint, page_end bigint,
        status string, created_timestamp timestamp""",
    "csv_file_registry": """registry_id string, file_path string, file_name string, file_size bigint,
        target_table_name string, column_count bigint, row_count bigint, inferred_schema string,
        processing_status string, error_message string, created_timestamp timestamp,
        processed_timestamp timestamp""",
    "csv_data_master": """record_id string, registry_id string, file_path string, file_name string,
        row_number bigint, row_data string, created_timestamp timestamp""",
    "csv_column_metadata": """metadata_id string, registry_id string, column_name string, column_type string,
        column_order bigint, nullable boolean, created_timestamp timestamp""",
    "excel_document_registry": """registry_id string, original_file_path string, original_file_name string,
        original_file_size bigint, sheet_count bigint, conversion_status string, converted_pdf_path string,
        error_message string, created_timestamp timestamp, processed_timestamp timestamp""",
    "excel_sheet_metadata": """sheet_id string, registry_id string, sheet_name string, sheet_index bigint,
        row_count bigint, column_count bigint, has_data boolean, created_timestamp timestamp""",
    "ocr_accuracy": """document_id string, ocr_text string, ocr_accuracy_score double,
        ocr_accuracy_reasoning string, ocr_completeness_score double, ocr_completeness_reasoning string,
        app_name string, app_version string, run_name string, source_table string,
        evaluation_timestamp timestamp""",
    "split_events": """registry_id string, split_status string, split_count bigint, estimated_pages bigint,
        error_message string, event_time timestamp""",
    "csv_events": """registry_id string, processing_status string, target_table_name string, column_count bigint,
        row_count bigint, inferred_schema string, error_message string, event_time timestamp""",
    "conversion_events": """registry_id string, conversion_status string, sheet_count bigint,
        converted_pdf_path string, error_message string, event_time timestamp""",
    "run_metrics": """stream_count bigint, processed_count bigint, large_count bigint, failed_parse_count bigint,
        spreadsheet_count bigint, csv_count bigint, rejected_count bigint""",
    "rejected_files": "file_path string, file_size bigint, reason string",
}

# Tables a reset empties, children before parents.
RESET_ORDER = (
    "document_chunks",
    "document_extractions",
    "document_classifications",
    "document_split_parts",
    "large_document_registry",
    "parsed_documents",
)


def columns_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A table without rows that the optimizer knows to be empty."""
    nothing = spark.range(1).filter(F.lit(False))
    return nothing.select(*[_null(f) for f in columns_of(table).fields])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the table's columns by name; missing ones become typed nulls."""
    have = set(df.columns)
    return df.select(
        *[
            df[f.name].cast(f.dataType).alias(f.name) if f.name in have else _null(f)
            for f in columns_of(table).fields
        ]
    )


def _null(field: T.StructField) -> Column:
    return F.lit(None).cast(field.dataType).alias(field.name)


def extraction_prompts(spark: SparkSession) -> DataFrame:
    """The seeded questions as one literal, whose size the optimizer knows."""
    names = columns_of("extraction_prompts").fieldNames()
    rows = json.dumps([dict(zip(names, row)) for row in seeds.QUESTIONS])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), f"array<struct<{_fields('extraction_prompts')}>>")))


def _fields(table: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in columns_of(table).fields)
