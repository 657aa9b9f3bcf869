"""Status, analytics and detail reports over the stored tables.

Reports come unsorted unless a limit makes the order part of the result.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.jsontext import explode_json, path_value, unwrap_label
from ..functions.scores import confidence_band, is_low_confidence
from ..functions.text import size_in
from ..operators.extract import flatten_attributes

KB = 1024
MB = 1048576


def keep_all_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join that survives one key holding a large share of ``right``.

    A left outer join cannot split a skewed right side.  The matched rows are an
    inner join, which can; the unmatched ones are added behind it, found with
    one row per key of ``right``.
    """
    matched = right.join(left, key)
    alone = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


# --- documents ------------------------------------------------------------


def processing_summary(classified: DataFrame, extractions: DataFrame, strict: bool = False) -> DataFrame:
    """One row per document and attribute; documents without attributes stay."""
    documents = classified.select(
        "document_id",
        "file_name",
        "file_path",
        "document_type",
        unwrap_label(F.col("document_class")).alias("document_classification"),
        "classification_timestamp",
    )
    attributes = flatten_attributes(extractions, strict).select(
        "document_id", "attribute_name", "attribute_value", "confidence_score", "extraction_timestamp"
    )
    return keep_all_left(documents, attributes, "document_id").select(
        "document_id",
        "file_name",
        "file_path",
        "document_type",
        "document_classification",
        "attribute_name",
        "attribute_value",
        "confidence_score",
        "classification_timestamp",
        "extraction_timestamp",
    )


def summary_metrics(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count_distinct("document_id").alias("total_documents"),
        F.count_distinct("document_classification").alias("unique_classifications"),
        F.count_distinct("attribute_name").alias("unique_attributes"),
        F.count("*").alias("total_rows"),
    )


def processing_stats(parsed: DataFrame, extractions: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row of counts over the three tables."""
    status = F.col("status")
    documents = parsed.agg(
        F.count("*").alias("total_documents"),
        F.count_if(status == "parsed").alias("parsed_count"),
        F.count_if(status == "classified").alias("classified_count"),
        F.count_if(status == "classification_error").alias("error_count"),
    )
    extracted = extractions.agg(F.count_distinct("document_id").alias("n"))
    cut = chunks.agg(F.count("*").alias("n"), F.count_distinct("document_id").alias("d"))
    return documents.withColumns(
        {
            "extracted_count": extracted.scalar(),
            "total_chunks": cut.select("n").scalar(),
            "chunked_documents": cut.select("d").scalar(),
        }
    )


def status_bars(stats: DataFrame) -> DataFrame:
    """The counts of ``processing_stats`` as rows for a bar chart."""
    bars = {
        "Parsed": "parsed_count",
        "Classified": "classified_count",
        "Extracted": "extracted_count",
        "Chunked": "chunked_documents",
        "Errors": "error_count",
    }
    entries = F.array(*[F.struct(F.lit(k).alias("status"), F.col(v).alias("count")) for k, v in bars.items()])
    return stats.select(F.explode(entries).alias("e")).select("e.*")


def success_rates(stats: DataFrame) -> DataFrame:
    total, good, bad = F.col("total_documents"), F.col("classified_count"), F.col("error_count")
    return stats.select(
        good.alias("success"),
        bad.alias("errors"),
        (total - good - bad).alias("pending"),
        F.round(F.try_divide(good * 100, total), 2).alias("success_rate"),
        F.round(F.try_divide(bad * 100, total), 2).alias("error_rate"),
    )


def is_valid_class(name: Column) -> Column:
    """Stored class that is not an error marker; the underscore matches any character."""
    return ~name.like("ERR_%") & (name != "classification_error")


def class_counts(classified: DataFrame) -> DataFrame:
    return (
        classified.filter(is_valid_class(F.col("document_class")))
        .groupBy(unwrap_label(F.col("document_class")).alias("document_class"))
        .agg(F.count("*").alias("count"))
    )


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def recent_documents(classified: DataFrame, parsed: DataFrame, limit: int = 10) -> DataFrame:
    """Latest classified documents; text columns are not carried through the join."""
    joined = classified.join(parsed.select("document_id", "status"), "document_id").select(
        "document_id",
        "file_name",
        "file_path",
        unwrap_label(F.col("document_class")).alias("document_class"),
        "classification_timestamp",
        "status",
        "document_type",
    )
    return joined.orderBy(F.desc("classification_timestamp"), "document_id").limit(limit)


def document_info(classified: DataFrame, parsed: DataFrame, document: str) -> DataFrame:
    one = F.col("document_id") == document
    return (
        classified.filter(one)
        .join(parsed.filter(one).select("document_id", "content_text", "status"), "document_id")
        .select(
            "document_id",
            "file_name",
            "file_path",
            "file_size",
            "document_type",
            unwrap_label(F.col("document_class")).alias("document_class"),
            "classification_timestamp",
            "content_text",
            "status",
        )
    )


def document_attributes(extractions: DataFrame, document: str, threshold: float = 0.5) -> DataFrame:
    score = F.col("confidence_score")
    return (
        extractions.filter(F.col("document_id") == document)
        .select(
            "attribute_name",
            "attribute_value",
            "confidence_score",
            is_low_confidence(score, threshold).alias("is_low"),
            confidence_band(score, threshold).alias("band"),
            "extraction_timestamp",
        )
        .orderBy("attribute_name")
    )


def document_chunks(chunks: DataFrame, document: str, limit: int | None = None) -> DataFrame:
    found = (
        chunks.filter(F.col("document_id") == document).select("chunk_index", "chunk_text", "chunk_size").orderBy("chunk_index")
    )
    return found if limit is None else found.limit(limit)


# --- stages ---------------------------------------------------------------


def stage_status(
    stream: DataFrame,
    parsed: DataFrame,
    classified: DataFrame,
    extractions: DataFrame,
    chunks: DataFrame,
    large: DataFrame,
    csv_files: DataFrame,
    spreadsheets: DataFrame,
) -> DataFrame:
    """Counts of all eight stages by status."""

    def whole(stage: str, df: DataFrame, status: str | None, count: Column) -> DataFrame:
        return df.agg(count.alias("count")).select(
            F.lit(stage).alias("stage"), "count", F.lit(status).cast("string").alias("status")
        )

    def by_status(stage: str, df: DataFrame, status: Column) -> DataFrame:
        grouped = df.groupBy(status.alias("status")).agg(F.count("*").alias("count"))
        return grouped.select(F.lit(stage).alias("stage"), "count", "status")

    rows = F.count("*")
    return (
        whole("Stream", stream, None, rows)
        .unionByName(by_status("Parsed Documents", parsed, F.col("status")))
        .unionByName(by_status("Classifications", classified, unwrap_label(F.col("document_class"))))
        .unionByName(whole("Extractions", extractions, "extracted", F.count_distinct("document_id")))
        .unionByName(whole("Chunks", chunks, "chunked", rows))
        .unionByName(by_status("Large Documents", large, F.col("split_status")))
        .unionByName(by_status("CSV Files", csv_files, F.col("processing_status")))
        .unionByName(by_status("Excel Conversions", spreadsheets, F.col("conversion_status")))
    )


def large_document_status(registry: DataFrame, parts: DataFrame) -> DataFrame:
    """Registry rows with their part counts; parts are counted before the join."""
    counted = parts.groupBy("registry_id").agg(
        F.count("part_id").alias("parts_created"), F.count_if(F.col("status") == "processed").alias("parts_processed")
    )
    return registry.join(counted, "registry_id", "left").select(
        "registry_id",
        "original_file_path",
        "original_file_name",
        "original_file_size",
        size_in(F.col("original_file_size"), MB).alias("size_mb"),
        "estimated_pages",
        "split_required",
        "split_count",
        "split_status",
        "created_timestamp",
        "processed_timestamp",
        F.coalesce("parts_created", F.lit(0)).alias("parts_created"),
        F.coalesce("parts_processed", F.lit(0)).alias("parts_processed"),
    )


def conversion_status(registry: DataFrame, sheets: DataFrame) -> DataFrame:
    counted = sheets.groupBy("registry_id").agg(F.count("sheet_id").alias("sheets_recorded"))
    return registry.join(counted, "registry_id", "left").select(
        "registry_id",
        "original_file_path",
        "original_file_name",
        "original_file_size",
        size_in(F.col("original_file_size"), MB).alias("size_mb"),
        "sheet_count",
        "conversion_status",
        "converted_pdf_path",
        "error_message",
        "created_timestamp",
        "processed_timestamp",
        F.coalesce("sheets_recorded", F.lit(0)).alias("sheets_recorded"),
    )


def error_free_parts(parts: DataFrame, parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Original path and stored result of every part that parsed well."""
    if strict:
        good = ~F.col("parsed_content").ilike("%errorInformation%")
    else:
        good = path_value(F.col("parsed_content"), "$.errorInformation").isNull()
    contents = parsed.filter(good).select(F.col("file_path").alias("part_stage_path"), "parsed_content")
    return parts.join(contents, "part_stage_path").select("original_file_path", "parsed_content")


def registry_with_parts(registry: DataFrame, parts: DataFrame) -> DataFrame:
    own = parts.select("registry_id", "part_id", "part_number", "part_stage_path", F.col("status").alias("part_status"))
    return keep_all_left(registry, own, "registry_id")


# --- CSV ------------------------------------------------------------------


def csv_status(registry: DataFrame) -> DataFrame:
    return registry.select(
        "registry_id",
        "file_path",
        "file_name",
        "file_size",
        size_in(F.col("file_size"), KB).alias("size_kb"),
        "target_table_name",
        "column_count",
        "row_count",
        "processing_status",
        "error_message",
        "created_timestamp",
        "processed_timestamp",
        "inferred_schema",
    )


def csv_schema_details(registry: DataFrame, metadata: DataFrame) -> DataFrame:
    return registry.join(metadata, "registry_id").select(
        "file_name", "target_table_name", "column_name", "column_type", "column_order", "nullable", "processing_status"
    )


def csv_flattened(master: DataFrame) -> DataFrame:
    """One row per cell of the long table."""
    cells = explode_json(master, "row_data", key="column_name", value="column_value")
    return cells.select("record_id", "file_name", "file_path", "row_number", "column_name", "column_value", "created_timestamp")


# --- analytics ------------------------------------------------------------


def timeline(classified: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Documents per day over the last days; the filter is on the plain column."""
    start = as_of - timedelta(days=days)
    return (
        classified.filter(F.col("classification_timestamp") >= F.lit(start).cast("timestamp"))
        .groupBy(F.to_date("classification_timestamp").alias("process_date"))
        .agg(F.count("*").alias("documents_processed"))
    )


def top_attributes(extractions: DataFrame, limit: int = 20) -> DataFrame:
    return (
        extractions.groupBy("attribute_name")
        .agg(F.count("*").alias("extraction_count"), F.count_distinct("document_id").alias("unique_documents"))
        .orderBy(F.desc("extraction_count"), "attribute_name")
        .limit(limit)
    )


def attribute_counts(summary: DataFrame, limit: int = 10) -> DataFrame:
    return (
        summary.filter(F.col("attribute_name").isNotNull())
        .groupBy("attribute_name")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "attribute_name")
        .limit(limit)
    )


def summary_page(summary: DataFrame, limit: int = 500) -> DataFrame:
    """First rows of the summary in document and attribute order."""
    return summary.orderBy("document_id", "attribute_name", "attribute_value", "confidence_score").limit(limit)
