"""Routing of newly listed files and registration of the ones not yet known."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import paths
from ..schemas import conform

PAGE_LIMIT_PATTERNS = ("%500 pages%", "%Maximum number of%pages exceeded%")


def new_files(listing: DataFrame) -> DataFrame:
    """Rows with a usable path."""
    return listing.filter(F.col("relative_path").isNotNull() & (F.col("relative_path") != ""))


def route(path: Column, size: Column) -> Column:
    """Where a file goes; every file has exactly one route."""
    large = size > paths.LARGE_FILE_BYTES
    return (
        F.when(large & paths.is_large_type(path), "large")
        .when(~large & paths.is_parse_type(path), "parse")
        .when(paths.is_spreadsheet(path), "spreadsheet")
        .when(paths.is_csv(path), "csv")
        .otherwise("rejected")
    )


def reject_reason(path: Column, size: Column) -> Column:
    return (
        F.when(paths.is_parse_type(path), "too large for its type")
        .when(paths.has_extension(path, paths.SPREADSHEET_EXTENSIONS), "already converted")
        .otherwise("unsupported type")
    )


def route_files(listing: DataFrame) -> DataFrame:
    """One pass over the captured batch that labels each file with its route."""
    return new_files(listing).withColumn("route", route(F.col("relative_path"), F.col("size")))


def rejected_files(routed: DataFrame) -> DataFrame:
    path, size = F.col("relative_path"), F.col("size")
    return routed.filter(F.col("route") == "rejected").select(
        path.alias("file_path"), size.alias("file_size"), reject_reason(path, size).alias("reason")
    )


def not_in(df: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """Anti join on distinct non-null keys.

    A null in ``known`` cannot empty the result, and a key that ``known`` holds
    very often reaches the join once.
    """
    keys = known.select(F.col(known_column).alias(column)).filter(F.col(column).isNotNull()).distinct()
    return df.join(keys, column, "left_anti")


def first_per_path(df: DataFrame, column: str = "relative_path") -> DataFrame:
    return df.dropDuplicates([column])


def register_large(routed: DataFrame, registry: DataFrame, parsed: DataFrame, as_of: datetime) -> DataFrame:
    """New rows of the large-file registry, without files already known or parsed."""
    fresh = first_per_path(routed.filter(F.col("route") == "large"))
    fresh = not_in(fresh, "relative_path", registry, "original_file_path")
    fresh = not_in(fresh, "relative_path", parsed, "file_path")
    path = F.col("relative_path")
    return conform(
        fresh.select(
            paths.registry_id("REG", path, as_of).alias("registry_id"),
            path.alias("original_file_path"),
            paths.base_name(path).alias("original_file_name"),
            F.col("size").alias("original_file_size"),
            F.lit(True).alias("split_required"),
            F.lit(0).alias("split_count"),
            F.lit("pending").alias("split_status"),
            F.lit(as_of).alias("created_timestamp"),
        ),
        "large_document_registry",
    )


def register_spreadsheets(routed: DataFrame, registry: DataFrame, as_of: datetime) -> DataFrame:
    fresh = first_per_path(routed.filter(F.col("route") == "spreadsheet"))
    fresh = not_in(fresh, "relative_path", registry, "original_file_path")
    path = F.col("relative_path")
    return conform(
        fresh.select(
            paths.registry_id("EXCEL", path, as_of).alias("registry_id"),
            path.alias("original_file_path"),
            paths.base_name(path).alias("original_file_name"),
            F.col("size").alias("original_file_size"),
            F.lit("pending").alias("conversion_status"),
            F.lit(as_of).alias("created_timestamp"),
        ),
        "excel_document_registry",
    )


def register_csv(routed: DataFrame, registry: DataFrame, as_of: datetime) -> DataFrame:
    fresh = first_per_path(routed.filter(F.col("route") == "csv"))
    fresh = not_in(fresh, "relative_path", registry, "file_path")
    path = F.col("relative_path")
    return conform(
        fresh.select(
            paths.registry_id("CSV", path, as_of).alias("registry_id"),
            path.alias("file_path"),
            paths.base_name(path).alias("file_name"),
            F.col("size").alias("file_size"),
            F.lit("pending").alias("processing_status"),
            F.lit(as_of).alias("created_timestamp"),
        ),
        "csv_file_registry",
    )


def hit_page_limit(error: Column) -> Column:
    return F.coalesce(error.like(PAGE_LIMIT_PATTERNS[0]) | error.like(PAGE_LIMIT_PATTERNS[1]), F.lit(False))


def register_page_limit(parsed: DataFrame, registry: DataFrame, as_of: datetime) -> DataFrame:
    """Documents whose parse failed on the page limit, once each.

    ``parsed`` needs an ``error_information`` column.
    """
    failed = first_per_path(parsed.filter(hit_page_limit(F.col("error_information"))), "file_path")
    failed = not_in(failed, "file_path", registry, "original_file_path")
    path = F.col("file_path")
    return conform(
        failed.select(
            paths.registry_id("REG", path, as_of).alias("registry_id"),
            path.alias("original_file_path"),
            F.col("file_name").alias("original_file_name"),
            F.col("file_size").alias("original_file_size"),
            F.lit(True).alias("split_required"),
            F.lit(0).alias("split_count"),
            F.lit("pending_page_limit").alias("split_status"),
            F.lit(as_of).alias("created_timestamp"),
        ),
        "large_document_registry",
    )


def unparsed(routed: DataFrame, parsed: DataFrame, registry: DataFrame) -> DataFrame:
    """Files on the parse route that neither table knows.

    Only paths are compared with what is stored; the rows themselves, which may
    carry texts, meet the batch's own fresh paths.
    """
    todo = routed.filter(F.col("route") == "parse")
    fresh = not_in(todo.select("relative_path"), "relative_path", parsed, "file_path")
    fresh = not_in(fresh, "relative_path", registry, "original_file_path")
    return todo.join(fresh, "relative_path", "left_semi")


def ingest_documents(routed: DataFrame, parsed: DataFrame, registry: DataFrame, as_of: datetime) -> DataFrame:
    """New rows of ``parsed_documents`` for the files on the parse route.

    ``routed`` carries ``content`` and ``error_information`` from the text
    reader.  A listing names each file once, so the text rows are not shuffled
    for de-duplication; a bad file only marks its own row.
    """
    return parsed_rows(unparsed(routed, parsed, registry), as_of)


def parsed_rows(fresh: DataFrame, as_of: datetime) -> DataFrame:
    """Rows of ``parsed_documents`` for files that are known to be new."""
    path = F.col("relative_path")
    return conform(
        fresh.select(
            paths.document_id(path, as_of).alias("document_id"),
            paths.base_name(path).alias("file_name"),
            path.alias("file_path"),
            F.col("size").alias("file_size"),
            F.col("file_url"),
            paths.file_type(path).alias("document_type"),
            parse_result(F.col("content"), F.col("error_information")).alias("parsed_content"),
            F.col("content").alias("content_text"),
            paths.is_split_part(path).alias("is_split_part"),
            F.lit(as_of).alias("parse_timestamp"),
            F.when(F.col("error_information").isNull(), "parsed").otherwise("parse_error").alias("status"),
        ),
        "parsed_documents",
    )


def parse_result(content: Column, error: Column) -> Column:
    """Parse outcome as one JSON object: content, or what went wrong."""
    return F.to_json(F.struct(content.alias("content"), error.alias("errorInformation")))
