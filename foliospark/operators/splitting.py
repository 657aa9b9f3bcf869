"""Splitting of large documents by page ranges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.paths import SPLIT_FOLDER, member_id, part_file_name
from ..functions.jsontext import path_value
from ..schemas import conform
from ..session import work_folder

# Part limits and the states a split may start from.
PAGES_PER_PART = 200
PART_BYTES = 90 * 1024 * 1024
PENDING_STATES = ("pending", "pending_split", "pending_page_limit", "requires_external_processing")


def pending_splits(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("split_status").isin(*PENDING_STATES) & F.col("split_required"))


def plan_splits(documents: DataFrame, pages_per_part: int = PAGES_PER_PART, part_bytes: int = PART_BYTES) -> DataFrame:
    """Add ``split_status`` and ``split_count`` from page count and size.

    A file over the size limit that has too few pages to divide is unsplittable:
    a single part would be the same file again.
    """
    pages, size = F.col("page_count"), F.col("original_file_size")
    return documents.withColumns(
        {
            "split_status": F.when((pages <= pages_per_part) & (size <= part_bytes), "no_split_needed")
            .when(pages <= pages_per_part, "unsplittable")
            .otherwise("split_complete"),
            "split_count": F.when(pages > pages_per_part, F.ceil(pages / F.lit(pages_per_part)))
            .otherwise(F.lit(0))
            .cast("bigint"),
        }
    )


def part_rows(planned: DataFrame, as_of: datetime, pages_per_part: int = PAGES_PER_PART) -> DataFrame:
    """Rows of ``document_split_parts``; sizes are shared out by pages."""
    number, total = F.col("part_number"), F.col("split_count")
    first = (number - 1) * pages_per_part + 1
    last = F.least(number * pages_per_part, F.col("page_count"))
    parts = planned.filter(F.col("split_count") > 0).select("*", F.explode(F.sequence(F.lit(1), total)).alias("part_number"))
    return conform(
        parts.select(
            member_id(F.col("registry_id"), "PART", number).alias("part_id"),
            "registry_id",
            "original_file_path",
            "part_number",
            total.alias("total_parts"),
            F.concat(F.lit(SPLIT_FOLDER), part_file_name(F.col("original_file_name"), number, total)).alias("part_stage_path"),
            F.floor(F.col("original_file_size") * (last - first + 1) / F.col("page_count")).alias("part_size"),
            first.alias("page_start"),
            last.alias("page_end"),
            F.lit("uploaded").alias("status"),
            F.lit(as_of).alias("created_timestamp"),
        ),
        "document_split_parts",
    )


def split_pages(pages: DataFrame, key: str, pages_per_part: int = PAGES_PER_PART, separator: str = "") -> DataFrame:
    """Part texts from a page table (``key, page_number, page_text``).

    Pages of one part are gathered, never those of a whole document, so a very
    long document is spread over many groups.
    """
    part = F.floor((F.col("page_number") - 1) / F.lit(pages_per_part)).cast("bigint") + 1
    ordered = F.array_sort(F.collect_list(F.struct("page_number", "page_text")))
    return (
        pages.groupBy(key, part.alias("part_number"))
        .agg(
            F.min("page_number").alias("page_start"),
            F.max("page_number").alias("page_end"),
            F.array_join(F.transform(ordered, lambda p: p["page_text"]), separator).alias("part_text"),
        )
    )


def part_content(parsed_content):
    """Text inside a stored parse result."""
    return path_value(parsed_content, "$.content")


def good_parts(parts: DataFrame, parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Parts with their text, one row each, without failed parts.

    A failed part has an ``errorInformation`` field; ``strict`` drops a part
    whenever that word occurs anywhere in the stored result.
    """
    if strict:
        good = ~F.col("parsed_content").ilike("%errorInformation%")
    else:
        good = path_value(F.col("parsed_content"), "$.errorInformation").isNull()
    texts = parsed.filter(good).select(
        F.col("file_path").alias("part_stage_path"), part_content(F.col("parsed_content")).alias("part_text")
    )
    return parts.join(texts, "part_stage_path").select("original_file_path", "registry_id", "part_number", "part_text")


def merged_parts(parts: DataFrame, parsed: DataFrame, strict: bool = False) -> DataFrame:
    """The text of every document as ordered rows: ``part_number`` gives the order, ``total_parts`` the number of rows.

    Only numbers are counted by document and joined back; no document is gathered,
    however many parts it has.  The good parts are stored, as both the count and the
    rows need them, and they may cost joins to make.
    """
    good = good_parts(parts, parsed, strict)
    path = work_folder(good.sparkSession, "good-parts")
    good.write.parquet(path)
    good = good.sparkSession.read.schema(good.schema).parquet(path)
    keys = ["original_file_path", "registry_id"]
    counts = good.groupBy(*keys).agg(F.count("*").alias("total_parts"))
    return good.join(counts, keys)


def merged_documents(parts: DataFrame, parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Part texts put together again in part order as one string a document, without failed parts.

    A string must fit into one task; ``merged_parts`` has no such bound.
    """
    ordered = F.array_sort(F.collect_list(F.struct("part_number", F.col("part_text").alias("text"))))
    return (
        good_parts(parts, parsed, strict)
        .groupBy("original_file_path", "registry_id")
        .agg(F.count("*").alias("total_parts"), F.array_join(F.transform(ordered, lambda p: p["text"]), " ").alias("merged_content"))
    )


def link_parts(parsed: DataFrame, parts: DataFrame) -> DataFrame:
    """Fill registry id and part number of parsed rows that are split parts."""
    known = parts.select(
        F.col("part_stage_path").alias("file_path"),
        F.col("registry_id").alias("_registry"),
        F.col("part_number").alias("_number"),
    )
    return (
        parsed.join(known, "file_path", "left")
        .withColumns(
            {
                "parent_registry_id": F.coalesce("_registry", "parent_registry_id"),
                "part_number": F.coalesce("_number", "part_number"),
            }
        )
        .drop("_registry", "_number")
    )
