"""Folder listings as tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.routing import not_in
from .folder_source import FolderListing, can_list

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _relative(base: str):
    """Path below ``base``; the scheme that Spark puts in front is ignored."""
    root = base.rstrip("/").split(":", 1)[-1].lstrip("/")
    return F.regexp_replace(F.col("path"), r"^[A-Za-z0-9]+:/*\Q" + root + r"\E/", "")


def _listing(files: DataFrame, base: str) -> DataFrame:
    return files.select(
        _relative(base).alias("relative_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
        F.col("path").alias("file_url"),
    )


def list_files(spark: SparkSession, base: str) -> DataFrame:
    """One row per file, files of zero bytes included, listed by tasks below the upper folders.  No file is opened.

    A file system that only Spark knows is listed by Spark's own reader, which
    leaves out files of zero bytes.
    """
    if not can_list(base):
        return _listing(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base), base)
    spark.dataSource.register(FolderListing)
    return spark.read.format(FolderListing.name()).load(base)


def stream_files(spark: SparkSession, base: str, max_files: int = 10_000) -> DataFrame:
    """New files as a stream of listing rows; each path is delivered once.

    Spark's file stream leaves out files of zero bytes.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(base)
    )
    return _listing(files, base)


def backlog(listing: DataFrame, processed: DataFrame, processed_path: str) -> DataFrame:
    """Listed files that no table knows yet."""
    return not_in(listing, "relative_path", processed, processed_path)


def removed(listing: DataFrame, processed: DataFrame, processed_path: str) -> DataFrame:
    """Known paths whose file is gone; reported, never acted upon."""
    known = processed.select(F.col(processed_path).alias("relative_path")).filter("relative_path is not null")
    return known.distinct().join(listing.select("relative_path"), "relative_path", "left_anti")
