"""Document text from files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import paths
from ..functions.text import html_to_text
from ..operators.provider import Provider, apply_provider

TEXT_TYPES = ("txt", "html")


def read_texts(spark: SparkSession, files: list[str]) -> DataFrame:
    """Whole text files as ``file_url, content``.

    The metadata spell a path with escapes; it is given back as it was asked for.
    """
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return spark.read.text(files, wholetext=True).select(plain.alias("file_url"), F.col("value").alias("content"))


def read_decoded(spark: SparkSession, files: list[str], decoder: Provider) -> DataFrame:
    """Text of other file types by a user's decoder: ``file_url, content, error_information``."""
    raw = spark.read.format("binaryFile").load(files).select(F.col("path").alias("file_url"), "content")
    decoded = apply_provider(raw, "content", decoder, "text")
    return decoded.select("file_url", F.col("text").alias("content"), F.col("error").alias("error_information"))


def attach_text(routed: DataFrame, text: str = "raw_text") -> DataFrame:
    """Add ``content`` and ``error_information`` to rows that carry their raw text.

    HTML becomes visible text, other text stays; a row without text is marked,
    with the reader's own error where it left one.
    """
    kind = paths.file_type(F.col("relative_path"))
    content = F.when(kind == "html", html_to_text(F.col(text))).otherwise(F.col(text))
    error = F.when(F.col(text).isNull(), "no text could be read")
    if "error_information" in routed.columns:
        error = F.coalesce("error_information", error)
    return routed.withColumns({"content": content, "error_information": error}).drop(text)


def page_texts(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("content", html_to_text(F.col(html))).drop(html)


def evaluation_source(df: DataFrame) -> DataFrame:
    """Lower-case column names with the text under ``ocr_text``.

    ``content_text`` is preferred, then ``parsed_content``; a table with neither
    and without ``ocr_text`` is refused.
    """
    lower = df.toDF(*[c.lower() for c in df.columns])
    if "ocr_text" in lower.columns:
        return lower
    for name in ("content_text", "parsed_content"):
        if name in lower.columns:
            return lower.withColumnRenamed(name, "ocr_text")
    raise ValueError("source table needs a parsed_content or ocr_text column; it has " + ", ".join(lower.columns))
