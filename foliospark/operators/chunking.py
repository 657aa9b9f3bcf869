"""Overlapping text chunks.

Chunk ``i`` looks at the characters ``[i*step, i*step + size)`` with
``step = size - overlap``.  ``stride`` mode takes that window as it is;
``packed`` mode drops a word that is cut at either edge, because the
neighbouring window holds it whole.  A word longer than the overlap is cut at
the edge, as no window pair could share it.  Both modes work inside the
document's row: no word is exploded, sorted or shuffled.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.jsontext import unwrap_label
from ..functions.paths import member_id
from ..schemas import conform
from .routing import not_in

SIZE = 1000
OVERLAP = 200
MIN_DOCUMENT = 100
MIN_CHUNK = 50
# Windows per block.  Cutting the text into blocks first keeps the work linear:
# a substring call on a long text walks from its beginning every time.
WINDOWS_PER_BLOCK = 64


def window_count(length: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    step = size - overlap
    return F.greatest(F.lit(0), F.ceil((length - size) / F.lit(step))).cast("int") + 1


def text_blocks(df: DataFrame, text: str, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """One row per block of ``WINDOWS_PER_BLOCK`` windows; nearly every document is one block.

    Adds ``_body`` (the block and the characters its last window reaches into the
    next one), ``_edge`` (the character before the block) and ``_first`` and
    ``_last`` (window numbers).
    """
    block = (size - overlap) * WINDOWS_PER_BLOCK
    kept = [c for c in df.columns if c != text]
    cut = df.select(
        *kept,
        window_count(F.length(text), size, overlap).alias("_total"),
        F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{block}}}"), F.lit(0)).alias("_blocks"),
    )
    blocks = F.col("_blocks")
    # Array functions count from 1, so element i + 2 follows the block at position i.
    parts = F.transform(
        blocks,
        lambda b, i: F.struct(
            F.concat(b, F.coalesce(F.substring(F.try_element_at(blocks, i + 2), 1, overlap + 1), F.lit(""))).alias("body"),
            F.when(i == 0, F.lit("")).otherwise(F.right(F.element_at(blocks, F.greatest(i, F.lit(1))), F.lit(1))).alias("edge"),
        ),
    )
    first = F.col("_block") * WINDOWS_PER_BLOCK
    return (
        cut.select(*kept, "_total", F.posexplode(parts).alias("_block", "_part"))
        .filter(first < F.col("_total"))
        .select(
            *kept,
            F.col("_part.body").alias("_body"),
            F.col("_part.edge").alias("_edge"),
            first.alias("_first"),
            (F.least(first + WINDOWS_PER_BLOCK, F.col("_total")) - 1).alias("_last"),
        )
    )


def block_chunks(mode: str, size: int, overlap: int, min_chunk: int) -> Column:
    """Array of (chunk_index, chunk_text) of one block, short chunks left out.

    The steps are nested array functions, so each is evaluated once per window.
    """
    step = size - overlap
    body = F.col("_body")

    def window(n: Column) -> Column:
        offset = (n - F.col("_first")) * step
        return F.struct(
            n.alias("n"),
            F.substring(body, offset + 1, F.lit(size)).alias("text"),
            F.when(offset > 0, F.substring(body, offset, F.lit(1))).otherwise(F.col("_edge")).alias("before"),
            F.substring(body, offset + size + 1, F.lit(1)).alias("after"),
        )

    def left_cut(w: Column) -> Column:
        whole = (w["before"] == "") | (w["before"].rlike(r"\s") & w["text"].rlike(r"^\S"))
        head = F.regexp_extract(F.substring(w["text"], 1, overlap + 1), r"^\S*\s*", 0)
        return F.struct(w["n"], w["text"], w["after"], F.when(whole, 0).otherwise(F.length(head)).alias("cut"))

    def trim_left(w: Column) -> Column:
        text = F.when(w["cut"] > overlap, w["text"]).otherwise(F.substring(w["text"], w["cut"] + 1, F.lit(size)))
        return F.struct(w["n"], text.alias("text"), w["after"])

    def right_cut(w: Column) -> Column:
        whole = (w["after"] == "") | (w["after"].rlike(r"\S") & w["text"].rlike(r"\s$"))
        tail = F.regexp_extract(F.right(w["text"], F.lit(overlap + 1)), r"\S*\s*$", 0)
        return F.struct(w["n"], w["text"], F.when(whole, 0).otherwise(F.length(tail)).alias("cut"))

    def trim_right(w: Column) -> Column:
        text = F.when(w["cut"] > overlap, w["text"]).otherwise(F.left(w["text"], F.length(w["text"]) - w["cut"]))
        return F.struct(w["n"].alias("chunk_index"), text.alias("chunk_text"))

    windows = F.transform(F.sequence(F.col("_first"), F.col("_last")), window)
    if mode == "packed":
        chunks = F.transform(F.transform(F.transform(F.transform(windows, left_cut), trim_left), right_cut), trim_right)
    elif mode == "stride":
        chunks = F.transform(windows, lambda w: F.struct(w["n"].alias("chunk_index"), w["text"].alias("chunk_text")))
    else:
        raise ValueError(f"unknown chunk mode: {mode}")
    return F.filter(chunks, lambda c: F.length(F.trim(c["chunk_text"])) > min_chunk)


def chunk_texts(
    df: DataFrame, text: str, mode: str = "packed", size: int = SIZE, overlap: int = OVERLAP, min_chunk: int = MIN_CHUNK
) -> DataFrame:
    """Chunks of each row's text; numbers are kept from before the short-chunk filter."""
    kept = [c for c in df.columns if c != text]
    chunks = block_chunks(mode, size, overlap, min_chunk)
    return text_blocks(df, text, size, overlap).select(*kept, F.inline(chunks))


def chunkable(parsed: DataFrame) -> DataFrame:
    """Documents without parse error whose trimmed text exceeds 100 characters."""
    return parsed.filter(
        F.col("content_text").isNotNull()
        & (F.length(F.trim("content_text")) > MIN_DOCUMENT)
        & (F.col("status") != "parse_error")
    )


def pending_chunking(parsed: DataFrame, chunks: DataFrame) -> DataFrame:
    """Chunkable documents that have no chunks yet."""
    return not_in(chunkable(parsed), "document_id", chunks, "document_id")


def chunk_documents(
    parsed: DataFrame, classified: DataFrame, chunks: DataFrame, as_of: datetime, mode: str = "packed"
) -> DataFrame:
    """New chunk rows, with the class where the document has one."""
    todo = pending_chunking(parsed, chunks).select("document_id", "file_name", "file_path", "content_text")
    classes = classified.select("document_id", unwrap_label(F.col("document_class")).alias("document_class"))
    cut = chunk_texts(
        todo.join(classes, "document_id", "left").withColumn(
            "document_class", F.coalesce("document_class", F.lit("unclassified"))
        ),
        "content_text",
        mode,
    )
    return conform(
        cut.withColumns(
            {
                "chunk_id": member_id(F.col("document_id"), "CHUNK", F.col("chunk_index")),
                "chunk_size": F.length("chunk_text"),
                "created_timestamp": F.lit(as_of),
            }
        ),
        "document_chunks",
    )
