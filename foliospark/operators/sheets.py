"""Spreadsheets as a long table of cells: ``registry_id, sheet_index, row, col, value``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.paths import CONVERTED_FOLDER, member_id, strip_extension
from ..functions.text import clip_cell
from ..schemas import conform

# What a rendered sheet shows at most.
MAX_ROWS = 500
MAX_COLUMNS = 15
CELL_LENGTH = 100
# About so many bytes make a part of a workbook's whole text.
PART_BYTES = 1 << 20


def sheet_metadata(sheets: DataFrame, cells: DataFrame, as_of: datetime) -> DataFrame:
    """Rows, columns and a data flag per sheet; a sheet without cells has none."""
    extent = cells.groupBy("registry_id", "sheet_index").agg(
        F.max("row").alias("row_count"), F.max("col").alias("column_count")
    )
    measured = sheets.join(extent, ["registry_id", "sheet_index"], "left")
    rows, cols = F.coalesce("row_count", F.lit(0)), F.coalesce("column_count", F.lit(0))
    return conform(
        measured.select(
            member_id(F.col("registry_id"), "SHEET", F.col("sheet_index")).alias("sheet_id"),
            "registry_id",
            "sheet_name",
            "sheet_index",
            rows.alias("row_count"),
            cols.alias("column_count"),
            ((rows > 0) & (cols > 0)).alias("has_data"),
            F.lit(as_of).alias("created_timestamp"),
        ),
        "excel_sheet_metadata",
    )


def sheet_previews(
    metadata: DataFrame, cells: DataFrame, max_rows: int = MAX_ROWS, max_cols: int = MAX_COLUMNS, clip: int = CELL_LENGTH
) -> DataFrame:
    """Text rendition of each sheet: title, size, notes and the visible grid.

    Cells outside the visible area are dropped before anything is grouped, so a
    group never holds more than ``max_rows * max_cols`` cells.
    """
    seen = cells.filter((F.col("row") <= max_rows) & (F.col("col") <= max_cols))
    one_cell = [F.max(F.when(F.col("col") == c, clip_cell(F.col("value"), clip))).alias(f"_c{c}") for c in range(1, max_cols + 1)]
    lines = seen.groupBy("registry_id", "sheet_index", "row").agg(*one_cell)
    grids = lines.groupBy("registry_id", "sheet_index").agg(
        F.array_sort(
            F.collect_list(F.struct("row", F.array(*[F.coalesce(f"_c{c}", F.lit("")) for c in range(1, max_cols + 1)]).alias("cells")))
        ).alias("_rows")
    )
    df = metadata.join(grids, ["registry_id", "sheet_index"], "left")
    shown_rows = F.least(F.col("row_count"), F.lit(max_rows)).cast("int")
    shown_cols = F.least(F.col("column_count"), F.lit(max_cols)).cast("int")
    blank = F.concat(F.array_join(F.array_repeat(F.lit(""), shown_cols), " | "), F.lit("\n"))
    rows = F.coalesce("_rows", F.array().cast("array<struct<row:bigint,cells:array<string>>>"))
    # Rows without any cell still take a line, before each row and after the last one.
    body = F.array_join(
        F.transform(
            rows,
            lambda r, i: F.concat(
                F.repeat(blank, (r["row"] - 1 - F.when(i == 0, F.lit(0)).otherwise(F.element_at(rows, F.greatest(i, F.lit(1)))["row"])).cast("int")),
                F.array_join(F.slice(r["cells"], 1, shown_cols), " | "),
                F.lit("\n"),
            ),
        ),
        "",
    )
    last = F.when(F.size(rows) > 0, F.element_at(rows, -1)["row"]).otherwise(F.lit(0))
    tail = F.repeat(blank, (shown_rows - last).cast("int"))
    head = F.concat(
        F.lit("Sheet "), F.col("sheet_index").cast("string"), F.lit(": "), "sheet_name",
        F.lit("\nRows: "), F.col("row_count").cast("string"), F.lit(", Columns: "), F.col("column_count").cast("string"), F.lit("\n"),
    )
    row_note = F.when(
        F.col("row_count") > max_rows,
        F.concat(F.lit(f"(Showing first {max_rows} rows of "), F.col("row_count").cast("string"), F.lit(" total)\n")),
    ).otherwise(F.lit(""))
    col_note = F.when(
        F.col("column_count") > max_cols,
        F.concat(F.lit(f"(Showing first {max_cols} of "), F.col("column_count").cast("string"), F.lit(" columns)\n")),
    ).otherwise(F.lit(""))
    text = F.when(~F.col("has_data"), F.concat(head, F.lit("(Empty sheet)\n"))).otherwise(
        F.concat(head, row_note, col_note, body, tail)
    )
    return df.select("registry_id", "sheet_index", text.alias("preview"))


def sheet_chunks(metadata: DataFrame, cells: DataFrame, rows: int = MAX_ROWS, size: int = PART_BYTES) -> DataFrame:
    """The whole text of each sheet by row range: ``registry_id, sheet_index, first_row, chunk``.

    Every cell is there with all of its text.  A chunk holds at most ``rows`` rows
    and ends behind the row that takes it to ``size`` bytes, so no group is as
    large as its sheet.  Rows without any cell take a line inside their range;
    a range without any is left out.
    """
    known = metadata.select("registry_id", "sheet_index", "sheet_name", "row_count", "column_count", "has_data")
    one = cells.groupBy("registry_id", "sheet_index", "row", "col").agg(F.coalesce(F.max("value"), F.lit("")).alias("value"))
    lines = one.groupBy("registry_id", "sheet_index", "row").agg(F.array_sort(F.collect_list(F.struct("col", "value"))).alias("_cells"))
    shown = F.least(F.col("column_count"), F.lit(MAX_COLUMNS)).cast("int")
    separators = lambda n: F.repeat(F.lit(" | "), n.cast("int"))
    before = lambda i: F.when(i == 0, F.lit(1)).otherwise(F.element_at("_cells", F.greatest(i, F.lit(1)))["col"])
    line = F.array_join(F.transform("_cells", lambda c, i: F.concat(separators(c["col"] - before(i)), c["value"])), "")
    # Narrow sheets keep their empty last columns, as in a preview.
    line = F.concat(line, separators(shown - F.element_at("_cells", -1)["col"]), F.lit("\n"))
    block = F.floor((F.col("row") - 1) / F.lit(rows)).cast("bigint")
    lines = lines.join(known, ["registry_id", "sheet_index"]).withColumns({"_block": block, "_line": line})
    in_block = Window.partitionBy("registry_id", "sheet_index", "_block").orderBy("row")
    gap = F.col("row") - 1 - F.coalesce(F.lag("row").over(in_block), F.col("_block") * rows)
    blank = F.concat(separators(shown - 1), F.lit("\n"))
    lines = lines.withColumn("_line", F.concat(F.repeat(blank, gap.cast("int")), "_line"))
    so_far = F.sum(F.octet_length("_line")).over(in_block.rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.withColumn("_sub", F.floor(F.coalesce(so_far, F.lit(0)) / F.lit(size)))
    ordered = F.array_sort(F.collect_list(F.struct("row", "_line")))
    bodies = lines.groupBy("registry_id", "sheet_index", "_block", "_sub").agg(
        F.min("row").alias("first_row"), F.array_join(F.transform(ordered, lambda r: r["_line"]), "").alias("_body")
    )
    title = F.concat(F.lit("Sheet "), F.col("sheet_index").cast("string"), F.lit(": "), "sheet_name")
    extent = F.concat(F.lit("\nRows: "), F.col("row_count").cast("string"), F.lit(", Columns: "), F.col("column_count").cast("string"), F.lit("\n"))
    begins = F.row_number().over(Window.partitionBy("registry_id", "sheet_index").orderBy("first_row")) == 1
    going_on = F.concat(F.lit(" (from row "), F.col("first_row").cast("string"), F.lit(")\n"))
    # Only sheets without cells have no body.
    filled = bodies.join(known, ["registry_id", "sheet_index"]).withColumn("_begins", begins).select(
        "registry_id", "sheet_index", "first_row", F.concat(title, F.when(F.col("_begins"), extent).otherwise(going_on), "_body").alias("chunk")
    )
    empty = known.filter(~F.col("has_data")).select(
        "registry_id", "sheet_index", F.lit(0).cast("bigint").alias("first_row"), F.concat(title, extent, F.lit("(Empty sheet)\n")).alias("chunk")
    )
    return filled.unionByName(empty)


def workbook_parts(registry: DataFrame, metadata: DataFrame, cells: DataFrame, rows: int = MAX_ROWS, size: int = PART_BYTES) -> DataFrame:
    """The whole text of each spreadsheet in ordered parts, with the path each is stored under.

    The first part has the path of the workbook; a part ends behind the chunk that
    takes it to ``size`` bytes.
    """
    in_book = Window.partitionBy("registry_id").orderBy("sheet_index", "first_row")
    so_far = F.sum(F.octet_length("chunk")).over(in_book.rowsBetween(Window.unboundedPreceding, -1))
    placed = sheet_chunks(metadata, cells, rows, size).withColumn("_at", F.floor(F.coalesce(so_far, F.lit(0)) / F.lit(size)))
    placed = placed.withColumn("part_number", F.dense_rank().over(Window.partitionBy("registry_id").orderBy("_at")))
    ordered = F.array_sort(F.collect_list(F.struct("sheet_index", "first_row", "chunk")))
    parts = placed.groupBy("registry_id", "part_number").agg(F.array_join(F.transform(ordered, lambda c: c["chunk"]), "\n").alias("_text"))
    counts = metadata.groupBy("registry_id").agg(F.count("*").alias("_n"))
    name = F.col("original_file_name")
    first = F.col("part_number") == 1
    number = F.col("part_number").cast("string")
    below = F.when(first, F.concat(F.lit("\nTotal Sheets: "), F.col("_n").cast("string"))).otherwise(F.concat(F.lit("\nPart: "), number))
    suffix = F.when(first, F.lit("_converted.pdf")).otherwise(F.concat(F.lit("_converted_part_"), number, F.lit(".pdf")))
    return registry.join(parts, "registry_id").join(counts, "registry_id").select(
        "registry_id",
        "part_number",
        F.concat(F.lit(CONVERTED_FOLDER), strip_extension(name), suffix).alias("converted_pdf_path"),
        F.concat(F.lit("Excel Document: "), name, below, F.lit("\n\n"), "_text").alias("document_text"),
    )


def pending_conversions(registry: DataFrame, limit: int = 10) -> DataFrame:
    return registry.filter(F.col("conversion_status") == "pending").orderBy("created_timestamp", "registry_id").limit(limit)
