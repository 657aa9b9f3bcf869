"""CSV files: schema inference, typed tables and the long any-schema table."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from ..functions.jsontext import row_object
from ..functions.paths import member_id
from ..operators.routing import not_in
from ..schemas import conform

# How files are read.
OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
    "enforceSchema": "true",
}
REJECTED = "_rejected"


def infer_columns(spark: SparkSession, files: str | list[str]) -> T.StructType:
    """Column names and types found in the files (one distributed pass)."""
    return spark.read.options(**OPTIONS).option("inferSchema", True).csv(files).schema


def column_metadata(spark: SparkSession, registry_id: str, schema: T.StructType, as_of: datetime) -> DataFrame:
    """One row per column, in file order."""
    rows = [
        (f"{registry_id}_COL_{i}", registry_id, f.name, f.dataType.simpleString(), i, f.nullable, as_of)
        for i, f in enumerate(schema.fields)
    ]
    return spark.createDataFrame(
        rows,
        "metadata_id string, registry_id string, column_name string, column_type string, column_order bigint,"
        " nullable boolean, created_timestamp timestamp",
    )


def schema_json(metadata: DataFrame) -> DataFrame:
    """Per registry row its columns as one JSON list in column order."""
    entry = F.struct(
        F.col("column_order").alias("order"), F.col("column_name"), F.col("column_type").alias("type"), F.col("nullable")
    )
    return metadata.groupBy("registry_id").agg(
        F.count("*").alias("column_count"),
        F.to_json(F.array_sort(F.collect_list(entry))).alias("inferred_schema"),
    )


def file_facts(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """Per file its header line, and whether some quoted field holds a line break (one distributed pass)."""
    lines = spark.read.text(files).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at")
    )
    open_quote = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
    first = F.min_by("value", F.when(F.trim("value") != "", F.col("_at")))
    return lines.groupBy("_file").agg(first.alias("header"), F.max(open_quote).alias("multi_line"))


def header_names(header: str) -> list[str]:
    """Column names of a header line: trimmed; absent names count from 0, repeated ones (in any case) get their position."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([header], skipinitialspace=True), [])):
        name = name.strip() or f"_c{i}"
        names.append(f"{name}{i}" if name.lower() in (n.lower() for n in names) else name)
    return names


# Kinds in the order in which they are tried, and what a value of each looks like besides being castable.
KINDS = (("int", None), ("bigint", None), ("double", None), ("boolean", r"(?i)^(true|false)$"), ("date", r"^\d{4}-\d{1,2}-\d{1,2}$"), ("timestamp", r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d"))


def column_kinds(raw: DataFrame, columns: list[str]) -> DataFrame:
    """``_file, column_order, kind``: the narrowest kind that fits all values of a column in a file.

    Every value is looked at; only one row per file and column and task is shuffled.
    """
    value = F.col("c.value")
    fits = [
        F.bool_and(value.isNull() | (value.try_cast(kind).isNotNull() & (value.rlike(look) if look else F.lit(True)))).alias(kind) for kind, look in KINDS
    ]
    cells = raw.select("_file", F.explode(F.array(*[F.struct(F.lit(i).alias("column_order"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(columns)])).alias("c"))
    found = cells.groupBy("_file", F.col("c.column_order").alias("column_order")).agg(F.count(value).alias("n"), *fits)
    kind = F.coalesce(*[F.when((F.col("n") > 0) & F.col(k), k) for k, _ in KINDS], F.lit("string"))
    return found.select("_file", "column_order", kind.alias("kind"))


def common_kind(kinds: set[str]) -> str:
    """One kind for columns of the same name: the widest number, or text."""
    numbers = ("int", "bigint", "double")
    if len(kinds) == 1:
        return next(iter(kinds))
    return max(kinds, key=numbers.index) if kinds and kinds <= set(numbers) else "string"


def _quote_ends(line: Column) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted field, if it begins outside of one, and if inside.

    A quote opens at the beginning of a field only; a doubled quote never changes the state.
    """
    single = F.replace(line, F.lit('""'), F.lit(""))
    ends_open = lambda text: F.regexp_replace(text, '(^|,)[ \\t]*"[^"]*"', "$1x").rlike('(^|,)[ \\t]*"[^"]*$')
    closed_at = F.instr(single, '"')
    rest = F.concat(F.lit("x"), F.substr(single, closed_at + 1))
    return ends_open(single), F.when(closed_at == 0, True).otherwise(ends_open(rest))


def _fold_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block, from its lines in order: how it ends from either state."""
    at, ends = None, (False, True)
    for batch in batches:
        for file, block, *line in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != at:
                if at is not None:
                    yield _one_row(at, ends)
                at, ends = (file, block), (False, True)
            ends = line[ends[0]], line[ends[1]]
    if at is not None:
        yield _one_row(at, ends)


def _one_row(at, ends) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"_file": at[0], "_block": at[1], "from_out": ends[0], "from_in": ends[1]}])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block from its lines in order, when it is known whether the block begins inside a quoted field.

    ``part`` is ``head`` for what belongs to a record of an earlier block, ``tail`` for one that goes on, else ``whole``.
    """
    schema = pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("_row_in_block", pa.int64()), ("part", pa.string()), ("record", pa.string())])
    at, held, part, row, inside = None, [], "whole", 0, False
    for batch in batches:
        out = []
        for file, block, begins_in, from_out, from_in, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != at:
                if held:
                    out.append((*at, row, part if part == "head" else "tail", "\n".join(held)))
                at, held, row, inside = (file, block), [], 0, begins_in
                part = "head" if inside else "whole"
            if not inside and not line.strip():
                continue
            held.append(line)
            inside = from_in if inside else from_out
            if not inside:
                out.append((file, block, row, part, "\n".join(held)))
                row += part == "whole"
                held, part = [], "whole"
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, schema)], schema=schema)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*at, row, part if part == "head" else "tail", "\n".join(held)), schema)], schema=schema)


def quoted_records(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """``_file, _block, _row_in_block, record``: records whose quoted fields may hold line breaks, every block of a file in its own task.

    The first pass finds how each block ends if it begins outside or inside a
    quoted field, a window over one row per block finds how it does begin, and
    the second pass cuts the block.  Only records that cross blocks are shuffled.
    What is sent to all tasks is at most one row per block of a file.  Lines end
    with a line feed, with or without a carriage return; blank lines are left out.
    """
    raw = spark.read.option("lineSep", "\n").text(files)
    from_out, from_in = _quote_ends(F.col("value"))
    place = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    lines = raw.select(*place, from_out.alias("from_out"), from_in.alias("from_in"), "value")
    blocks = lines.drop("value").mapInArrow(_fold_blocks, "_file string, _block bigint, from_out boolean, from_in boolean")
    # A block is constant, keeps the state or swaps it: the last constant before, and the swaps since, give the state.
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("from_out") == F.col("from_in")
    swaps = blocks.withColumn("_s", F.coalesce(F.sum((F.col("from_out") & ~F.col("from_in")).cast("int")).over(before), F.lit(0)))
    last = F.last(F.when(fixed, F.struct("from_out", "_s")), ignorenulls=True).over(before)
    state = swaps.withColumn("_l", last).select("_file", "_block", ((F.coalesce(F.col("_l.from_out").cast("int"), F.lit(0)) + F.col("_s") - F.coalesce("_l._s", F.lit(0))) % 2 == 1).alias("_in"))
    opened = F.broadcast(state.filter("_in"))
    cut = lines.join(opened, ["_file", "_block"], "left").select("_file", "_block", F.coalesce("_in", F.lit(False)), "from_out", "from_in", "value")
    found = cut.mapInArrow(_records, "_file string, _block bigint, _row_in_block bigint, part string, record string")
    crossing = found.filter("part != 'whole'")
    # A block's head comes before its tail; a tail begins a record.
    order = Window.partitionBy("_file").orderBy("_block", "part")
    joined = (
        crossing.withColumn("_k", F.sum((F.col("part") == "tail").cast("int")).over(order))
        .groupBy("_file", "_k")
        .agg(F.min("_block").alias("_block"), F.max(F.when(F.col("part") == "tail", F.col("_row_in_block"))).alias("_row_in_block"), F.array_sort(F.collect_list(F.struct("_block", "part", "record"))).alias("_p"))
        .select("_file", "_block", "_row_in_block", F.array_join(F.transform("_p", lambda p: p["record"]), "\n").alias("record"))
    )
    return found.filter("part = 'whole'").drop("part").unionByName(joined)


def read_csv(spark: SparkSession, files: str | list[str], columns: list[str], multi_line: bool = False) -> DataFrame:
    """Rows as text plus their source file and block; with ``multi_line`` quoted fields may hold line breaks.

    Short rows are filled with nulls and surplus fields dropped, so a differing
    number of fields is no error; only a value of the wrong type is.  With
    ``multi_line`` the column ``_row_in_block`` is the place of a row in its block.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if multi_line:
        # The header is the first record.
        data = quoted_records(spark, files).filter(~((F.col("_block") == 0) & (F.col("_row_in_block") == 0)))
        options = {k: v for k, v in OPTIONS.items() if k not in ("header", "enforceSchema")}
        fields = F.from_csv(F.regexp_replace("record", "\\r$", ""), ", ".join(f"`{c.replace('`', '``')}` string" for c in columns), {**options, "multiLine": "true"})
        return data.select(fields.alias("_c"), "_file", "_block", "_row_in_block").select("_c.*", "_file", "_block", "_row_in_block")
    return (
        spark.read.options(**OPTIONS)
        .schema(text)
        .csv(files)
        .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    )


def typed_rows(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to the inferred types and mark rows with a bad value."""
    bad = F.lit(False)
    for f in schema.fields:
        text = F.col(f"`{f.name}`")
        bad = bad | (text.isNotNull() & text.try_cast(f.dataType).isNull())
    return raw.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields],
        *[c for c in ("_file", "_block", "_row_in_block") if c in raw.columns],
        bad.alias(REJECTED),
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col(REJECTED)).drop(REJECTED)


def align(df: DataFrame, target: T.StructType, evolve: bool = False) -> DataFrame:
    """Match columns to the target by name, ignoring case.

    Missing columns are null.  Extra columns are dropped, or with ``evolve``
    kept behind the target's own.
    """
    have = {c.lower(): c for c in df.columns}
    known = {f.name.lower() for f in target.fields}
    out = [
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in target.fields
    ]
    if evolve:
        out += [F.col(f"`{c}`") for c in df.columns if c.lower() not in known]
    return df.select(*out)


def load_matching(current: DataFrame, incoming: DataFrame, evolve: bool = False) -> DataFrame:
    """Current rows plus incoming ones, matched by column name."""
    aligned = align(incoming, current.schema, evolve)
    return current.unionByName(aligned, allowMissingColumns=True)


def create_if_absent(df: DataFrame, name: str) -> None:
    """Create an empty catalog table with the frame's columns unless it exists."""
    df.limit(0).write.mode("ignore").saveAsTable(name)


def number_rows(rows: DataFrame) -> DataFrame:
    """Add ``row_number``: the position of each row in its file, from 1.

    A block of a file is read in order by one task, so the position inside the
    block needs no sort.  Only one row per block is gathered to find where each
    block begins; the data rows are not shuffled or sorted, whatever the size of
    a single file.  Rows with a column ``_row_in_block`` are ordered by it within their
    block, since records that cross blocks are put together apart from the others.
    """
    if "_row_in_block" in rows.columns:
        inside = Window.partitionBy("_file", "_block").orderBy("_row_in_block")
        rows = rows.withColumn("_n", F.row_number().over(inside)).drop("_row_in_block")
        return _shifted(rows, F.lit(1))
    tagged = rows.withColumn("_n", F.monotonically_increasing_id())
    return _shifted(tagged, F.min("_n"))


def _shifted(tagged: DataFrame, first: Column) -> DataFrame:
    blocks = tagged.groupBy("_file", "_block").agg(first.alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_file", "_block", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    return tagged.join(starts, ["_file", "_block"]).withColumn("row_number", F.col("_n") + F.col("_shift")).drop("_n", "_shift")


def master_rows(rows: DataFrame, files: DataFrame, columns: list[str], as_of: datetime) -> DataFrame:
    """Rows of the long table: one JSON object per data row, nulls left out.

    ``files`` maps the source file to its registry row
    (``_file, registry_id, file_path, file_name``).
    """
    numbered = number_rows(accepted(rows) if REJECTED in rows.columns else rows)
    named = numbered.join(files, "_file")
    return conform(
        named.select(
            member_id(F.col("registry_id"), "ROW", F.col("row_number")).alias("record_id"),
            "registry_id",
            "file_path",
            "file_name",
            "row_number",
            row_object([f"`{c}`" for c in columns]).alias("row_data"),
            F.lit(as_of).alias("created_timestamp"),
        ),
        "csv_data_master",
    )


def load_master(master: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows of files the master table does not hold yet."""
    return not_in(incoming, "registry_id", master, "registry_id")


def pending_files(registry: DataFrame, limit: int | None = 10) -> DataFrame:
    """Oldest pending files first; the id breaks ties.  Without a limit all of them, in no order."""
    waiting = registry.filter(F.col("processing_status") == "pending")
    return waiting if limit is None else waiting.orderBy("created_timestamp", "registry_id").limit(limit)
