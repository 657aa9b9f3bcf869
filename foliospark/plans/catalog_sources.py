"""Source and sink queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.jsontext import class_key, unwrap_label
from ..functions.paths import file_type
from ..operators import judge, routing
from ..schemas import conform, extraction_prompts
from ..sources import csvfiles, documents, listing
from ..sources.tables import TableFolder, export_csv, table_counts
from . import reports
from .catalog_relational import CLASS_KEY
from .fixtures import Data
from .registry import query

AS_OF = datetime(2024, 3, 1)


@query(
    "s1_directory_listing",
    """SELECT concat('part=', coalesce(lang, 'none'), '-', doc_id % 16) AS folder, 'txt' AS file_type, 1 AS files, 0 AS empty_files, CAST(sum(coalesce(strlen(text), 0) + 1) AS BIGINT) AS size
       FROM documents GROUP BY 1 UNION ALL SELECT 'none', 'txt', 1, 1, 0""",
)
def _(d: Data):
    """All texts as files, one for each folder, and a file without bytes beside them."""
    path = d.folder("listed")
    texts = d.documents.select("text", F.concat(F.coalesce("lang", F.lit("none")), F.lit("-"), F.col("doc_id") % 16).alias("part"))
    texts.repartition("part").write.partitionBy("part").text(f"{path}")
    texts.select("text").limit(0).write.text(f"{path}/none")
    found = listing.list_files(d.spark, path)
    folder = F.substring_index("relative_path", "/", 1).alias("folder")
    per_folder = found.groupBy(folder, file_type(F.col("relative_path")).alias("file_type"))
    return per_folder.agg(F.count("*").alias("files"), F.count_if(F.col("size") == 0).alias("empty_files"), F.sum("size").alias("size"))


@query(
    "s5_stream_backlog",
    "SELECT count(*) AS backlog FROM staged WHERE relative_path NOT IN (SELECT file_path FROM parsed WHERE status = 'parsed')",
    "parsed",
)
def _(d: Data):
    return listing.backlog(d.staged, d.parsed.filter("status = 'parsed'"), "file_path").agg(F.count("*").alias("backlog"))


@query("t7_removed_files", "SELECT file_path AS relative_path FROM parsed WHERE doc_id NOT IN (SELECT doc_id FROM labels)", "parsed")
def _(d: Data):
    return listing.removed(d.staged.join(d.labels.select("doc_id"), "doc_id", "left_semi"), d.parsed, "file_path")


def orders_as_csv(d: Data) -> str:
    """The orders as CSV files, in key order within each file, one folder with one file for each priority and last two bits of the key."""
    path = d.folder("orders_csv")
    rows = d.orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.col("o_orderpriority").alias("prio"), (F.col("o_orderkey") % 4).alias("part"), "o_orderpriority"
    )
    rows.repartition("prio", "part").sortWithinPartitions("prio", "part", "o_orderkey").write.partitionBy("prio", "part").option("header", True).csv(path)
    return path


ORDERS = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders"


def typed_orders(d: Data):
    path = orders_as_csv(d)
    files = f"{path}/*/*/*.csv"
    schema = csvfiles.infer_columns(d.spark, files)
    return csvfiles.typed_rows(csvfiles.read_csv(d.spark, files, schema.fieldNames()), schema), schema


@query("s6_csv_read", ORDERS)
def _(d: Data):
    rows, _ = typed_orders(d)
    clean = csvfiles.accepted(rows).drop("_file", "_block")
    return clean.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_totalprice", "o_orderstatus", "o_orderpriority")


@query(
    "s6_quoted_lines",
    """SELECT o_orderkey, concat('to "', trim(o_orderpriority), '",', chr(10), chr(10), o_custkey, ' ""', chr(13), chr(10), o_orderstatus) AS note, o_totalprice FROM orders""",
)
def _(d: Data):
    """Orders with quotes, commas and line breaks inside a field, written as CSV and read back block by block."""
    path = d.folder("orders_quoted")
    note = F.concat(F.lit('to "'), F.trim("o_orderpriority"), F.lit('",\n\n'), "o_custkey", F.lit(' ""\r\n'), "o_orderstatus").alias("note")
    d.orders.select("o_orderkey", note, "o_totalprice").repartitionByRange(4, "o_orderkey").write.options(header=True, quote='"', escape='"').csv(path)
    rows = csvfiles.read_csv(d.spark, f"{path}/*.csv", ["o_orderkey", "note", "o_totalprice"], multi_line=True)
    kept = csvfiles.accepted(csvfiles.typed_rows(rows, d.orders.select("o_orderkey", F.lit("").alias("note"), "o_totalprice").schema))
    return kept.drop("_file", "_block", "_row_in_block")


@query(
    "s7_infer_columns",
    """SELECT 'o_orderkey' AS column_name, 'int' AS column_type, 0 AS column_order UNION ALL SELECT 'o_custkey', 'int', 1 UNION ALL SELECT 'o_totalprice', 'double', 2
       UNION ALL SELECT 'o_orderstatus', 'string', 3 UNION ALL SELECT 'o_orderpriority', 'string', 4""",
)
def _(d: Data):
    schema = csvfiles.infer_columns(d.spark, f"{orders_as_csv(d)}/*/*/*.csv")
    return csvfiles.column_metadata(d.spark, "CSV_orders", schema, AS_OF).select("column_name", "column_type", "column_order")


@query(
    "s8_create_and_load",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
       UNION ALL SELECT c_custkey, upper(c_name), NULL, c_acctbal, c_mktsegment FROM customer""",
)
def _(d: Data):
    current = csvfiles.load_matching(d.customer.limit(0), d.customer)
    other = d.customer.select(
        F.col("c_mktsegment").alias("C_MKTSEGMENT"), F.upper("c_name").alias("C_Name"), F.col("c_custkey").alias("C_CUSTKEY"), F.col("c_acctbal").cast("string").alias("c_AcctBal"),
        F.lit("x").alias("surplus"),
    )
    return csvfiles.load_matching(current, other)


@query(
    "s9_load_evolving",
    "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS note FROM customer UNION ALL SELECT c_custkey, NULL, concat('n', c_nationkey) FROM customer",
)
def _(d: Data):
    current = d.customer.select("c_custkey", "c_name")
    incoming = d.customer.select(F.col("c_custkey").alias("C_CUSTKEY"), F.concat(F.lit("n"), "c_nationkey").alias("note"))
    return csvfiles.load_matching(current, incoming, evolve=True)


def order_master(d: Data):
    """The long table of the orders; a file is registered under its folder, since Spark chooses its name."""
    rows, schema = typed_orders(d)
    folder = F.concat_ws("_", F.url_decode(F.regexp_extract("_file", "prio=([^/]*)", 1)), F.regexp_extract("_file", "part=([^/]*)", 1))
    sources = rows.select("_file").distinct().select("_file", F.concat(F.lit("CSV_"), folder).alias("registry_id"), folder.alias("file_path"), F.lit("orders.csv").alias("file_name"))
    return csvfiles.master_rows(rows, sources, schema.fieldNames(), AS_OF)


ORDER_ROWS = """WITH orders_rows AS (SELECT *, concat(o_orderpriority, '_', o_orderkey % 4) AS file_path,
    CAST(row_number() OVER (PARTITION BY o_orderpriority, o_orderkey % 4 ORDER BY o_orderkey) AS BIGINT) AS row_number FROM orders)"""


@query(
    "s10_master_rows",
    ORDER_ROWS
    + """ SELECT concat('CSV_', file_path, '_ROW_', row_number) AS record_id, concat('CSV_', file_path) AS registry_id, file_path, 'orders.csv' AS file_name, row_number,
       concat('{"o_orderkey":', o_orderkey, ',"o_custkey":', o_custkey, ',"o_totalprice":', CAST(o_totalprice AS DOUBLE), ',"o_orderstatus":"', o_orderstatus, '","o_orderpriority":"', o_orderpriority, '"}') AS row_data,
       TIMESTAMP '2024-03-01 00:00:00' AS created_timestamp FROM orders_rows""",
)
def _(d: Data):
    return order_master(d)


@query("w1_row_numbers", "SELECT o_orderpriority, count(*) AS row_count, true AS in_key_order, true AS without_gaps FROM orders GROUP BY o_orderpriority")
def _(d: Data):
    """Rows are numbered 1..n per file in file order, which is key order here."""
    rows, _ = typed_orders(d)
    numbered = csvfiles.number_rows(rows)
    per_file = numbered.groupBy("_file", "o_orderpriority").agg(
        F.count("*").alias("n"), F.min("row_number").alias("lo"), F.max("row_number").alias("hi"), F.count_distinct("row_number").alias("k"),
        F.min_by("o_orderkey", "row_number").alias("first_key"), F.max_by("o_orderkey", "row_number").alias("last_key"),
        F.min("o_orderkey").alias("min_key"), F.max("o_orderkey").alias("max_key"),
    )
    return per_file.groupBy("o_orderpriority").agg(
        F.sum("n").alias("row_count"),
        F.bool_and((F.col("first_key") == F.col("min_key")) & (F.col("last_key") == F.col("max_key"))).alias("in_key_order"),
        F.bool_and((F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("k") == F.col("n"))).alias("without_gaps"),
    )


@query(
    "s11_append_batches",
    "SELECT document_id, file_path, file_size FROM parsed",
    "parsed",
)
def _(d: Data):
    """Two batches, the second written twice as after a restart."""
    tables = TableFolder(d.spark, d.folder("append"))
    rows = d.parsed
    tables.write("parsed_documents", conform(rows.filter("lang <= 'en'"), "parsed_documents"), 0)
    for _ in range(2):
        tables.write("parsed_documents", conform(rows.filter("lang > 'en'"), "parsed_documents"), 1)
    return tables.read("parsed_documents").select("document_id", "file_path", "file_size")


@query(
    "s12_append_results",
    "SELECT document_id, 'ocr_eval_v1_1709251200' AS run_name, 'parsed_documents' AS source_table, length(content_text) AS text_length FROM parsed",
    "parsed",
)
def _(d: Data):
    tables = TableFolder(d.spark, d.folder("results"))
    tables.write("ocr_accuracy", judge.evaluate(documents.evaluation_source(d.spread().parsed), "parsed_documents", as_of=AS_OF), 0)
    return tables.read("ocr_accuracy").select("document_id", "run_name", "source_table", F.length("ocr_text").alias("text_length"))


# The seeded classes and how many questions each has.
SEEDED = {
    "vendor_contract": 10, "sales_report": 8, "marketing_report": 9, "hr_policy": 7, "corporate_policy": 8,
    "financial_infographic": 10, "strategy_document": 8, "w2": 10, "case_study": 7, "other": 2,
}


@query(
    "s13_seed_questions",
    ", seeded(document_class, questions) AS (VALUES " + ", ".join(f"('{c}', {n})" for c, n in SEEDED.items()) + ") "
    + "SELECT s.document_class, s.questions, count(c.document_id) AS documents FROM seeded s LEFT JOIN classified c ON "
    + f"{CLASS_KEY} = s.document_class GROUP BY ALL",
    "classified",
)
def _(d: Data):
    """Every seeded class with its questions and the documents they are asked of."""
    asked = extraction_prompts(d.spark).groupBy("document_class").agg(F.count("*").cast("int").alias("questions"))
    keyed = d.classified.groupBy(class_key(unwrap_label(F.col("document_class"))).alias("document_class")).agg(F.count("*").alias("documents"))
    return asked.join(keyed, "document_class", "left").select("document_class", "questions", F.coalesce("documents", F.lit(0)).cast("bigint").alias("documents"))


@query(
    "s14_export_csv",
    """SELECT document_id, file_name, attribute_name, attribute_value FROM extraction_state""",
    "extraction_state",
)
def _(d: Data):
    path = d.folder("export")
    export_csv(d.extraction_state.select("document_id", "file_name", "attribute_name", "attribute_value"), path)
    return csvfiles.read_csv(d.spark, path, ["document_id", "file_name", "attribute_name", "attribute_value"]).drop("_file", "_block")


@query(
    "s15_reset_tables",
    """SELECT 'document_classifications' AS table_name, count(*) AS rows_before, 0 AS rows_after FROM classified
       UNION ALL SELECT 'parsed_documents', count(*), 0 FROM parsed""",
    "classified",
)
def _(d: Data):
    tables = TableFolder(d.spark, d.folder("reset"))
    names = ("document_classifications", "parsed_documents")
    tables.write("parsed_documents", conform(d.parsed, "parsed_documents"), 0)
    tables.write("document_classifications", conform(d.classified, "document_classifications"), 0)
    before = d.stored(table_counts({n: tables.read(n) for n in names}).withColumnRenamed("row_count", "rows_before"), "counts")
    after = tables.reset(names).withColumnRenamed("row_count", "rows_after")
    return before.join(after, "table_name")


HTML_SQL = r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(
    replace(replace(replace(replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', ' ', 'g'), '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'),
        '(?i)</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav|title|body|head|html|pre|blockquote)\b[^>]*>', chr(10), 'g'), '<[^>]+>', '', 'g'),
      '&middot;', '·'), '&copy;', '©'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
    '[ \t\r\f]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS content FROM pages"""


@query("s16_html_text", HTML_SQL)
def _(d: Data):
    return documents.page_texts(d.spread().pages).select("page_id", "content")


@query("s17_evaluation_source", "SELECT document_id, length(content_text) AS text_length FROM parsed", "parsed")
def _(d: Data):
    renamed = d.parsed.select(F.col("document_id").alias("DOCUMENT_ID"), F.col("content_text").alias("PARSED_CONTENT"))
    return documents.evaluation_source(renamed).select("document_id", F.length("ocr_text").alias("text_length"))


@query(
    "x1_attach_text",
    """SELECT relative_path, length(text) AS text_length FROM staged WHERE relative_path LIKE '%.txt'""",
    "staged",
)
def _(d: Data):
    routed = routing.route_files(d.staged.withColumnRenamed("text", "raw_text"))
    rows = documents.attach_text(routed.filter(F.col("relative_path").endswith(".txt")))
    return rows.filter("error_information is null").select("relative_path", F.length("content").alias("text_length"))


@query(
    "v7_csv_flattened",
    ORDER_ROWS
    + r""", cells AS (SELECT file_path, row_number, unnest(['o_orderkey', 'o_custkey', 'o_totalprice', 'o_orderstatus', 'o_orderpriority']) AS column_name,
         unnest([CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), regexp_replace(CAST(CAST(o_totalprice AS DOUBLE) AS VARCHAR), '\.0$', ''), o_orderstatus, o_orderpriority]) AS column_value FROM orders_rows)
       SELECT concat('CSV_', file_path, '_ROW_', row_number) AS record_id, 'orders.csv' AS file_name, file_path, row_number, column_name, column_value,
         TIMESTAMP '2024-03-01 00:00:00' AS created_timestamp FROM cells""",
)
def _(d: Data):
    """Whole numbers come out of a JSON object without a fraction."""
    return reports.csv_flattened(order_master(d))
