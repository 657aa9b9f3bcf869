"""The flow over real files: two runs, a replay, CSV loading and the splits."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from foliospark.operators import sheets, state
from foliospark.schemas import conform
from foliospark.seeds import EXTRACT_RULES
from foliospark.sources import listing
from foliospark.sources.tables import TableFolder
from foliospark.streaming.flow import ARRIVALS, DocumentFlow, Hooks, drain, load_csv_batch

AS_OF = datetime(2024, 3, 1, 12)
CONTRACT = """Service agreement. Vendor: Acme Tools
The vendor and the client agree to this contract. Effective date: 2024-01-15.
Total contract value: $12,500 and payment terms Net 30. Either party may end this agreement
with 60 days notice. This text goes on so that the document is long enough to be cut into chunks."""
PAGE = "<html><body><h1>Employee handbook</h1><p>Every employee is entitled to leave and benefits. " + "The code of conduct applies to all. " * 8 + "</p></body></html>"


@pytest.fixture()
def inbox(tmp_path):
    folder = tmp_path / "in box"
    (folder / "docs").mkdir(parents=True)
    (folder / "docs" / "deal.txt").write_text(CONTRACT)
    (folder / "docs" / "rules.HTML").write_text(PAGE)
    (folder / "docs" / "empty.txt").write_text(" ")
    (folder / "docs" / "scan.png").write_bytes(b"\x89PNG")
    (folder / "sales.csv").write_text('id, Name ,amount\n1,"a, b",1.5\n\n2,c,2.5\n3,d\n4,e,4.5,surplus\n')
    (folder / "bad.csv").write_text("\n")
    (folder / "book.xlsx").write_bytes(b"PK")
    (folder / "tool.exe").write_bytes(b"MZ")
    return folder


def test_listing(spark, inbox):
    rows = {r["relative_path"]: r["size"] for r in listing.list_files(spark, str(inbox)).collect()}
    assert rows["docs/deal.txt"] == len(CONTRACT) and rows["tool.exe"] == 2 and len(rows) == 8


def test_listing_by_folders(spark, tmp_path):
    base = tmp_path / "in box"
    for i in range(3):
        for j in range(3):
            folder = base / f"a{i}" / f"b={j}" / "c"
            folder.mkdir(parents=True)
            (folder / "x y.txt").write_bytes(b"." * i)
            (folder.parent / "top.txt").write_bytes(b"ab")
    (base / "none.txt").write_bytes(b"")
    (base / ".hidden").write_bytes(b"h")
    (base / "_tmp").mkdir()
    (base / "_tmp" / "t.txt").write_bytes(b"t")
    (base / "hollow").mkdir()
    expected = {f"a{i}/b={j}/c/x y.txt": i for i in range(3) for j in range(3)} | {f"a{i}/b={j}/top.txt": 2 for i in range(3) for j in range(3)} | {"none.txt": 0}
    listing.list_files(spark, str(base))
    for folders in (1, 4, 9, 100):
        # However deep the driver looks, every file is listed once.
        found = spark.read.format("folder_listing").option("folders", folders).load(str(base)).collect()
        assert len(found) == len(expected) and {r["relative_path"]: r["size"] for r in found} == expected
        assert all(r["last_modified"] is not None for r in found)
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(base)).filter("length > 0")
    assert {r["path"] for r in read.collect()} == {r["file_url"] for r in found if r["size"]}
    with pytest.raises(Exception, match="no such folder"):
        listing.list_files(spark, str(base / "gone")).collect()
    assert listing.list_files(spark, str(base / "hollow")).collect() == []


def test_flow_over_files(spark, inbox, tmp_path):
    tables = TableFolder(spark, str(tmp_path / "tables"))
    flow = DocumentFlow(tables, clock=lambda: AS_OF)
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        flow.start(listing.stream_files(spark, str(inbox)), checkpoint).awaitTermination()

    run()
    parsed = {r["file_path"]: r for r in flow.parsed().collect()}
    assert parsed["docs/deal.txt"]["status"] == "classified"
    assert parsed["docs/rules.HTML"]["document_type"] == "html" and "<" not in parsed["docs/rules.HTML"]["content_text"]
    assert parsed["docs/scan.png"]["status"] == "parse_error"
    classes = {r["file_name"]: r["document_class"] for r in tables.read("document_classifications").collect()}
    assert classes == {"deal.txt": "vendor_contract", "rules.HTML": "hr_policy"}
    deal = {r["attribute_name"]: r["attribute_value"] for r in tables.read("document_extractions").filter("file_name = 'deal.txt'").collect()}
    assert len(deal) == 10
    assert deal["contract_effective_date"] == "2024-01-15" and deal["payment_terms"] == "Net 30"
    assert deal["termination_notice_period"] == "60 days"
    assert {r["reason"] for r in tables.read("rejected_files").collect()} == {"unsupported type"}
    assert tables.read("document_chunks").count() == 2
    first = {t: tables.read(t).count() for t in ("parsed_documents", "document_chunks", "document_extractions", "csv_file_registry")}

    run()
    assert first == {t: tables.read(t).count() for t in first}

    (inbox / "docs" / "more.txt").write_text(CONTRACT)
    run()
    assert tables.read("parsed_documents").count() == first["parsed_documents"] + 1
    flow.run_batch(listing.list_files(spark, str(inbox)), 7)
    assert tables.read("parsed_documents").count() == first["parsed_documents"] + 1

    outcome = load_csv_batch(tables, flow.csv_files(), str(inbox), 0, AS_OF)
    assert outcome == {"processed": 1, "errors": 1}
    files = {r["file_name"]: r for r in flow.csv_files().collect()}
    assert files["bad.csv"]["processing_status"] == "error" and files["bad.csv"]["error_message"]
    assert files["sales.csv"]["processing_status"] == "completed"
    assert (files["sales.csv"]["column_count"], files["sales.csv"]["row_count"], files["sales.csv"]["target_table_name"]) == (3, 4, "CSV_SALES")
    rows = [(r["row_number"], r["row_data"]) for r in tables.read("csv_data_master").orderBy("row_number").collect()]
    assert rows[0] == (1, '{"id":1,"Name":"a, b","amount":1.5}')
    assert rows[2] == (3, '{"id":3,"Name":"d"}') and rows[3][0] == 4
    assert load_csv_batch(tables, flow.csv_files(), str(inbox), 1, AS_OF) == {"processed": 0, "errors": 0}


def test_drain_and_backlog(spark, inbox, tmp_path):
    stream, checkpoint = listing.stream_files(spark, str(inbox)), str(tmp_path / "c")
    drain(stream, checkpoint)
    seen = []
    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, b: seen.append(df.count()))
    query.trigger(availableNow=True).start().awaitTermination()
    assert sum(seen) == 0
    done = spark.createDataFrame([("docs/deal.txt",), (None,), ("gone.txt",)], "file_path string")
    files = listing.list_files(spark, str(inbox))
    assert listing.backlog(files, done, "file_path").count() == 7
    assert [r[0] for r in listing.removed(files, done, "file_path").collect()] == ["gone.txt"]


def test_rewritten_batch_replaces_itself(spark, tmp_path):
    tables = TableFolder(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", 1, "r")], "file_path string, file_size bigint, reason string")
    for batch in (0, 1, 1):
        tables.write("rejected_files", rows, batch)
    assert tables.read("rejected_files").count() == 2
    assert tables.read("rejected_files", before=1).count() == 1 and tables.read("rejected_files", only=1).count() == 1
    counts = tables.reset(("rejected_files",))
    assert [tuple(r) for r in counts.collect()] == [("rejected_files", 0)]


def test_merge_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", "x", 0.1), (2, "b", None, None)], "id int, name string, value string, score double")
    new = spark.createDataFrame([(1, None, 0.9), (3, "n", 0.3)], "id int, value string, score double")
    once = state.merge_rows(old, new, ["id"], ["value", "score"])
    twice = state.merge_rows(once, new, ["id"], ["value", "score"])
    rows = sorted(tuple(r) for r in once.collect())
    assert rows == [(1, "a", None, 0.9), (2, "b", None, None), (3, None, "n", 0.3)]
    assert sorted(tuple(r) for r in twice.collect()) == rows


def test_moves_are_legal_only_as_listed(spark):
    rows = spark.createDataFrame([("pending", "splitting"), ("splitting", "error"), ("error", "pending"), ("pending", "split_complete")], "a string, b string")
    legal = rows.select(state.is_legal_move(F.col("a"), F.col("b"), state.SPLIT_MOVES).alias("ok")).collect()
    assert [r["ok"] for r in legal] == [True, True, False, False]


def test_anti_join_ignores_nulls(spark):
    from foliospark.operators.routing import not_in

    left = spark.createDataFrame([("a",), ("b",)], "p string")
    known = spark.createDataFrame([("a",), (None,)], "q string")
    assert [r["p"] for r in not_in(left, "p", known, "q").collect()] == ["b"]


def test_rules_answer_known_questions():
    from foliospark.seeds import CLASSES, QUESTIONS

    assert len(QUESTIONS) == 79 and len(set(QUESTIONS)) == 79 and len(CLASSES) == 10
    asked = {(c, a) for c, a, _ in QUESTIONS}
    assert {(r.document_class, r.attribute_name) for r in EXTRACT_RULES} <= asked


def test_provider_isolates_bad_rows(spark):
    from foliospark.operators.provider import apply_provider

    def shout(values):
        if (values == "boom").any():
            raise ValueError("bad input")
        return values.str.upper()

    df = spark.createDataFrame([("a",), ("boom",), ("c",)], "v string").coalesce(1)
    rows = {r["v"]: (r["result"], r["error"]) for r in apply_provider(df, "v", shout).collect()}
    assert rows == {"a": ("A", None), "boom": (None, "bad input"), "c": ("C", None)}


def test_split_plan(spark):
    from foliospark.operators import splitting

    mb = 1024 * 1024
    docs = spark.createDataFrame(
        [("a", 200, mb), ("b", 201, mb), ("c", 401, 91 * mb), ("d", 10, 91 * mb)], "registry_id string, page_count bigint, original_file_size bigint"
    ).withColumns({"original_file_path": F.col("registry_id"), "original_file_name": F.concat("registry_id", F.lit(".x.pdf"))})
    planned = splitting.plan_splits(docs)
    assert {r["registry_id"]: (r["split_status"], r["split_count"]) for r in planned.collect()} == {
        "a": ("no_split_needed", 0), "b": ("split_complete", 2), "c": ("split_complete", 3), "d": ("unsplittable", 0),
    }
    parts = splitting.part_rows(planned, AS_OF).filter("registry_id = 'c'").orderBy("part_number").collect()
    assert [(p["page_start"], p["page_end"]) for p in parts] == [(1, 200), (201, 400), (401, 401)]
    assert parts[2]["part_stage_path"] == "split_documents/c.x_part_3_of_3.pdf"


def test_evaluation_source_is_checked(spark):
    from foliospark.sources.documents import evaluation_source

    with pytest.raises(ValueError):
        evaluation_source(spark.createDataFrame([(1,)], "document_id int"))
    assert evaluation_source(spark.createDataFrame([(1, "t")], "DOCUMENT_ID int, Parsed_Content string")).columns == ["document_id", "ocr_text"]


def test_catalog_tables(spark, tmp_path):
    from foliospark.sources import csvfiles
    from foliospark.sources.tables import append_to

    name = "t_" + tmp_path.name.replace("-", "_")
    df = spark.createDataFrame([(1, "x")], "id int, v string")
    csvfiles.create_if_absent(df, name)
    csvfiles.create_if_absent(df.withColumn("w", F.lit(1)), name)
    append_to(df, name)
    assert spark.table(name).columns == ["id", "v"] and spark.table(name).count() == 1
    spark.sql(f"drop table {name}")


def test_hooks_and_feedback(spark, inbox, tmp_path):
    """Decoded files, model labels and answers, and converted sheets that come back as documents."""
    import json

    import pandas as pd

    def decode(contents):
        return contents.map(lambda b: "decoded %d bytes of an image that is long enough to matter" % len(b))

    def label(texts):
        if texts.str.contains("handbook").any():
            raise ValueError("no label")
        return pd.Series(['{"labels":["case_study"]}'] * len(texts))

    def answer(requests):
        questions = [json.loads(r)["questions"] for r in requests]
        return pd.Series([json.dumps({"response": {k: k.upper() for k in q}, "scores": {k: 0.5 for k in q}}) for q in questions])

    def read_cells(pending):
        ids = pending.select("registry_id")
        sheets = ids.select("registry_id", F.explode(F.array(F.lit(1), F.lit(2)).cast("array<bigint>")).alias("sheet_index")).withColumn("sheet_name", F.concat(F.lit("S"), "sheet_index"))
        cells = ids.select("registry_id", F.lit(1).cast("bigint").alias("sheet_index"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(3).cast("bigint"))).alias("row"))
        return sheets, cells.withColumns({"col": F.lit(2).cast("bigint"), "value": F.concat(F.lit("v"), "row")})

    feedback = str(tmp_path / "feedback")
    tables = TableFolder(spark, str(tmp_path / "tables"))
    hooks = Hooks(decode=decode, label=label, answer=answer, read_cells=read_cells)
    flow = DocumentFlow(tables, hooks=hooks, feedback=feedback, csv_base=str(inbox), clock=lambda: AS_OF)
    flow.start(listing.stream_files(spark, str(inbox)), str(tmp_path / "c1")).awaitTermination()
    parsed = {r["file_name"]: r for r in flow.parsed().collect()}
    assert parsed["scan.png"]["content_text"].startswith("decoded 4 bytes")
    assert parsed["rules.HTML"]["status"] == "classification_error" and parsed["deal.txt"]["status"] == "classified"
    answers = tables.read("document_extractions").filter("file_name = 'deal.txt'").collect()
    assert len(answers) == 7 and all(r["attribute_value"] == r["attribute_name"].upper() and r["confidence_score"] == 0.5 for r in answers)
    assert {r["file_name"]: r["processing_status"] for r in flow.csv_files().collect()} == {"sales.csv": "completed", "bad.csv": "error"}
    book = flow.spreadsheets().collect()[0]
    assert (book["conversion_status"], book["sheet_count"], book["converted_pdf_path"]) == ("converted", 2, "converted_excel/book_converted.pdf")

    flow2 = DocumentFlow(tables, clock=lambda: AS_OF)
    for r in range(2):
        flow2.run_batch(spark.read.schema(ARRIVALS).option("recursiveFileLookup", True).parquet(feedback), 10 + r)
    back = tables.read("parsed_documents").filter("file_path like 'converted_excel/%'").collect()
    assert len(back) == 1
    assert back[0]["content_text"].startswith("Excel Document: book.xlsx\nTotal Sheets: 2\n\nSheet 1: S1\nRows: 3, Columns: 2\n | v1\n | v2\n | v3\n")
    assert "(Empty sheet)" in back[0]["content_text"]


def test_whole_sheets_come_back(spark, tmp_path):
    """Cells beyond 500 rows, 15 columns and 100 characters are in the documents of a workbook."""
    rows, columns, long = 1203, 18, "long " * 60

    def read_cells(pending):
        ids = pending.select("registry_id")
        sheets = ids.select("registry_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)).cast("array<bigint>")).alias("sheet_index")).withColumn("sheet_name", F.concat(F.lit("S"), "sheet_index"))
        cells = ids.crossJoin(spark.range(1, rows + 1).withColumnRenamed("id", "row")).crossJoin(spark.range(1, columns + 1).withColumnRenamed("id", "col"))
        cells = cells.filter("row NOT BETWEEN 501 AND 1000 OR row = 700").filter("col NOT IN (2, 17)")
        value = F.concat(F.lit("r"), "row", F.lit("c"), "col", F.when((F.col("row") == 1201) & (F.col("col") == 16), F.lit(long)).otherwise(F.lit("")), F.lit("e"))
        filled = cells.withColumn("value", value).withColumn("sheet_index", F.lit(1).cast("bigint"))
        more = ids.select("registry_id", F.lit(9000).cast("bigint").alias("row"), F.lit(40).cast("bigint").alias("col"), F.lit("alone").alias("value"), F.lit(3).cast("bigint").alias("sheet_index"))
        return sheets, filled.unionByName(more)

    feedback = str(tmp_path / "feedback")
    tables = TableFolder(spark, str(tmp_path / "tables"))
    flow = DocumentFlow(tables, hooks=Hooks(read_cells=read_cells), feedback=feedback, clock=lambda: AS_OF)
    arrived = spark.createDataFrame([("in/book.xlsx", 10, "in/book.xlsx", None)], ARRIVALS)
    flow.run_batch(arrived, 0)
    book = flow.spreadsheets().collect()[0]
    assert (book["conversion_status"], book["sheet_count"], book["converted_pdf_path"]) == ("converted", 3, "converted_excel/book_converted.pdf")
    flow.run_batch(spark.read.schema(ARRIVALS).option("recursiveFileLookup", True).parquet(feedback), 1)
    text = "".join(r["content_text"] for r in tables.read("parsed_documents").collect())
    for r in range(1, rows + 1):
        for c in range(1, columns + 1):
            there = (not 501 <= r <= 1000 or r == 700) and c not in (2, 17)
            value = f"r{r}c{c}{long if (r, c) == (1201, 16) else ''}e"
            assert text.count(value) == there, value
    assert "alone" in text and "(Empty sheet)" in text and "r1c1e |  | r1c3e" in text
    # Small parts: the same cells, in order, each part under its own path.
    found, cells = read_cells(flow.spreadsheets())
    parts = sheets.workbook_parts(flow.spreadsheets(), tables.read("excel_sheet_metadata"), cells, size=20_000).orderBy("part_number").collect()
    assert len(parts) > 5 and len({p["converted_pdf_path"] for p in parts}) == len(parts) and [p["part_number"] for p in parts] == list(range(1, len(parts) + 1))
    assert all(len(p["document_text"]) < 45_000 for p in parts)
    places = ["".join(p["document_text"] for p in parts).index(f"r{r}c18e") for r in range(1, rows + 1) if not 501 <= r <= 1000 or r == 700]
    assert places == sorted(places)


def csv_state(flow, tables):
    """What the CSV stage has stored, without times."""
    typed = flow.spark.read.option("mergeSchema", True).parquet(f"{tables.root}/csv_tables/CSV_SALES")
    master = sorted((r["file_path"], r["row_number"], r["row_data"]) for r in tables.read("csv_data_master").collect())
    states = sorted((r["file_path"], r["processing_status"], r["row_count"], r["inferred_schema"]) for r in flow.csv_files().collect())
    return master, states, sorted(str(sorted(r.asDict().items(), key=str)) for r in typed.collect())


def test_csv_by_name_whole_and_again(spark, tmp_path):
    """Two header orders of one table, a quoted line break, a new column, more files than ten, and a replay."""
    inbox = tmp_path / "in"
    for name in ("x", "y", "z"):
        (inbox / name).mkdir(parents=True)
    (inbox / "x" / "sales.csv").write_text("id,name,amount\n1,ann,10\n2,bob,20\n")
    (inbox / "y" / "sales.csv").write_text('amount,ID,Name,note\n30,3,"two\nlines",n1\n40.5,4,"say ""hi""",\n')
    (inbox / "z" / "sales.csv").write_text("id,name,amount\nfive,eve,50\n6,fay,60\n")
    for i in range(25):
        (inbox / f"f+{i} é.csv").write_text(f"k,v\n{i},a\n{i},b\n")
    (inbox / "none.csv").write_text("\n")
    tables = TableFolder(spark, str(tmp_path / "tables"))
    flow = DocumentFlow(tables, csv_base=str(inbox), clock=lambda: AS_OF)
    arrived = listing.list_files(spark, str(inbox))
    flow.run_batch(arrived, 0)
    first = csv_state(flow, tables)
    states = {path: (status, n) for path, status, n, _ in first[1]}
    assert states["none.csv"][0] == "error" and len(states) == 29
    assert all(v == ("completed", 2) for k, v in states.items() if k != "none.csv")
    rows = {(p, n): r for p, n, r in first[0]}
    assert rows["x/sales.csv", 2] == '{"id":"2","name":"bob","amount":20.0}'
    assert rows["y/sales.csv", 1] == '{"amount":30.0,"ID":"3","Name":"two\\nlines","note":"n1"}'
    assert rows["y/sales.csv", 2] == '{"amount":40.5,"ID":"4","Name":"say \\"hi\\""}'
    assert len([p for p, _ in rows if p.startswith("f+")]) == 50
    typed = spark.read.option("mergeSchema", True).parquet(f"{tables.root}/csv_tables/CSV_SALES").drop("_batch")
    assert {c.lower() for c in typed.columns} >= {"id", "name", "amount", "note"} and typed.count() == 6

    flow.run_batch(arrived, 0)
    assert csv_state(flow, tables) == first
    (inbox / "x2").mkdir()
    (inbox / "x2" / "sales.csv").write_text("note,id\nlate,9\n")
    flow.run_batch(listing.list_files(spark, str(inbox)), 1)
    again = csv_state(flow, tables)
    assert len(again[0]) == len(first[0]) + 1 and len(again[2]) == 7
    events = tables.read("csv_events")
    assert events.filter("processing_status = 'processing'").count() == 30 and events.count() == 60


def test_waiting_files_are_taken_by_a_later_batch(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text("k\n1\n")
    tables = TableFolder(spark, str(tmp_path / "tables"))
    arrived = listing.list_files(spark, str(inbox))
    DocumentFlow(tables, clock=lambda: AS_OF).run_batch(arrived, 0)
    flow = DocumentFlow(tables, csv_base=str(inbox), clock=lambda: AS_OF)
    assert flow.csv_files().first()["processing_status"] == "pending"
    flow.run_batch(arrived.limit(0), 1)
    assert flow.csv_files().first()["processing_status"] == "completed"


def test_page_limit_and_late_page_counts(spark, tmp_path):
    """A decoder's page-limit error registers the document; a page counter that comes later splits it."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "big.pdf").write_bytes(b"x")

    def decode(contents):
        raise ValueError("Maximum number of 500 pages exceeded")

    tables = TableFolder(spark, str(tmp_path / "tables"))
    arrived = listing.list_files(spark, str(inbox))
    DocumentFlow(tables, hooks=Hooks(decode=decode), clock=lambda: AS_OF).run_batch(arrived, 0)
    flow = DocumentFlow(tables, hooks=Hooks(count_pages=lambda df: df.withColumn("page_count", F.lit(450).cast("bigint"))), clock=lambda: AS_OF)
    assert tables.read("run_metrics").first()["failed_parse_count"] == 1
    assert flow.large_documents().first()["split_status"] == "requires_external_processing"
    (inbox / "note.txt").write_text("a short note about nothing in particular")
    flow.run_batch(listing.list_files(spark, str(inbox)), 1)
    assert (flow.large_documents().first()["split_status"], flow.large_documents().first()["split_count"]) == ("split_complete", 3)
    moves = [r["split_status"] for r in tables.read("split_events").orderBy("event_time", "split_status").collect()]
    assert sorted(moves) == ["requires_external_processing", "split_complete", "splitting"]


def test_stuck_rows_are_released_by_timers(spark, tmp_path):
    from foliospark.streaming import stuck

    schema = "registry_id string, processing_status string, event_time timestamp"
    at = lambda h, m=0: datetime(2024, 3, 1, h, m)

    def run(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        found = stuck.releases(events, "registry_id", "processing_status", "processing")
        writer = found.writeStream.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).format("parquet").option("path", str(tmp_path / "out"))
        stuck.start_with_state(spark, writer.start).awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(found.schema).parquet(str(tmp_path / "out")).collect())

    before = spark.conf.get(stuck.PROVIDER, None)
    # "a" runs since 1:00, "b" was done, "c" began again at 1:50; the row without a key is left out.
    first = run(
        ("a", "processing", at(1)), ("b", "processing", at(1)), ("b", "completed", at(1, 30)), ("c", "processing", at(0)), ("c", "processing", at(1, 50)), (None, "processing", at(0)),
        ("d", "completed", at(1, 59)),
    )
    assert first == []
    assert spark.conf.get(stuck.PROVIDER, None) == before
    # At 2:30 the wait for "a" is over, that for "c" is not.
    assert run(("d", "processing", at(2, 30))) == [("a", "pending", at(2))]
    # "c" ends in time; "d" and the new run of "a" wait too long, each once.
    again = run(("c", "error", at(2, 40)), ("a", "processing", at(2, 45)), ("e", "completed", at(5)))
    assert again == [("a", "pending", at(2)), ("a", "pending", at(3, 45)), ("d", "pending", at(3, 30))]
    assert run(("e", "completed", at(9))) == again


def test_releases_reach_the_tables(spark, tmp_path):
    from foliospark.streaming import stuck

    tables = TableFolder(spark, str(tmp_path / "tables"))
    registry = "registry_id string, processing_status string, created_timestamp timestamp"
    tables.write("csv_file_registry", conform(spark.createDataFrame([("x", "pending", AS_OF), ("y", "pending", AS_OF)], registry), "csv_file_registry"), 0)
    events = spark.createDataFrame([("x", "processing", AS_OF), ("y", "processing", AS_OF), ("y", "completed", datetime(2024, 3, 1, 13)), ("z", "completed", datetime(2024, 3, 1, 15))], "registry_id string, processing_status string, event_time timestamp")
    tables.write("csv_events", conform(events, "csv_events"), 0)
    for _ in range(2):
        stuck.release_events(tables, "csv_events", "processing_status", "processing", str(tmp_path / "check")).awaitTermination()
        found = {r["registry_id"]: r["processing_status"] for r in DocumentFlow(tables).csv_files().collect()}
        assert found == {"x": "pending", "y": "completed"}


@pytest.mark.parametrize("buckets", [1, 7])
def test_keys_that_share_a_bucket_are_released_one_by_one(spark, tmp_path, buckets):
    """A call handles many keys; each has a wait of its own, over to the millisecond."""
    from foliospark.streaming import stuck

    schema = "registry_id string, processing_status string, event_time timestamp"
    begin = datetime(2024, 3, 1)
    rows = [(f"r{i}", "processing", begin + timedelta(milliseconds=i)) for i in range(300)]
    rows += [(f"r{i}", "completed" if i % 2 else None, begin + timedelta(minutes=30)) for i in range(0, 300, 3)]

    def run(*new):
        spark.createDataFrame(list(new), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        found = stuck.releases(events, "registry_id", "processing_status", "processing", buckets=buckets)
        writer = found.writeStream.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).format("parquet").option("path", str(tmp_path / "out"))
        stuck.start_with_state(spark, writer.start).awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(found.schema).parquet(str(tmp_path / "out")).collect())

    over = lambda last: sorted((f"r{i}", "pending", begin + timedelta(minutes=60, milliseconds=i)) for i in range(last + 1) if i % 3)
    assert run(*rows, ("clock", "completed", begin + timedelta(minutes=60, milliseconds=100))) == over(100)
    assert run(("clock", "completed", begin + timedelta(hours=2))) == over(299)
    assert spark.read.format("statestore").load(str(tmp_path / "check")).count() == buckets


def test_steps_of_a_batch_do_not_take_all_shuffle_partitions(spark, tmp_path):
    """A stream's session has adaptive execution off; a small batch leaves few files all the same."""
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "64")
    path = F.concat(F.lit("in/"), F.col("id"), F.lit(".txt"))
    rows = session.range(200).select(path.alias("relative_path"), F.lit(9).cast("bigint").alias("size"), path.alias("file_url"), F.lit("some text").alias("raw_text"))
    tables = TableFolder(spark, str(tmp_path / "tables"))
    DocumentFlow(tables).run_batch(rows, 0)
    assert tables.read("parsed_documents").count() == 200
    assert len(list((tmp_path / "tables" / "parsed_documents").rglob("*.parquet"))) <= 16
    assert session.conf.get("spark.sql.adaptive.enabled") == "false"
