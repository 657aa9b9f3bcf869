"""Versioned upserts, the conversation log, ordered parts and the narrow comparison of paths."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from foliospark.operators import routing, splitting
from foliospark.operators.conversations import ConversationLog
from foliospark.operators.search_index import Conflict
from foliospark.schemas import empty
from foliospark.sources.versioned import VersionedTable

AS_OF = datetime(2024, 3, 1)


@pytest.fixture()
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t b"), "k int, name string, v int", ["k", "name"], buckets=4)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def changes(spark, values, schema="k int, name string, v int"):
    return spark.createDataFrame(values, schema)


def test_versions_of_a_table(spark, table):
    assert table.version() == 0 and rows(table.read()) == []
    assert table.merge(changes(spark, [(i, "a", i) for i in range(20)]), ["v"]) == 1
    before = table.read()
    held = table.folders(1)
    assert table.merge(changes(spark, [(3, "a", 30), (99, "b", 1)]), ["v"]) == 2
    assert rows(before) == rows(table.read(1)) == rows(changes(spark, [(i, "a", i) for i in range(20)]))
    assert rows(table.read()) == rows(changes(spark, [(i, "a", 30 if i == 3 else i) for i in range(20)] + [(99, "b", 1)]))
    # Buckets without changes keep their folder.
    kept = [b for b, folder in table.folders(2).items() if held.get(b) == folder]
    assert 4 - 2 <= len(kept) < 4


def test_an_outdated_writer_is_refused(spark, table):
    table.merge(changes(spark, [(1, "a", 1)]), ["v"])
    table.merge(changes(spark, [(1, "a", 2)]), ["v"])
    with pytest.raises(Conflict):
        table.merge(changes(spark, [(1, "a", 3)]), ["v"], base=1)
    # The other writer comes between the look at the version and the commit.
    table.version = lambda: 1
    with pytest.raises(Conflict):
        table._commit({0: "nowhere"}, 1)
    del table.version
    assert rows(table.read()) == [(1, "a", 2)] and table.version() == 2


def test_edges_of_an_upsert(spark, table):
    assert table.merge(changes(spark, []), ["v"]) == 0
    with pytest.raises(ValueError):
        table.merge(changes(spark, [(1, "a", 1), (1, "a", 2)]), ["v"])
    # A null key equals nothing; a column that the source lacks is null in new rows and kept in old ones.
    table.merge(changes(spark, [(1, None, 1), (1, None, 2), (2, "x", 5)]), ["v"])
    table.merge(changes(spark, [(1, None), (2, "x"), (3, "y")], "k int, name string"), [])
    assert rows(table.read()) == sorted([(1, None, 1), (1, None, 2), (1, None, None), (2, "x", 5), (3, "y", None)], key=str)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_every_turn_is_logged_once(spark, tmp_path):
    log = ConversationLog(spark, str(tmp_path / "log"), SCHEMA, buckets=3)
    assert log.read().collect() == []
    first = [(1, 1, "user", "a"), (1, 2, "assistant", "b"), (2, 1, "user", None), (None, None, "user", "n")]
    log.append(changes(spark, first + first, SCHEMA), 0)
    log.append(changes(spark, first, SCHEMA), 0)
    assert rows(log.read()) == rows(changes(spark, first, SCHEMA))
    # Old turns again, a late turn of a known session, and a new session.
    more = [(2, 0, "system", "late"), (3, 1, "user", "c")]
    for _ in range(2):
        log.append(changes(spark, first + more, SCHEMA), 1)
    log.append(changes(spark, [(1, 1, "user", "changed"), *more], SCHEMA), 2)
    log.append(changes(spark, [], SCHEMA), 3)
    assert rows(log.read()) == rows(changes(spark, first + more, SCHEMA))


def test_log_of_a_stream(spark, tmp_path):
    turns = [(c, t, "user", f"{c}.{t}") for c in range(3) for t in range(5)]
    for part in (turns[:8], turns[4:], turns):
        changes(spark, part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    log = ConversationLog(spark, str(tmp_path / "log"), SCHEMA, buckets=2)
    for checkpoint in ("one", "one", "two"):
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        log.start(source, str(tmp_path / checkpoint)).awaitTermination()
        assert rows(log.read()) == rows(changes(spark, turns, SCHEMA))


def test_ordered_parts(spark):
    parts = spark.createDataFrame([("d", "R", 2, "p2"), ("d", "R", 1, "p1"), ("d", "R", 3, "p3"), ("e", "S", 1, "q")], "original_file_path string, registry_id string, part_number bigint, part_stage_path string")
    parsed = spark.createDataFrame(
        [("p1", '{"content":"one"}'), ("p2", '{"content":"errorInformation"}'), ("p3", '{"errorInformation":"bad"}'), ("q", '{"content":null}')], "file_path string, parsed_content string"
    )
    found = splitting.merged_parts(parts, parsed).select("registry_id", "part_number", "part_text", "total_parts")
    assert rows(found) == [("R", 1, "one", 2), ("R", 2, "errorInformation", 2), ("S", 1, None, 1)]
    strict = splitting.merged_parts(parts, parsed, strict=True).select("registry_id", "part_number", "part_text", "total_parts")
    assert rows(strict) == [("R", 1, "one", 1), ("S", 1, None, 1)]
    assert rows(splitting.merged_documents(parts, parsed).select("registry_id", "total_parts", "merged_content")) == [("R", 2, "one errorInformation"), ("S", 1, "")]


def test_parts_are_joined_with_their_texts_once(spark):
    """The count and the rows read what one join has stored."""
    parts = spark.range(40).selectExpr("concat('d', id % 4) AS original_file_path", "concat('R', id % 4) AS registry_id", "id AS part_number", "concat('p', id) AS part_stage_path")
    parsed = spark.range(40).selectExpr("concat('p', id) AS file_path", "concat('{\"content\":\"t', id, '\"}') AS parsed_content")
    found = splitting.merged_parts(parts, parsed)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Range" not in plan, plan
    assert sorted(map(tuple, found.select("part_number", "part_text", "total_parts").collect())) == [(i, f"t{i}", 10) for i in range(40)]


def test_texts_do_not_meet_the_stored_paths(spark, tmp_path):
    spark.createDataFrame([("a.txt", 1, "u", "parse", "t", None), ("b.txt", 1, "u", "parse", "t", None)], "relative_path string, size bigint, file_url string, route string, content string, error_information string").write.parquet(str(tmp_path / "in"))
    routed = spark.read.parquet(str(tmp_path / "in"))
    known = empty(spark, "parsed_documents").select("file_path").unionByName(spark.createDataFrame([("a.txt",)], "file_path string"))
    found = routing.ingest_documents(routed, known, empty(spark, "large_document_registry"), AS_OF)
    assert [r["file_path"] for r in found.collect()] == ["b.txt"]
    plan = found._jdf.queryExecution().optimizedPlan()
    lines = plan.toString().splitlines()
    anti = [i for i, line in enumerate(lines) if "LeftAnti" in line]
    depth = lambda i: len(lines[i]) - len(lines[i].lstrip(" :+-"))
    assert anti
    for i in anti:
        below = []
        for line in lines[i + 1 :]:
            if len(line) - len(line.lstrip(" :+-")) <= depth(i):
                break
            below.append(line)
        assert below and not any("content#" in line.split("[", 1)[-1] for line in below if "Project" in line)
