"""What the optimizer makes of the operators."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from foliospark.operators import chunking, classify, extract, search, state
from foliospark.plans import costs, reports
from foliospark.schemas import empty, extraction_prompts
from foliospark.sources import listing

SMALL = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 3, 1)


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.fixture()
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_text_operators_do_not_shuffle(spark, documents):
    texts = documents.select(F.col("doc_id").cast("string").alias("document_id"), F.col("text").alias("content_text"))
    assert "Exchange" not in plan(chunking.chunk_texts(texts, "content_text"))
    labelled = classify.with_best_class(texts, "content_text")
    assert "Exchange" not in plan(labelled)
    named = labelled.withColumns({"file_name": F.lit("f"), "file_path": F.lit("p")})
    extracted = plan(extract.extract(named, extraction_prompts(spark), AS_OF))
    # Only the 79 questions are grouped and broadcast.
    assert extracted.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in extracted
    assert extracted.count("FileScan") == 1


def test_period_reaches_the_scan(spark):
    metering = spark.read.parquet(f"{SMALL}/events.parquet").select(
        F.lit("AI_SERVICES").alias("service_type"), F.lit("x").alias("name"), F.col("ts").alias("start_time"), F.col("value").alias("credits_used")
    )
    text = plan(costs.ai_trend(metering, date(2024, 1, 5), date(2024, 1, 6)))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    text = plan(listing.list_files(spark, str(tmp_path)))
    assert "content:binary" not in text


def test_known_empty_tables_leave_no_join(spark, documents):
    from foliospark.operators.routing import not_in

    rows = documents.select(F.col("source").alias("relative_path"))
    assert "Join" not in plan(not_in(rows, "relative_path", empty(spark, "parsed_documents"), "file_path"))


def test_top_k_is_limited_before_the_shuffle(spark):
    scored = spark.range(1000).select((F.col("id") % 3).alias("q"), "id", F.rand(1).alias("score"))
    text = plan(search.top_ranked(scored, "q", "id", 2))
    assert text.count("WindowGroupLimit") == 2


def test_latest_state_combines_before_the_shuffle(spark):
    events = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), F.lit("s").alias("status"))
    assert "partial_max" in plan(state.newest_per_key(events, ["k"], ["t"]))


def test_hot_key_join_is_split(spark):
    """One document with a third of all attributes is spread over tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 3001)
        attributes = spark.range(0, 300_000, 1, 8).select(hot.alias("document_id"), F.md5(F.col("id").cast("string")).alias("attribute_value"))
        documents = spark.range(0, 4000, 1, 4).select(F.col("id").alias("document_id"), F.lit("c").alias("document_class"))
        joined = reports.keep_all_left(documents, attributes, "document_id")
        assert joined.count() == 300_000 + 999
        rows = joined.filter("attribute_value is null or attribute_value <> ''")
        rows.write.format("noop").mode("overwrite").save()
        rows.collect()
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
