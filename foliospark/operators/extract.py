"""Attribute extraction into entity-attribute-value rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.jsontext import class_key, explode_json, is_json_object, object_entries, unwrap_label
from ..schemas import conform
from ..seeds import EXTRACT_RULES, ExtractRule
from .provider import Provider, apply_provider
from .routing import not_in

RESPONSE = "response"
SCORES = "scores"


def question_map(prompts: DataFrame) -> DataFrame:
    """One row per class with its attribute-to-question map."""
    entries = F.array_sort(F.collect_list(F.struct("attribute_name", "question_text")))
    return prompts.groupBy("document_class").agg(F.map_from_entries(entries).alias("questions"))


def with_questions(documents: DataFrame, prompts: DataFrame) -> DataFrame:
    """Documents with the questions of their class, matched on the normalised class ``_key``.

    The seeded question table is a literal of known size with one row per class,
    so the optimizer broadcasts it and the documents are not shuffled.
    """
    questions = question_map(prompts).select(class_key(F.col("document_class")).alias("_key"), "questions")
    # Never null, so that no null check on a computed class is pushed below the join and run twice.
    key = F.coalesce(class_key(unwrap_label(F.col("document_class"))), F.lit(""))
    keyed = documents.withColumn("_key", key)
    return keyed.join(questions, "_key")


def extractable(classified: DataFrame, parsed: DataFrame, extractions: DataFrame) -> DataFrame:
    """Classified documents with content and without extractions, plus their text."""
    todo = classified.filter(F.col("file_path").isNotNull() & (F.col("file_path") != "")).select(
        "document_id", "file_name", "file_path", "document_class"
    )
    todo = not_in(todo, "document_id", extractions, "document_id")
    texts = parsed.filter(F.col("content_text").isNotNull()).select("document_id", "content_text")
    return todo.join(texts, "document_id")


def with_answers(asked: DataFrame, rules: Sequence[ExtractRule] = EXTRACT_RULES) -> DataFrame:
    """Add the result object ``_result``: a response and a score for every question.

    The value is the first match of the attribute's pattern and the score is
    lower the more answers differ; questions without a rule or match get null
    and 0.  Only the patterns of the document's own class are run, each once,
    and as literals they are compiled once per task.
    """
    by_class: dict[str, list[ExtractRule]] = {}
    for rule in rules:
        by_class.setdefault(rule.document_class, []).append(rule)
    matches = names = F.when(F.lit(False), None)
    for name, own in by_class.items():
        found = [F.regexp_extract_all(F.col("content_text"), F.lit(r.pattern), F.lit(1)) for r in own]
        matches = matches.when(F.col("_key") == name, F.array(*found))
        names = names.when(F.col("_key") == name, F.array(*[F.lit(r.attribute_name) for r in own]))
    answers = F.map_from_entries(
        F.transform(
            F.arrays_zip(F.col("_names").alias("name"), F.col("_matches").alias("m")),
            lambda x: F.struct(
                x["name"],
                F.struct(
                    F.try_element_at(x["m"], F.lit(1)).alias("value"),
                    F.when(F.size(x["m"]) > 0, F.round(1.0 / F.size(F.array_distinct(x["m"])), 4)).alias("score"),
                ),
            ),
        )
    )
    attributes = F.map_keys("questions")
    response = F.transform(attributes, lambda n: F.struct(n.alias("key"), F.try_element_at("_answers", n)["value"].alias("value")))
    scores = F.transform(
        attributes,
        lambda n: F.struct(n.alias("key"), F.coalesce(F.try_element_at("_answers", n)["score"], F.lit(0.0)).alias("value")),
    )
    result = F.struct(F.map_from_entries(response).alias(RESPONSE), F.map_from_entries(scores).alias(SCORES))
    return (
        asked.withColumns({"_matches": matches, "_names": names})
        .withColumn("_answers", answers)
        .withColumn("_result", result)
        .drop("_matches", "_names", "_answers")
    )


def stored_result(result: Column) -> Column:
    """Result object as JSON text that keeps null answers."""
    return F.to_json(result, {"ignoreNullFields": "false"})


def flatten_result(results: DataFrame, column: str = "extraction_json") -> DataFrame:
    """Attribute rows from stored result objects; null answers still give a row."""
    parsed = F.from_json(
        F.col(column), f"{RESPONSE} map<string,string>, {SCORES} map<string,double>"
    )
    return (
        results.withColumn("_r", parsed)
        .select("*", F.explode(f"_r.{RESPONSE}").alias("attribute_name", "attribute_value"))
        .withColumn("confidence_score", F.try_element_at(F.col(f"_r.{SCORES}"), F.col("attribute_name")))
        .drop("_r")
    )


def extract(
    todo: DataFrame, prompts: DataFrame, as_of: datetime, rules: Sequence[ExtractRule] = EXTRACT_RULES
) -> DataFrame:
    """Entity-attribute-value rows for documents with text."""
    answered = with_answers(with_questions(todo, prompts), rules)
    rows = answered.select(
        "document_id",
        "file_name",
        "file_path",
        "document_class",
        stored_result(F.col("_result")).alias("extraction_json"),
        F.col(f"_result.{SCORES}").alias("_scores"),
        F.explode(f"_result.{RESPONSE}").alias("attribute_name", "attribute_value"),
    )
    return conform(
        rows.withColumns(
            {
                "confidence_score": F.try_element_at(F.col("_scores"), F.col("attribute_name")),
                "extraction_timestamp": F.lit(as_of),
            }
        ),
        "document_extractions",
    )


def extract_by_provider(todo: DataFrame, prompts: DataFrame, provider: Provider, as_of: datetime) -> DataFrame:
    """Attribute rows from a user's model.

    The model gets one JSON request per document (``text`` and ``questions``) and
    returns a result object; a document it fails on gives no rows.
    """
    request = F.to_json(F.struct(F.col("content_text").alias("text"), "questions"))
    asked = with_questions(todo, prompts).withColumn("_request", request)
    answered = apply_provider(asked, "_request", provider, "extraction_json").filter(F.col("error").isNull())
    return conform(flatten_result(answered).withColumn("extraction_timestamp", F.lit(as_of)), "document_extractions")


def flatten_attributes(extractions: DataFrame, strict: bool = False) -> DataFrame:
    """Attribute rows with JSON values spread over their keys.

    By default only objects count as JSON and every other value is kept as it
    is.  ``strict`` counts any JSON: arrays give unnamed rows, scalars vanish.
    """
    keep = ["document_id", "file_name", "file_path", "document_class", "confidence_score", "extraction_timestamp"]
    value = F.col("attribute_value")
    if not strict:
        # One pass: a value is spread over its own keys, or stands for itself.
        itself = F.create_map(F.col("attribute_name"), value)
        entries = F.when(is_json_object(value), object_entries(value)).otherwise(itself)
        return extractions.select(*keep, F.explode(entries).alias("attribute_name", "attribute_value"))
    parsed = F.try_parse_json(value)
    plain = extractions.filter(parsed.isNull()).select(*keep, "attribute_name", "attribute_value")
    nested = explode_json(
        extractions.filter(parsed.isNotNull()).select(*keep, F.col("attribute_value").alias("_json")),
        "_json",
        pos="_pos",
        key="attribute_name",
        value="attribute_value",
    )
    return plain.unionByName(nested.drop("_pos", "_json"))
