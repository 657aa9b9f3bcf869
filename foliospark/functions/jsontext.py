"""Column functions over JSON text.

Tables keep JSON as text; it is parsed where it is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def is_json(text: Column) -> Column:
    """True for any JSON value, scalars included; never null."""
    return F.try_parse_json(text).isNotNull()


def is_json_object(text: Column) -> Column:
    return F.coalesce(F.ltrim(text).startswith("{"), F.lit(False)) & is_json(text)


def unwrap_label(label: Column, keep_unlabelled: bool = False) -> Column:
    """A stored class that may be JSON: its first label, else the text itself.

    JSON without labels gives null; ``keep_unlabelled`` returns the raw text then.
    """
    parsed = F.try_parse_json(label)
    first = F.try_variant_get(parsed, "$.labels[0]", "string")
    if keep_unlabelled:
        first = F.coalesce(first, label)
    return F.when(parsed.isNotNull(), first).otherwise(label)


def class_key(name: Column) -> Column:
    """Class name for joining: trimmed, lower case, blanks and hyphens as underscores."""
    return F.lower(F.translate(F.trim(name), " -", "__"))


def path_value(json: Column, path: str, kind: str = "string") -> Column:
    """Value at a fixed path, null when missing or of another kind."""
    return F.try_variant_get(F.try_parse_json(json), path, kind)


def keyed_value(json: Column, parent: str, key: Column, kind: str = "double") -> Column:
    """Value below ``parent`` under a key that comes from a column and may hold any character."""
    below = F.try_variant_get(F.try_parse_json(json), parent, "map<string,variant>")
    return F.try_variant_get(F.try_element_at(below, key), "$", kind)


def object_entries(json: Column) -> Column:
    """Top-level entries of an object as a map of text; null for anything else."""
    return F.from_json(json, "map<string,string>")


def row_object(columns: list[str]) -> Column:
    """A row as one JSON object without its null columns."""
    return F.to_json(F.struct(*columns))


def explode_json(df: DataFrame, column: str, pos: str = "pos", key: str = "key", value: str = "value") -> DataFrame:
    """One row per object key or array element; scalars and bad JSON give none."""
    parts = df.sparkSession.tvf.variant_explode(F.try_parse_json(F.col(column)).outer())
    entries = parts.select(
        F.col("pos").alias(pos), F.col("key").alias(key), F.col("value").cast("string").alias(value)
    )
    return df.lateralJoin(entries)


NO_REASON = "No reasoning captured"
NO_REASON_GIVEN = "No reasoning provided"


def judge_reply(reply: Column) -> Column:
    """Score and reasoning from a model reply.

    The reply may be an object, or JSON text holding the object once more as a
    string.  A usable score is clamped to [0, 1]; an object without a score
    counts as 0; anything else falls back to 0.5.
    """
    inner = F.try_variant_get(F.try_parse_json(reply), "$", "string")
    body = F.when(is_json_object(reply), reply).when(is_json_object(inner), inner)
    fields = object_entries(body)
    number = fields["score"].try_cast("double")
    has_score = F.map_contains_key(fields, "score")
    usable = body.isNotNull() & (~has_score | number.isNotNull())
    score = F.when(usable & ~has_score, 0.0).when(usable, F.least(F.lit(1.0), F.greatest(F.lit(0.0), number)))
    reason = F.when(usable, F.coalesce(fields["reasoning"], F.lit(NO_REASON_GIVEN)))
    return F.struct(
        F.coalesce(score, F.lit(0.5)).alias("score"), F.coalesce(reason, F.lit(NO_REASON)).alias("reasoning")
    )
