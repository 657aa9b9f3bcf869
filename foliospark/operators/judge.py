"""Text quality scoring and evaluation runs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.jsontext import NO_REASON, judge_reply
from ..functions.text import readable_share
from ..schemas import conform

METRICS = ("ocr_accuracy_score", "ocr_completeness_score")


def accuracy(text: Column) -> Column:
    """Default scorer: share of readable characters, rounded to 4."""
    return F.round(readable_share(text), 4)


def accuracy_reason(score: Column) -> Column:
    return (
        F.when(score >= 0.97, "text is readable")
        .when(score >= 0.90, "some unreadable characters")
        .when(score >= 0.70, "many unreadable characters")
        .otherwise("mostly unreadable")
    )


def completeness(text: Column) -> Column:
    """Default scorer by how the text ends: sentence 1.0, word 0.98, list or clause 0.9, nothing 0."""
    end = F.regexp_replace(text, r"\s+$", "")
    return (
        F.when(F.coalesce(F.length(end), F.lit(0)) == 0, 0.0)
        .when(end.rlike(r"[.!?…][\"'”’)\]]*$"), 1.0)
        .when(end.rlike(r"[\p{L}\p{N}]$"), 0.98)
        .otherwise(0.9)
    )


def completeness_reason(score: Column) -> Column:
    return (
        F.when(score >= 1.0, "ends with a sentence")
        .when(score >= 0.98, "ends with a word")
        .when(score > 0, "ends inside a clause")
        .otherwise("no text")
    )


def run_name(version: str, as_of: datetime) -> str:
    return f"ocr_eval_{version}_{int(as_of.replace(tzinfo=as_of.tzinfo or timezone.utc).timestamp())}"


def evaluate(
    source: DataFrame,
    source_table: str,
    app_name: str = "OCR_EVL",
    app_version: str = "v1",
    as_of: datetime | None = None,
    replies: DataFrame | None = None,
) -> DataFrame:
    """Result rows of one evaluation run over ``document_id, ocr_text``.

    Without ``replies`` the default scorers run inside the row.  ``replies``
    (``document_id, accuracy_reply, completeness_reply``) holds a model's raw
    answers, which are joined by document.
    """
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    if replies is None:
        scored = source.withColumns({"_a": accuracy(F.col("ocr_text")), "_c": completeness(F.col("ocr_text"))})
        values = {
            "ocr_accuracy_score": F.col("_a"),
            "ocr_accuracy_reasoning": accuracy_reason(F.col("_a")),
            "ocr_completeness_score": F.col("_c"),
            "ocr_completeness_reasoning": completeness_reason(F.col("_c")),
        }
    else:
        scored = source.join(replies, "document_id", "left").withColumns(
            {"_a": judge_reply(F.col("accuracy_reply")), "_c": judge_reply(F.col("completeness_reply"))}
        )
        values = {
            "ocr_accuracy_score": F.col("_a.score"),
            "ocr_accuracy_reasoning": F.coalesce("_a.reasoning", F.lit(NO_REASON)),
            "ocr_completeness_score": F.col("_c.score"),
            "ocr_completeness_reasoning": F.coalesce("_c.reasoning", F.lit(NO_REASON)),
        }
    return conform(
        scored.withColumns(
            values
            | {
                "app_name": F.lit(app_name),
                "app_version": F.lit(app_version),
                "run_name": F.lit(run_name(app_version, as_of)),
                "source_table": F.lit(source_table),
                "evaluation_timestamp": F.lit(as_of),
            }
        ),
        "ocr_accuracy",
    )


# Fixed value: the table that keeps the scores of every document.
RESULT_TABLE = "OCR_ACCURACY"


def exact_mean(score: str, weight: str | None = None):
    """Mean to three digits; the sum is an exact decimal, so the order of rows does not decide how it is rounded."""
    exact = F.col(score).cast("decimal(27,18)")
    n = F.count(score) if weight is None else F.sum(weight)
    total = F.sum(exact if weight is None else exact * F.col(weight).cast("decimal(10,0)"))
    return F.round(total / n, 3).cast("double")


def metric_summary(results: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Mean, median, minimum, maximum and sample deviation of each metric.

    Equal scores are counted before the shuffle, so a metric's group holds its
    distinct scores and not its rows.
    """
    long = results.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("score")) for m in metrics])).alias("e"))
    counted = long.select("e.metric", F.col("e.score").alias("score")).filter("score is not null").groupBy("metric", "score").agg(F.count("*").alias("n"))
    n = F.sum("n")
    centre = counted.groupBy("metric").agg((F.sum(F.col("score") * F.col("n")) / n).alias("centre"))
    off = F.col("score") - F.col("centre")
    deviation = F.when(n > 1, F.sqrt(F.sum(off * off * F.col("n")) / (n - 1)))
    return counted.join(centre, "metric").groupBy("metric").agg(
        n.alias("records"),
        exact_mean("score", "n").alias("mean"),
        F.round(F.percentile("score", 0.5, F.col("n")), 3).alias("median"),
        F.min("score").alias("min"),
        F.max("score").alias("max"),
        F.round(deviation, 3).alias("std"),
    )


def summary_json(results: DataFrame) -> DataFrame:
    """One JSON summary per run; scores of single documents stay in the table."""
    metrics = F.struct(
        *[
            F.struct(
                exact_mean(m).alias("mean"), F.round(F.median(m), 3).alias("median"), F.min(m).alias("min"), F.max(m).alias("max"), F.round(F.stddev(m), 3).alias("std")
            ).alias(m)
            for m in METRICS
        ]
    )
    runs = results.groupBy("run_name", "app_name", "app_version", "source_table").agg(
        F.count("*").alias("records_evaluated"), metrics.alias("metrics")
    )
    return runs.select(
        "run_name",
        F.to_json(
            F.struct(
                F.lit("success").alias("status"), "run_name", "app_name", "app_version", "source_table", "records_evaluated", F.lit(RESULT_TABLE).alias("results_table"),
                F.concat(F.lit(f"SELECT * FROM {RESULT_TABLE} WHERE run_name = '"), F.col("run_name"), F.lit("'")).alias("query_instructions"), "metrics"
            )
        ).alias("summary"),
    )
