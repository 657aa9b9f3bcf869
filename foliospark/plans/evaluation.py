"""Reports over evaluation results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scores import LOW_SCORE, histogram_bin, is_low_score, run_verdict, score_category
from ..functions.text import preview
from ..operators.judge import METRICS

ACCURACY, COMPLETENESS = METRICS


def of_source(results: DataFrame, app_name: str, source_table: str) -> DataFrame:
    return results.filter((F.col("app_name") == app_name) & (F.col("source_table") == source_table))


def result_rows(results: DataFrame) -> DataFrame:
    return results.select(
        "document_id", ACCURACY, COMPLETENESS, preview(F.col("ocr_text"), 50).alias("text_preview"), "evaluation_timestamp", "run_name"
    )


def reasoning_rows(results: DataFrame) -> DataFrame:
    return results.select(
        "document_id",
        preview(F.col("ocr_text"), 50).alias("text_preview"),
        ACCURACY,
        "ocr_accuracy_reasoning",
        COMPLETENESS,
        "ocr_completeness_reasoning",
        "run_name",
    )


def run_statistics(results: DataFrame) -> DataFrame:
    """Counts, means, extremes and sample deviations per run."""
    return results.groupBy("app_name", "run_name").agg(
        F.count("*").alias("total_documents"),
        F.round(F.avg(F.col(ACCURACY)), 3).alias("avg_accuracy"),
        F.round(F.avg(F.col(COMPLETENESS)), 3).alias("avg_completeness"),
        F.round(F.min(ACCURACY), 3).alias("min_accuracy"),
        F.round(F.max(ACCURACY), 3).alias("max_accuracy"),
        F.round(F.stddev(ACCURACY), 3).alias("std_accuracy"),
        F.round(F.stddev(COMPLETENESS), 3).alias("std_completeness"),
        F.max("evaluation_timestamp").alias("evaluated_at"),
    )


def low_scores(results: DataFrame, threshold: float = LOW_SCORE) -> DataFrame:
    return results.filter(is_low_score(F.col(ACCURACY), F.col(COMPLETENESS), threshold)).select(
        "document_id", ACCURACY, COMPLETENESS, "ocr_accuracy_reasoning", preview(F.col("ocr_text"), 100).alias("text_preview")
    )


def lowest(results: DataFrame, score: str = ACCURACY, limit: int = 10) -> DataFrame:
    return low_scores(results).orderBy(score, "document_id").limit(limit)


def runs(results: DataFrame) -> DataFrame:
    return results.groupBy("run_name", "app_name", "app_version").agg(
        F.max("evaluation_timestamp").alias("last_eval"), F.count("*").alias("doc_count")
    )


def chosen(run: str | None = None, min_accuracy: float = 0.0, min_completeness: float = 0.0) -> Column:
    """Filter of the clauses that are set; true when none is."""
    clauses = []
    if run is not None:
        clauses.append(F.col("run_name") == run)
    if min_accuracy > 0:
        clauses.append(F.col(ACCURACY) >= min_accuracy)
    if min_completeness > 0:
        clauses.append(F.col(COMPLETENESS) >= min_completeness)
    return reduce(lambda a, b: a & b, clauses, F.lit(True))


def search_by_id(results: DataFrame, term: str) -> DataFrame:
    """Ids that hold the term in any case; a null id never does."""
    return results.filter(F.coalesce(F.lower("document_id").contains(term.lower()), F.lit(False)))


def dashboard_cards(results: DataFrame) -> DataFrame:
    """Document count, means with their verdicts, and the share of low scores."""
    sums = results.agg(
        F.count("*").alias("total_documents"),
        F.round(F.avg(F.col(ACCURACY)), 4).alias("avg_accuracy"),
        F.round(F.avg(F.col(COMPLETENESS)), 4).alias("avg_completeness"),
        F.count_if(is_low_score(F.col(ACCURACY), F.col(COMPLETENESS))).alias("low_count"),
    )
    return sums.withColumns(
        {
            "accuracy_verdict": run_verdict(F.col("avg_accuracy")),
            "completeness_verdict": run_verdict(F.col("avg_completeness")),
            "low_share": F.coalesce(F.round(F.try_divide(F.col("low_count") * 100, F.col("total_documents")), 1), F.lit(0.0)),
        }
    )


def _long(results: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("score")) for m in METRICS])
    return results.select(F.explode(pairs).alias("e")).select("e.*")


def category_counts(results: DataFrame) -> DataFrame:
    """Both metrics' category counts from one scan."""
    return _long(results).groupBy("metric", score_category(F.col("score")).alias("category")).agg(F.count("*").alias("count"))


def histogram(results: DataFrame, bins: int = 20) -> DataFrame:
    binned = _long(results).filter("score is not null").select("metric", histogram_bin(F.col("score"), bins).alias("bin"))
    counted = binned.groupBy("metric", "bin").agg(F.count("*").alias("count"))
    return counted.select(
        "metric",
        "bin",
        F.round(F.col("bin") / F.lit(float(bins)), 4).alias("bin_start"),
        F.round((F.col("bin") + 1) / F.lit(float(bins)), 4).alias("bin_end"),
        "count",
    )


def run_comparison(results: DataFrame) -> DataFrame:
    stats = []
    for name, column in (("accuracy", ACCURACY), ("completeness", COMPLETENESS)):
        for label, f in (("avg", F.avg), ("min", F.min), ("max", F.max), ("std", F.stddev)):
            stats.append(F.round(f(F.col(column)), 3).alias(f"{label}_{name}"))
    return results.groupBy("run_name").agg(*stats, F.count("document_id").alias("doc_count"))


def scatter_points(results: DataFrame) -> DataFrame:
    return results.select("document_id", ACCURACY, COMPLETENESS, "run_name")


def source_audit(source: DataFrame, text: str) -> DataFrame:
    """Rows, missing ids and missing or empty texts before an evaluation."""
    col = F.col(text)
    return source.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("document_id").isNull()).alias("null_document_ids"),
        F.count_if(col.isNull()).alias("null_texts"),
        F.count_if(col == "").alias("empty_texts"),
    )


def source_preview(source: DataFrame, text: str, size: int = 100) -> DataFrame:
    return source.select("document_id", preview(F.col(text), size).alias("text_preview"), F.length(text).alias("text_length"))
