"""Column functions over scores."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LOW_SCORE = 0.95


def clamp(score: Column, fallback: float = 0.5) -> Column:
    """Score limited to [0, 1]; ``least`` and ``greatest`` skip nulls, so an absent one is tested first."""
    return F.when(score.isNull(), fallback).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)))


def is_low_confidence(score: Column, threshold: float) -> Column:
    """Below the threshold; an absent score is not low."""
    return F.coalesce(score < threshold, F.lit(False))


def confidence_band(score: Column, threshold: float) -> Column:
    return (
        F.when(score.isNull(), "gray")
        .when(score < 0.3, "red")
        .when(score < 0.4, "orange")
        .when(score < threshold, "yellow")
        .otherwise("green")
    )


def score_category(score: Column) -> Column:
    return (
        F.when(score >= 0.97, "Excellent (≥97%)")
        .when(score >= 0.90, "Good (90-96%)")
        .when(score >= 0.70, "Average (70-89%)")
        .otherwise("Needs Review (<70%)")
    )


def run_verdict(mean: Column) -> Column:
    return F.when(mean >= 0.97, "Excellent").when(mean >= 0.90, "Good").otherwise("Needs Review")


def is_low_score(accuracy: Column, completeness: Column, threshold: float = LOW_SCORE) -> Column:
    return (accuracy < threshold) | (completeness < threshold)


def histogram_bin(score: Column, bins: int = 20) -> Column:
    """Bin number on [0, 1]; 1.0 belongs to the last bin."""
    return F.least(F.lit(bins - 1), F.floor(score * bins).cast("int"))
