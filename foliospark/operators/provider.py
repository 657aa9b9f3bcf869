"""Hook for a user's own parser, classifier or scorer.

A provider is a function from a pandas Series of inputs to a Series of JSON
text.  It runs in Arrow batches on the executors; when a batch fails, its rows
are tried one by one so that one bad input only marks its own row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

Provider = Callable[[pd.Series], pd.Series]


def apply_provider(df: DataFrame, column: str, provider: Provider, result: str = "result") -> DataFrame:
    """Add the provider's answer and an error text, one of which is null."""

    @F.pandas_udf(T.StructType([T.StructField(result, T.StringType()), T.StructField("error", T.StringType())]))
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for values in batches:
            try:
                yield pd.DataFrame({result: provider(values).to_numpy(), "error": None})
            except Exception:
                yield pd.DataFrame([_one(provider, v) for v in values], columns=[result, "error"])

    answer = call(F.col(column)).alias("_answer")
    return df.select("*", answer).select(
        *df.columns, F.col(f"_answer.{result}").alias(result), F.substring("_answer.error", 1, 1900).alias("error")
    )


def _one(provider: Provider, value) -> tuple[str | None, str | None]:
    try:
        return provider(pd.Series([value])).iloc[0], None
    except Exception as problem:
        return None, str(problem)
