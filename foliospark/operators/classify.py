"""Document classification."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import term_count, tokens
from ..schemas import conform
from ..seeds import CLASS_WORDS, ClassWord
from .provider import Provider, apply_provider

# Fixed value: the class stored for a text that could not be classified.
ERROR_CLASS = "classification_error"


def classifiable(parsed: DataFrame) -> DataFrame:
    """Parsed documents with text that are not classified yet."""
    return parsed.filter(
        (F.col("status") == "parsed") & F.col("parsed_content").isNotNull() & (F.length(F.trim("content_text")) > 0)
    )


def class_scores(text: str, words: Sequence[ClassWord] = CLASS_WORDS) -> list[tuple[str, Column]]:
    """Weighted word counts per class, all within the document's own row.

    Single words are looked up in the tokens (column ``_tokens``); terms with
    other characters in them are counted in the text.
    """
    by_class: dict[str, dict[float, list[str]]] = {}
    for w in words:
        by_class.setdefault(w.document_class, {}).setdefault(float(w.weight), []).append(w.term.lower())
    scores = []
    for name in sorted(by_class):
        parts = []
        for weight, terms in sorted(by_class[name].items()):
            single = [t for t in terms if t.isalnum()]
            other = [t for t in terms if not t.isalnum()]
            if single:
                parts.append(F.size(F.filter("_tokens", lambda t: t.isin(*single))) * F.lit(weight))
            if other:
                parts.append(term_count(F.col(text), other) * F.lit(weight))
        scores.append((name, reduce(lambda a, b: a + b, parts).cast("double")))
    return scores


def ranked_classes(text: str, words: Sequence[ClassWord] = CLASS_WORDS) -> Column:
    """Array of (score, order, class), ordered so that its maximum is the winner."""
    entries = [
        F.struct(score.alias("score"), F.lit(-i).alias("order"), F.lit(name).alias("name"))
        for i, (name, score) in enumerate(class_scores(text, words))
    ]
    return F.array(*entries)


def with_best_class(
    df: DataFrame, text: str, words: Sequence[ClassWord] = CLASS_WORDS, default: str = "other"
) -> DataFrame:
    """Add ``document_class``, ``class_score`` and ``confidence`` (share of all class evidence).

    The highest score wins, ties go to the first class by name, and a document
    without evidence gets the default.  Everything is computed inside the row,
    so classification needs no shuffle however large the corpus is.
    """
    ranked = df.withColumn("_tokens", tokens(F.col(text))).withColumn("_ranked", ranked_classes(text, words)).drop("_tokens")
    best = F.array_max("_ranked")
    total = F.aggregate("_ranked", F.lit(0.0), lambda acc, x: acc + x["score"])
    return (
        ranked.withColumns({"_best": best, "_all": total})
        .withColumns(
            {
                "document_class": F.when(F.col("_best.score") > 0, F.col("_best.name")).otherwise(default),
                "class_score": F.col("_best.score"),
                "confidence": F.when(F.col("_all") > 0, F.round(F.col("_best.score") / F.col("_all"), 4)).otherwise(0.0),
            }
        )
        .drop("_ranked", "_best", "_all")
    )


def classify(
    parsed: DataFrame, as_of: datetime, words: Sequence[ClassWord] = CLASS_WORDS, provider: Provider | None = None
) -> DataFrame:
    """Classification rows for every classifiable document.

    A provider returns a label, plain or as JSON, per text; a text it fails on is
    stored under the error class.
    """
    todo = classifiable(parsed)
    if provider is None:
        scored = with_best_class(todo, "content_text", words)
    else:
        scored = apply_provider(todo, "content_text", provider, "document_class").withColumns(
            {
                "document_class": F.when(F.col("error").isNotNull(), ERROR_CLASS).otherwise(F.col("document_class")),
                "confidence": F.lit(None).cast("double"),
            }
        )
    return conform(
        scored.withColumns(
            {"classification_confidence": F.col("confidence"), "classification_timestamp": F.lit(as_of)}
        ),
        "document_classifications",
    )


def nearest_centroid(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Label of the closest class mean by cosine, for every vector.

    Class means are a partial aggregate per (label, dimension); the bounded set
    of means is compared with whole Arrow batches of vectors.
    """
    from .search import nearest_row

    means = class_means(vectors, vector_col, label_col)
    return nearest_row(vectors, means, id_col, vector_col, label_col, "mean")


def class_means(vectors: DataFrame, vector_col: str, label_col: str) -> DataFrame:
    """Mean vector per label."""
    cells = vectors.select(label_col, F.posexplode(vector_col).alias("dim", "x"))
    per_dim = cells.groupBy(label_col, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return per_dim.groupBy(label_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda c: c["m"]).alias("mean")
    )


def train_text_classifier(texts: DataFrame, text_col: str, label_col: str, features: int = 1 << 15):
    """Fitted Spark ML text model for a binary or multi-class label."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer

    words = RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"[^\p{L}\p{N}]+")
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features)
    weights = IDF(inputCol="_counts", outputCol="features")
    model = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=20)
    return Pipeline(stages=[words, counts, weights, model]).fit(texts)
