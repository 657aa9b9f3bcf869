"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of each whole text are standardised over all documents and mapped to
random cosine features, whose inner products approximate a Gaussian kernel.
Every partition of the labelled rows sums its part of the normal equations for
two folds; the sums give the model and, fold against fold, predictions of rows
that a model has not seen.  A monotone step function of those predictions
(pooled over bins, so of bounded size) turns raw values into shares of label 1.

Null texts count as empty and are scored like any text.  Labels that are null
are left out; a document labelled repeatedly counts with its mean label, 0.5
and more being 1.  Without labels every score is 0.  Repeated documents are
scored one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_loop, stored, texts

STATS = (
    "log_chars", "log_words", "word_length", "long_words", "short_words", "upper", "digits", "marks", "bars", "exclaims", "accents",
    "distinct_words", "top_word", "distinct_lines", "log_line", "marked_words", "word_shape", "stops",
)
_KIND = np.zeros(256, np.uint8)
_KIND[[c for c in range(256) if chr(c).isascii() and chr(c).isupper()]] = 1
_KIND[48:58] = 2
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 3
_KIND[ord("|")] = 4
_KIND[ord("!")] = 5
_KIND[128:] = 6
BINS = 400
INNER_MARK = re.compile(r"\w[^\w\s]+\w|\d\w|[A-Z]\w*[A-Z]")


def statistics(text: str) -> list[float]:
    raw = np.bincount(_KIND[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=7)
    words, lines = text.split(), text.split("\n")
    n, chars = max(1, len(words)), max(1, len(text))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        lengths.mean() if words else 0.0,
        (lengths > 12).mean() if words else 0.0,
        (lengths <= 3).mean() if words else 0.0,
        raw[1] / chars,
        raw[2] / chars,
        raw[3] / chars,
        raw[4] / chars,
        raw[5] / chars,
        raw[6] / chars,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        len(set(lines)) / len(lines),
        np.log1p(chars / len(lines)),
        len(INNER_MARK.findall(text)) / n,
        lengths.std() if words else 0.0,
        (text.count(". ") + text.count(".\n")) / n,
    ]


def document_statistics(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns named in ``keep``, and a column for each of STATS."""

    def make():
        def step(batch):
            x = np.array([statistics(t) for t in texts(batch.column("text"))], float).reshape(-1, len(STATS))
            columns = [batch.column(c) for c in ("doc_id", *keep)] + [pa.array(x[:, i]) for i in range(len(STATS))]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", *keep, *STATS])

        return step

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, F.col("text").cast("string").alias("text"))
    kinds = dict(narrow.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in ("doc_id", *keep)), *(f"{c} double" for c in STATS)])
    return narrow.mapInArrow(arrow_loop(make), schema)


class Fourier:
    """Standardisation and the random cosine features; fixed by its seed and the moments."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, size: int, width: float, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.w = draw.normal(size=(len(mean), size)) / width
        self.shift = draw.uniform(0, 2 * np.pi, size)
        self.scale = np.sqrt(2 / size)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -8, 8)
        return np.hstack([self.scale * np.cos(z @ self.w + self.shift), np.ones((len(x), 1))])


def pool(weights: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence closest to ``values`` (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for w, v in zip(weights.tolist(), values.tolist()):
        blocks.append([w, v, 1])
        while len(blocks) > 1 and blocks[-2][1] > blocks[-1][1]:
            w2, v2, n2 = blocks.pop()
            w1, v1, n1 = blocks[-1]
            blocks[-1] = [w1 + w2, (w1 * v1 + w2 * v2) / (w1 + w2), n1 + n2]
    return np.concatenate([np.full(n, v) for _, v, n in blocks]) if blocks else np.zeros(0)


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((raw + 0.5) / 2 * BINS), 0, BINS - 1).astype(int)


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, held_out: Column, size: int = 192, width: float = 4.0, ridge: float = 1e-4) -> DataFrame:
    """doc_id, held_out and score of every document; labels are learnt from rows where ``learn`` holds.

    ``learn`` and ``held_out`` are conditions on doc_id.  ``size`` random features
    of a Gaussian kernel of that ``width`` (in deviations).
    """
    stats = stored(document_statistics(docs), "quality-statistics")
    moments = stats.agg(*[f(c).alias(f"{c}_{k}") for c in STATS for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    value = lambda k: np.array([moments[f"{c}_{k}"] or 0.0 for c in STATS])
    fourier = Fourier(value("m"), value("s"), size, width)
    marks = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(2)).cast("int")
    rows = stored(stats.where(learn).join(marks, "doc_id").withColumn("fold", fold).select("fold", "y", *STATS), "quality-labelled")

    def sums(batches):
        left, right, n = np.zeros((2, size + 1, size + 1)), np.zeros((2, size + 1)), np.zeros(2)
        for batch in batches:
            z, y, f = fourier(batch[list(STATS)].to_numpy()), batch["y"].to_numpy(), batch["fold"].to_numpy()
            for k in (0, 1):
                zk = z[f == k]
                left[k] += zk.T @ zk
                right[k] += zk.T @ y[f == k]
                n[k] += len(zk)
        for k in (0, 1):
            if n[k]:
                yield pd.DataFrame({"fold": k, "i": range(size + 1), "sums": [np.append(a, [b, n[k]]) for a, b in zip(left[k], right[k])]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": group["fold"][:1], "i": group["i"][:1], "sums": [np.sum(np.stack(group["sums"].to_list()), axis=0)]})

    shape = "fold int, i int, sums array<double>"
    parts = {(r["fold"], r["i"]): r["sums"] for r in rows.mapInPandas(sums, shape).groupBy("fold", "i").applyInPandas(add, shape).collect()}
    total = np.zeros((2, size + 1, size + 3))
    for (k, i), v in parts.items():
        total[k, i] = v

    def solve(t: np.ndarray) -> np.ndarray:
        return np.linalg.solve(t[:, :-2] + ridge * max(1.0, t[0, -1]) * np.eye(size + 1), t[:, -2])

    if not parts:
        return stats.select("doc_id", held_out.alias("held_out"), F.lit(0.0).alias("score"))
    model, other = solve(total.sum(axis=0)), [solve(total[1]), solve(total[0])]

    def binned(batches):
        count, ones = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            z, y, f = fourier(batch[list(STATS)].to_numpy()), batch["y"].to_numpy(), batch["fold"].to_numpy()
            at = _bin(np.where(f == 0, z @ other[0], z @ other[1]))
            count += np.bincount(at, minlength=BINS)
            ones += np.bincount(at, weights=y, minlength=BINS)
        used = np.flatnonzero(count)
        yield pd.DataFrame({"bin": used, "n": count[used], "ones": ones[used]})

    bins = sorted(tuple(r) for r in rows.mapInPandas(binned, "bin int, n double, ones double").groupBy("bin").agg(F.sum("n"), F.sum("ones")).collect())
    place, n, ones = (np.array(c, float) for c in zip(*bins))
    level = pool(n, ones / n)
    centre = (place + 0.5) / BINS * 2 - 0.5

    def scored(batches):
        for batch in batches:
            raw = fourier(batch[list(STATS)].to_numpy()) @ model
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": np.clip(np.interp(raw, centre, level), 0, 1)})

    return stats.select("doc_id", held_out.alias("held_out"), *STATS).mapInPandas(scored, "doc_id long, held_out boolean, score double")
