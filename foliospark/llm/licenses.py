"""License scan by diagonal voting of word k-grams.

Texts and templates are normalised to words (A-Z in lower case; a word is a run of
digits, letters a-z and characters beyond ASCII).

1. Every text goes out as pieces of bounded length with the rolling hashes of all
   its k-grams.  A template of fewer than ``GRAM`` words is one gram.
2. Spark joins all hashes to the positions of the same gram in the templates; a
   match of hashes counts only if the words are equal too.
3. Matches are counted by diagonal (place in the text minus place in the
   template).  Words that were put in or left out move a match to a neighbouring
   diagonal, so diagonals of one template at most ``drift`` apart are merged.
4. A merged group is verified: the template words that it covers must be at least
   ``coverage`` of the template, and at least half of the words of its span.  Of
   notices whose spans overlap only the best covered stay, so "version 3" is not
   also taken for "version 2".

Templates are rows (template, label, base, text); they are few and bounded
(``MOST_TEMPLATE_WORDS``), so they are sent to every task.  A base template counts
only as a whole.  A null text is empty; rows with one id and different texts are
told apart by a digest of the text; repeated rows give repeated results.  An
empty table gives no rows; other columns of the documents are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_loop, list_array, text_key, texts

#: Words of a gram, and of a piece of a long text.
GRAM, PIECE = 4, 1 << 14
#: Templates beyond this are refused, since they are sent to every task.
MOST_TEMPLATE_WORDS = 1 << 20
#: The least part of a template, and of a span, that must be covered.
COVERAGE, DENSITY = 0.7, 0.5

# Phrases and labels that users search for, and the opening words of public licenses.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICES = {
    "licensed under the apache license version 2.0": "apache-2.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under cc by 4.0": "cc-by-4.0",
    "licensed under cc by sa 4.0": "cc-by-sa-4.0",
    "licensed under cc by nc 4.0": "cc-by-nc-4.0",
    "creative commons attribution 4.0 international license": "cc-by-4.0",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-notice",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.random.default_rng(11).integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)


class Words:
    """The words of some texts: their bytes, end to end, and the number of each text."""

    def __init__(self, batch: list[str]):
        raw = [t.encode("utf-8", "replace") for t in batch]
        data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
        inside = data != 32
        edge = np.diff(inside.astype(np.int8), prepend=0)
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        text_ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
        self.counts = np.diff(np.searchsorted(begins, text_ends), prepend=0)
        self.data, self.sizes = data[inside], ends - begins

    def strings(self) -> pa.Array:
        at = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int32)
        return pa.StringArray.from_buffers(len(self.sizes), pa.py_buffer(at), pa.py_buffer(self.data))

    def hashes(self) -> np.ndarray:
        if not len(self.sizes):
            return np.zeros(0, np.uint64)
        first = np.cumsum(self.sizes) - self.sizes
        place = np.arange(len(self.data)) - np.repeat(first, self.sizes)
        powers = np.full(int(self.sizes.max()), _BASE)
        powers[0] = 1
        terms = (self.data.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(powers)[place]
        return np.add.reduceat(terms, first) * _ODD[63] + self.sizes.astype(np.uint64) * _ODD[62]


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words that begin at each place."""
    out = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        out = out * _BASE + (words[k : k + len(out)] ^ (words[k : k + len(out)] >> np.uint64(29)))
    return (out * _ODD[size % 60]).view(np.int64)


def pieces(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, text_key, base (words before), words and for each size the hashes of all grams that start in the piece.

    A piece has PIECE starts; its last words are repeated in the next one, so every gram is in one piece.
    """
    more = max(sizes) - 1

    def make():
        def step(batch):
            found = Words(texts(batch.column("text")))
            strings, hashed = found.strings(), found.hashes()
            ends = np.cumsum(found.counts)
            rows, bases, begins, stops, starts = [], [], [], [], []
            for row, (a, b) in enumerate(zip((ends - found.counts).tolist(), ends.tolist())):
                for at in range(a, b, PIECE):
                    rows.append(row), bases.append(at - a), begins.append(at)
                    starts.append(min(b, at + PIECE)), stops.append(min(b, at + PIECE + more))
            if not rows:
                return None
            begin, stop, start = (np.array(x, np.int64) for x in (begins, stops, starts))
            grams, lengths = [], np.zeros((len(rows), len(sizes)), np.int64)
            every = {k: rolling(hashed, k) for k in sizes}
            for i, (a, b, s) in enumerate(zip(begins, stops, starts)):
                for j, k in enumerate(sizes):
                    part = every[k][a : max(a, min(s, b - k + 1))]
                    grams.append(part)
                    lengths[i, j] = len(part)
            inner = list_array(np.concatenate(grams), lengths.ravel(), pa.int64())
            outer = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(sizes)), inner)
            long = stop - begin
            take = np.arange(int(long.sum())) + np.repeat(begin - (np.cumsum(long) - long), long)
            words = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(long)]).astype(np.int32)), strings.take(pa.array(take)))
            same = pa.array(rows)
            columns = [batch.column("doc_id").take(same), batch.column("text_key").take(same), pa.array(bases, pa.int64()), words, outer]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "base", "words", "grams"])

        return step

    return _narrow(docs).mapInArrow(arrow_loop(make), "doc_id long, text_key binary, base long, words array<string>, grams array<array<long>>")


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), text_key(text).alias("text_key"))


def word_counts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and n_words of every row."""

    def make():
        def step(batch):
            counts = Words(texts(batch.column("text"))).counts
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64())], ["doc_id", "text_key", "n_words"])

        return step

    return _narrow(docs).mapInArrow(arrow_loop(make), "doc_id long, text_key binary, n_words long")


def templates(spark: SparkSession, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> DataFrame:
    rows = [(n, label, is_base, text) for n, (text, label, is_base) in enumerate([*((t, b, True) for t, b in base.items()), *((t, b, False) for t, b in notices.items())])]
    return spark.createDataFrame(rows, "template int, label string, base boolean, text string")


def positions(spark: SparkSession, known: DataFrame, gram: int = GRAM) -> tuple[DataFrame, list[int]]:
    """The grams of all templates with their places, and the sizes of grams that occur."""
    rows = []
    for t in known.limit(MOST_TEMPLATE_WORDS + 1).collect():
        found = Words([t["text"] or ""])
        words, hashed = found.strings().to_pylist(), found.hashes()
        k = min(gram, len(words))
        if k:
            rows += [(int(h), words[i : i + k], k, i, t["template"], t["label"], t["base"], len(words)) for i, h in enumerate(rolling(hashed, k).tolist())]
    if len(rows) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words")
    schema = "gram long, gram_words array<string>, k int, at int, template int, label string, base_label boolean, template_words int"
    return spark.createDataFrame(rows, schema), sorted({r[2] for r in rows}) or [1]


DOC = ["doc_id", "text_key"]


def votes(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, text_key, template and diagonal, with the template places (sorted) that vote for it."""
    where, sizes = positions(docs.sparkSession, known)
    split = pieces(docs, sizes).select(*DOC, "base", "words", F.explode("grams").alias("each"))
    every = split.select(*DOC, "base", "words", F.posexplode("each").alias("p", "gram"))
    same = F.slice("words", F.col("p") + 1, F.col("k")) == F.col("gram_words")
    matched = every.join(F.broadcast(where), "gram").where(same)
    diagonal = F.col("base") + F.col("p") - F.col("at")
    shape = ["template", "label", "base_label", "template_words", "k"]
    return matched.groupBy(*DOC, *shape, diagonal.alias("diagonal")).agg(F.array_sort(F.collect_set("at")).alias("places"))


def spans(docs: DataFrame, known: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Verified places of templates: doc_id, text_key, template, label, base_label, start, end (words, inclusive) and covered (0 to 1)."""
    one = Window.partitionBy(*DOC, "template").orderBy("diagonal")
    drift = F.when(F.col("base_label"), 0).otherwise(F.least(F.lit(8), F.floor(F.col("template_words") / 4)))
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(one) > drift, F.lit(True))
    merged = votes(docs, known).withColumn("apart", apart).withColumn("part", F.sum(F.col("apart").cast("int")).over(one))
    shape = ["template", "label", "base_label", "template_words", "k"]
    grams = F.transform("places", lambda at: F.struct((F.col("diagonal") + at).alias("start"), at.alias("at")))
    grouped = merged.groupBy(*DOC, *shape, "part").agg(F.flatten(F.collect_list(grams)).alias("grams"))
    last = F.col("k") - 1

    def covered(field):
        return F.size(F.array_distinct(F.flatten(F.transform("grams", lambda g: F.sequence(g[field], g[field] + last)))))

    checked = grouped.select(
        *DOC,
        *shape,
        F.array_min(F.col("grams.start")).alias("start"),
        (F.array_max(F.col("grams.start")) + last).alias("end"),
        covered("at").alias("template_hit"),
        covered("start").alias("text_hit"),
    )
    part = F.col("template_hit") / F.col("template_words")
    whole = part >= F.when(F.col("base_label"), 1.0).otherwise(coverage)
    dense = F.col("text_hit") >= DENSITY * (F.col("end") - F.col("start") + 1)
    found = checked.where(whole & dense).select(*DOC, "template", "label", "base_label", "start", "end", part.alias("covered"))
    notices = Window.partitionBy(*DOC, "base_label").orderBy("start", "end", "template")
    before = F.max("end").over(notices.rowsBetween(Window.unboundedPreceding, -1))
    chained = found.withColumn("apart", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    chained = chained.withColumn("chain", F.sum("apart").over(notices.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.max("covered").over(Window.partitionBy(*DOC, "base_label", "chain"))
    return chained.withColumn("best", best).where("base_label OR covered = best").select(found.columns)


def scan(docs: DataFrame, known: DataFrame | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row for every row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    known = templates(docs.sparkSession) if known is None else known
    base = lambda c: F.when(F.col("base_label"), F.col(c))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = spans(docs, known, coverage).groupBy(*DOC).agg(
        F.count(base("start")).alias("n_base"), F.min(base("start")).alias("first_word"), F.max(base("start")).alias("last_word"),
        listed(base("label")).alias("base_labels"), listed("label").alias("labels"), F.max("covered").alias("score"),
    )
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), *found.columns[2:])
    counts = word_counts(docs)
    joined = counts.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    filled = {"n_base": F.lit(0).cast("long"), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    columns = ("n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return joined.select("doc_id", "n_words", *[F.coalesce(c, filled[c]).alias(c) if c in filled else c for c in columns])
