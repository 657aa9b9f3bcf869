"""Audit of how filters interact: what each removes, in every order of application.

The state after some filters is the set of those filters, a node of the subset
lattice; an edge adds one filter and removes the rows that fail it and none of the
filters before.  That depends on the set alone, not on the order within it, so all
orders read their steps from the same edges.  Forward counts say how many orders
reach a state, backward counts how many lead on from it to the full set; the
product over an edge is the number of orders that pass it, the weight of its
removals in the Shapley sum.

Rows are counted by part and by the set of filters that they fail, which is all
that edges need: at most 2^n rows a part, whatever the size of the input.

``flags`` gives each document its failed filters as a bit mask.  A null text is
empty.  A row is a copy if a row with a smaller id has the same text; rows that
share the smallest id, and rows with a null id, are none.  An id with several
labels counts as the highest of each.  Empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_loop, distinct, stored

NAMES = "ABCDE"
#: Orders grow with the factorial of the number of filters.
MOST_FILTERS = 7
#: Thresholds of the text filters A, B and C.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
SYMBOLS = "[#$%&*|]"


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """For every subset of ``n`` filters, the number of orders that reach it and that leave it for the full set."""
    states = range(1 << n)
    forward, backward = [0] * len(states), [0] * len(states)
    forward[0] = backward[-1] = 1
    for state in states:
        for f in range(n):
            if state >> f & 1:
                forward[state] += forward[state ^ (1 << f)]
    for state in reversed(states):
        for f in range(n):
            if not state >> f & 1:
                backward[state] += backward[state | (1 << f)]
    return forward, backward


def _masks(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Failed text filters (A to D) of each row."""
    text = pc.fill_null(batch.column("text"), "")
    split = pc.ascii_split_whitespace(text)
    rows = np.asarray(pc.list_parent_indices(split), np.int64)
    words = split.flatten()
    real = np.asarray(pc.binary_length(words)) > 0
    codes = np.asarray(words.dictionary_encode().indices, np.int64)[real]
    rows = rows[real]
    n = len(text)
    count = np.bincount(rows, minlength=n)
    most = int(codes.max(initial=0)) + 1
    different = np.bincount(distinct(rows * most + codes) // most, minlength=n)
    capitals = np.asarray(pc.count_substring_regex(text, "[A-Z]"), np.int64)
    points = np.asarray(pc.utf8_length(text), np.int64)
    symbol = np.asarray(pc.match_substring_regex(text, SYMBOLS))
    failed = (count < LEAST_WORDS, 100 * different < DISTINCT_PERCENT * count, 100 * capitals > CAPITAL_PERCENT * points, symbol)
    mask = sum((f.astype(np.int64) << i for i, f in enumerate(failed)), np.zeros(n, np.int64))
    names = ["doc_id", "part", "text_key"]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(mask, pa.int32())], [*names, "mask"])


def flags(docs: DataFrame) -> DataFrame:
    """doc_id, part (lang; null: empty) and mask, bit i for the i-th filter of NAMES, of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("text_key"))
    rows = stored(narrow.mapInArrow(arrow_loop(lambda: _masks), "doc_id long, part string, text_key binary, mask int"), "audit-rows")
    # The first id of each text, joined by text and id: copies of a text have ids of their own, so none is a hot key.
    first = rows.where("doc_id IS NOT NULL").groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    joined = rows.join(first, ["text_key", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return joined.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(copy, 1 << 4).otherwise(0)).alias("mask"))


def counted(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good and toxic: rows by failed filters, and those of them with the labels quality=1 and toxic=1."""
    # Rows of one id are counted before the join, so neither a null nor a frequent id is a hot key.
    ids = flagged.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    marked = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marked = marked.agg(F.max((F.col("quality") == 1).cast("long")).alias("q"), F.max((F.col("toxic") == 1).cast("long")).alias("t"))
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)) * F.col("n"))
    return ids.join(marked, "doc_id", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), total("q").alias("good"), total("t").alias("toxic"))


def edges(counts: DataFrame, names: str = NAMES) -> DataFrame:
    """For every part and edge with removals: before (state), filter, removed, good, toxic; weight is the number of orders through it."""
    n = len(names)
    forward, backward = path_counts(n)
    every = [(s, f, forward[s] * backward[s | (1 << f)]) for s in range(1 << n) for f in range(n) if not s >> f & 1]
    listed = F.array(*[F.struct(F.lit(s).alias("before"), F.lit(f).alias("filter"), F.lit(w).cast("long").alias("weight")) for s, f, w in every])
    passed = lambda e: (F.col("mask").bitwiseAND(e["before"]) == 0) & (F.call_function("shiftright", F.col("mask"), e["filter"]).bitwiseAND(1) == 1)
    on_edge = counts.select("part", "n", "good", "toxic", F.inline(F.filter(listed, passed)))
    return on_edge.groupBy("part", "before", "filter", "weight").agg(F.sum("n").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))


def _steps(names: str) -> Column:
    """All steps of all orders as an array literal: order, step, filter and the state before."""
    out = []
    for order in permutations(range(len(names))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(f"{''.join(names[i] for i in order)} {step} {f} {before}")
            before |= 1 << f
    part = lambda i: lambda s: F.element_at(F.split(s, " "), i)
    rows = F.split(F.lit("\n".join(out)), "\n")
    return F.transform(rows, lambda s: F.struct(part(1)(s).alias("filter_order"), part(2)(s).cast("int").alias("step"), part(3)(s).cast("int").alias("filter"), part(4)(s).cast("int").alias("before")))


def audit(flagged: DataFrame, labels: DataFrame, names: str = NAMES) -> DataFrame:
    """One row for each part of ``flagged`` (doc_id, part, mask), order of the filters and step.

    part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley (the filter's removals summed over all orders).
    """
    if len(names) > MOST_FILTERS:
        raise ValueError(f"{factorial(len(names))} orders; at most {MOST_FILTERS} filters")
    counts = stored(counted(flagged, labels), "audit-counts")
    n = len(names)
    on_edges = edges(counts, names)
    shapley = on_edges.groupBy("part", "filter").agg(F.sum(F.col("weight") * F.col("removed")).alias("shapley"))
    failing = counts.select("part", "n", "mask", F.explode(F.array(*[F.lit(f) for f in range(n)])).alias("filter"))
    bit = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    hit = F.col("mask").bitwiseAND(bit) != 0
    alone = F.sum(F.when(F.col("mask") == bit, F.col("n")).otherwise(0))
    filters = failing.groupBy("part", "filter").agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("fails"), alone.alias("unique_fails"), F.sum("n").alias("rows"))
    steps = filters.groupBy("part").agg(F.max("rows").alias("rows")).select("part", "rows", F.inline(_steps(names)))
    joined = steps.join(filters.drop("rows"), ["part", "filter"]).join(shapley, ["part", "filter"], "left").join(on_edges.drop("weight"), ["part", "before", "filter"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    removed = zero("removed")
    # What is kept after a step is what its order has not removed so far.
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    return joined.select(
        "part",
        "filter_order",
        "step",
        (F.col("rows") - F.sum(removed).over(so_far)).cast("long").alias("kept"),
        removed.alias("removed"),
        (F.col("fails") - removed).cast("long").alias("redundant"),
        F.col("unique_fails").cast("long").alias("unique_fails"),
        zero("good_lost").alias("good_lost"),
        zero("toxic_lost").alias("toxic_lost"),
        zero("shapley").alias("shapley"),
    )
