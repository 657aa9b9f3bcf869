"""Removal of benchmark passages, found with a suffix automaton of the test items.

Items and texts are normalised to words (A-Z in lower case; a word is a run of
digits, letters a-z and characters beyond ASCII).  A generalised automaton of
all items' words is what a text is streamed through: at every word it knows the
longest stretch, ending there, that occurs in an item.  Once that reaches the
window (``window`` words, or a whole item that is shorter), the words are hit,
and the automaton's state tells the items.

Before streaming, arrays rule out words that are in no item and pairs of words
that follow each other in no item, where the longest match is one word at most.

Items go out in slices of bounded size (``slice_bytes``); more items mean more
passes.  Items without words, or with a null id, match nothing.  A null or empty
text has no words.  Documents with repeated or null ids are marked row by row.
Empty tables are fine on both sides; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_loop, stored, texts

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(rb"[^ ]+")
MARKED = "doc_id long, key string, n_words long, spans array<struct<start:bigint,length:bigint>>, items array<string>"


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_LOWER).split()


class Automaton:
    """Suffix automaton of the word sequences of all items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        pairs, ends = set(), []
        self.shortest, self.single = window, {}
        for item, ws in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]
            if not ids:
                continue
            pairs.update(zip(ids, ids[1:]))
            at, path = 0, []
            for w in ids:
                at = self._extend(at, w)
                path.append(at)
            ends.append((item, ids))
            if len(ids) == 1:
                self.single.setdefault(ids[0], set()).add(item)
            else:
                self.shortest = min(self.shortest, len(ids))
        n = len(self.vocabulary)
        self.pairs = np.array(sorted(a * n + b for a, b in pairs), np.int64)
        # Items by state: each item's prefixes, handed down to shorter suffixes.
        self.items: list[set[str]] = [set() for _ in self.next]
        own_short: dict[int, list[tuple[int, str]]] = {}
        for item, ids in ends:
            at = 0
            for w in ids:
                at = self.next[at][w]
                self.items[at].add(item)
            if 1 < len(ids) < window:
                own_short.setdefault(at, []).append((len(ids), item))
        order = sorted(range(1, len(self.next)), key=lambda s: self.length[s])
        for s in reversed(order):
            if self.link[s] > 0:
                self.items[self.link[s]] |= self.items[s]
        self.short: list[list[tuple[int, str]]] = [[] for _ in self.next]
        for s in order:
            self.short[s] = self.short[self.link[s]] + own_short.get(s, [])

    def _extend(self, last: int, w: int) -> int:
        """Append a word to the sequence that ends in ``last``; the state of the longer one."""
        if w in self.next[last]:
            there = self.next[last][w]
            return there if self.length[there] == self.length[last] + 1 else self._clone(last, w, there)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            there = self.next[at][w]
            self.link[new] = there if self.length[there] == self.length[at] + 1 else self._clone(at, w, there)
        return new

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _clone(self, at: int, w: int, there: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.next[there]))
        self.link[copy], self.link[there] = self.link[there], copy
        while at >= 0 and self.next[at].get(w) == there:
            self.next[at][w] = copy
            at = self.link[at]
        return copy

    def stream(self, ids: list[int], start: int, hit: np.ndarray, found: set[str]):
        """Follow ``ids``, which begin at word ``start`` of a text; mark ``hit`` and collect items."""
        at = match = 0
        moves, link, length, window = self.next, self.link, self.length, self.window
        for i, w in enumerate(ids, start):
            while at and w not in moves[at]:
                at = link[at]
                match = length[at]
            if w in moves[at]:
                at = moves[at][w]
                match += 1
            if match >= window:
                state = at
                while length[link[state]] >= window:
                    state = link[state]
                found |= self.items[state]
                hit[i - window + 1 : i + 1] = True
            for size, item in self.short[at]:
                if size <= match:
                    found.add(item)
                    hit[i - size + 1 : i + 1] = True

    def mark(self, batch: list[list[bytes]]) -> list[tuple[np.ndarray, set[str]] | None]:
        """For each text (as words): which words are hit and the items found; None without hits."""
        get = self.vocabulary.get
        sizes = [len(ws) for ws in batch]
        # One place between texts holds no word, so nothing reaches from text to text.
        ids = np.array([i for ws in batch for i in (*[get(w, -1) for w in ws], -1)], np.int64)
        starts = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
        out: list[tuple[np.ndarray, set[str]] | None] = [None] * len(batch)

        def at(place: int) -> tuple[int, np.ndarray, set[str]]:
            t = int(np.searchsorted(starts, place, "right")) - 1
            if out[t] is None:
                out[t] = np.zeros(sizes[t], bool), set()
            return int(starts[t]), *out[t]

        for w, items in self.single.items():
            for place in np.flatnonzero(ids == w).tolist():
                begin, hit, found = at(place)
                hit[place - begin] = True
                found |= items
        if len(self.pairs) and len(ids) > 1:
            known = (ids[:-1] >= 0) & (ids[1:] >= 0)
            places = np.flatnonzero(known)
            key = ids[places] * len(self.vocabulary) + ids[places + 1]
            slot = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            places = places[self.pairs[slot] == key]
            # Stretches of such pairs; a stretch of n pairs has n + 1 words.
            breaks = np.flatnonzero(np.diff(places, prepend=-2) != 1)
            lengths = np.diff(np.append(breaks, len(places))) + 1
            for a, n in zip(places[breaks].tolist(), lengths.tolist()):
                if n >= self.shortest:
                    begin, hit, found = at(a)
                    self.stream(ids[a : a + n].tolist(), a - begin, hit, found)
        return [m if m is not None and m[1] else None for m in out]


def _spans(hit: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]


def _item_slices(items: DataFrame, slice_bytes: int) -> list[list[tuple[str, list[bytes]]]]:
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = max(1, -(-int(1.2 * total) // slice_bytes))
    for s in range(n):
        yield [(r["item_id"], words(r["text"])) for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == s).collect()]


def mark(docs: DataFrame, items: DataFrame, window: int = 10, slice_bytes: int = 512 << 10) -> DataFrame:
    """doc_id, n_words, spans of hit words (start, length) and items (sorted ids) for every row of ``docs``."""
    return _marks(docs, items, window, slice_bytes).drop("key")


def _key(text) -> Column:
    """What tells texts of one id, or of none, apart; null for a null text."""
    return F.sha2(text.cast("string"), 256)


def _marks(docs: DataFrame, items: DataFrame, window: int, slice_bytes: int = 512 << 10) -> DataFrame:
    """What ``mark`` gives, and the key of each row's text."""
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _key(F.col("text")).alias("key"))
    passes = []
    for part in _item_slices(items, slice_bytes):
        sent = spark.sparkContext.broadcast(Automaton(part, window))

        def make(sent=sent):
            automaton = sent.value

            def step(batch):
                found = [words(t) for t in texts(batch.column("text"))]
                marks = automaton.mark(found)
                columns = [
                    batch.column("doc_id"),
                    batch.column("key"),
                    pa.array([len(ws) for ws in found], pa.int64()),
                    pa.array([_spans(m[0]) if m else [] for m in marks], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                    pa.array([sorted(m[1]) if m else [] for m in marks], pa.list_(pa.string())),
                ]
                return pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_words", "spans", "items"])

            return step

        passes.append(narrow.mapInArrow(arrow_loop(make), MARKED))
    if len(passes) == 1:
        return passes[0]
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p)
    # Rows with one id and text are alike in every pass; as many as there were come out.
    return every.groupBy("doc_id", "key").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), (F.count("*") / len(passes)).cast("int").alias("rows"),
    ).withColumn("spans", _joined("spans")).withColumn("rows", F.explode(F.array_repeat(F.lit(0), F.col("rows")))).drop("rows")


def _joined(spans: str):
    """Sorted spans with overlapping and touching ones made one."""
    kind = "array<struct<start:bigint,length:bigint>>"
    end = lambda s: s["start"] + s["length"]

    def step(acc, s):
        last = F.try_element_at(acc, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), (F.greatest(end(last), end(s)) - last["start"]).alias("length"))
        touches = (F.size(acc) > 0) & (s["start"] <= end(last))
        return F.when(touches, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(spans, F.array().cast(kind), step)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans``: from the first byte of the first word to the last of the last."""
    raw = text.encode("utf-8", "replace")
    places = [(m.start(), m.end()) for m in WORD.finditer(raw.translate(_LOWER))]
    out, at = [], 0
    for start, length in spans:
        out.append(raw[at : places[start][0]])
        at = places[start + length - 1][1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "replace")


def remove(docs: DataFrame, items: DataFrame, window: int = 10, most_coverage: float = 0.5) -> DataFrame:
    """``docs`` without hit spans; documents with more than ``most_coverage`` of their words hit are left out.

    The columns of ``docs`` stay; ids may be null or repeated.  Only texts with
    hits are read again in Python.
    """
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
    hits = _marks(docs, items, window).where(F.size("spans") > 0).select(F.struct("doc_id", "key").alias("hit"), "spans", (hit > F.lit(most_coverage) * F.col("n_words")).alias("drop"))
    hits = stored(hits, "decontaminate-hits").dropDuplicates(["hit"])

    @F.pandas_udf("string")
    def without(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut(t, [(int(s["start"]), int(s["length"])) for s in ss]) for t, ss in zip(text, spans)], dtype=object)

    # Whole rows travel as one column, so no name of theirs can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.struct(F.col("doc_id").cast("long").alias("doc_id"), _key(F.col("text")).alias("key")).alias("hit"))
    own = lambda c: F.col(f"row.`{c}`")
    clean = keyed.join(hits.select("hit"), "hit", "left_anti").select(*[own(c) for c in docs.columns])
    touched = keyed.join(hits.where(~F.col("drop")), "hit")
    return clean.unionByName(touched.select(*[without(own("text").cast("string"), "spans").alias("text") if c == "text" else own(c) for c in docs.columns]))
