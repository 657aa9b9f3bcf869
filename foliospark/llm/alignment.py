"""Alignment of two tokenizers over the same texts.

1. Texts are shuffled by full text, and each distinct one is tokenised and aligned
   once, with the number of rows that hold it.
2. A text is cut at blanks between a visible character and a letter.  Neither
   tokenizer has a token across such a place (the byte-level pattern starts a token
   there, and no piece holds a blank inside, which is checked), so both end a token
   there and the parts can be aligned alone.  A part's tokens and links are computed
   when it is first seen by a worker.
3. Byte offsets where tokens of both end cut a part into groups; each A token of a
   group is linked with each B token of it.
4. A block of some megabytes of texts gives out the distinct id pairs of its texts,
   weighted by the rows that hold them.  These are added up over all blocks, and the
   sums go back to the blocks by a join, so no table of all pairs is sent anywhere.
5. Measures are joined to doc_ids by a digest of the text and a salt of the id: a
   text says which salts its rows have, so many copies are many keys.

Texts that are null or empty, or whose tokens do not spell a blank and the text,
have no tokens.  Rows with null or repeated ids are rows of their own.  An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct, give_back, list_array, offsets, slices, stored

#: Bytes of text in a block, characters of parts that a worker remembers, and salts of a text's rows.
BLOCK_BYTES, REMEMBERED, SALTS = 2 << 20, 5 << 19, 60
PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ](?s:.*)(?<=[!-~À-ÖØ-öø-ÿ])\Z")
#: Parts that are tokenised at a time.
TOGETHER = 512
#: An id of A and one of B as one number.
SHIFT = 1 << 20


def cut_texts(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The parts of all texts (no null, none empty), and the number of parts of each text.

    A blank goes if a visible character of ASCII or a letter of Latin-1 stands before it, and a letter of either behind it.
    """
    column = column.cast(pa.large_string())
    _, places, data = column.buffers()
    borders = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    text = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]]
    borders = borders - borders[0]
    # A blank at the edge of a text has no neighbour.
    edge = np.zeros(len(text) + 1, bool)
    edge[borders] = True
    at = np.flatnonzero(text == ord(" "))
    at = at[~(edge[at] | edge[at + 1])]
    latin = lambda lead, last: (lead == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
    before, after = text[at - 1], text[at + 1]
    visible = (before >= ord("!")) & (before <= ord("~")) | latin(text[np.maximum(at - 2, 0)], before)
    letter = ((after | 32) >= ord("a")) & ((after | 32) <= ord("z")) | latin(after, text[np.minimum(at + 2, max(0, len(text) - 1))])
    at = at[visible & letter]
    starts = np.sort(np.concatenate([borders, at]))
    # The blanks themselves belong to no part.
    starts -= np.searchsorted(at, starts)
    kept = np.delete(text, at)
    parts = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(kept))
    return parts, np.diff(np.searchsorted(at, borders)) + 1


class Aligner:
    """Tokens, groups and links of parts of texts; one per task."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        # A task has one core; threads of the library would take those of other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = _bytes_a(self.a), _bytes_b(self.b)
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        if max(len(self.size_a), len(self.size_b)) > SHIFT:
            raise ValueError(f"vocabularies of at most {SHIFT} ids")
        self.forget()

    def forget(self):
        self.index: dict[str, int] = {}
        self.characters = 0
        self.groups: list[str] = []
        self.good = np.zeros(0, bool)
        #: n_a, n_b, n_groups and n_links of each part.
        self.counts = np.zeros((0, 4), np.int64)
        self.starts, self.pairs, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def codes(self, parts: list[str]) -> list[int]:
        new = [p for p in dict.fromkeys(parts) if p not in self.index]
        if new:
            self._add(new)
        return list(map(self.index.__getitem__, parts))

    def _add(self, new: list[str]):
        # Parts that may follow each other in a text are tokenised as one, which ends a token after each of them.
        alone = [PLAIN.match(p) is None for p in new]
        plain = [p for p, a in zip(new, alone) if not a]
        new = plain + list(compress(new, alone))
        raw = [b" " + p.encode() for p in new]
        found, good = [], np.ones(len(new), bool)
        for i in range(0, len(plain), TOGETHER):
            stop = min(i + TOGETHER, len(plain))
            one = self._tokens(" ".join(plain[i:stop]), b"".join(raw[i:stop]))
            found += [one] if one else [self._one(j, new, raw, good) for j in range(i, stop)]
        found += [self._one(j, new, raw, good) for j in range(len(plain), len(new))]
        ends_of = np.cumsum([len(r) if g else 0 for r, g in zip(raw, good)])
        a, b = (np.fromiter(chain.from_iterable(side), np.int64, sum(map(len, side))) for side in zip(*found))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        part_of_group = np.searchsorted(ends_of, ends)
        n_a, n_b = (np.bincount(np.searchsorted(ends_of, end), minlength=len(new)) for end in (end_a, end_b))
        in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        n_groups = np.bincount(part_of_group, minlength=len(new))
        n_links = np.bincount(part_of_group, weights=in_a * in_b, minlength=len(new)).astype(np.int64)

        # Links by distinct ids of a group, so a group of many equal tokens is no large product.
        key_a, times_a = np.unique(group_a * SHIFT + a, return_counts=True)
        key_b, times_b = np.unique(group_b * SHIFT + b, return_counts=True)
        each_b = np.bincount(key_b // SHIFT, minlength=len(ends))
        first_b = np.cumsum(each_b) - each_b
        g = key_a // SHIFT
        many = each_b[g]
        of_a = np.repeat(np.arange(len(key_a)), many)
        of_b = np.arange(len(of_a)) + np.repeat(first_b[g] - (np.cumsum(many) - many), many)
        pairs = key_a[of_a] % SHIFT * SHIFT + key_b[of_b] % SHIFT
        sizes = np.bincount(part_of_group[g[of_a]], minlength=len(new)) if len(of_a) else np.zeros(len(new), np.int64)

        at = len(self.index)
        self.index.update(zip(new, range(at, at + len(new))))
        self.characters += sum(map(len, new))
        self.groups += _joined(_joined(a, in_a, ","), _joined(b, in_b, ","), n_groups)
        self.good = np.concatenate([self.good, good])
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups, n_links], 1)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.times = np.concatenate([self.times, times_a[of_a] * times_b[of_b]])

    def _tokens(self, text: str, raw: bytes):
        """Ids of both tokenizers; none if they do not spell ``raw``."""
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        if b"".join(map(self.bytes_a.__getitem__, a)) == raw and b"".join(map(self.bytes_b.__getitem__, b)) == raw:
            return a, b

    def _one(self, at: int, new: list[str], raw: list[bytes], good: np.ndarray):
        found = self._tokens(new[at], raw[at]) if new[at] else None
        good[at] = found is not None
        return found or ([], [])

    def links(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of the parts ``codes`` in order, how often each is linked in its part, and the number for each part."""
        sizes = self.starts[codes + 1] - self.starts[codes]
        take = np.arange(int(sizes.sum())) + np.repeat(self.starts[codes] - (np.cumsum(sizes) - sizes), sizes)
        return self.pairs[take], self.times[take], sizes


def _joined(first, second, third):
    """Decimal ids as text: ids by group, or groups of both sides by part."""
    if isinstance(third, str):
        listed = list_array(first, second, pa.int64())
        strings = pa.ListArray.from_arrays(listed.offsets, listed.values.cast(pa.string()))
        return pc.binary_join(strings, third)
    both = pc.binary_join_element_wise(first, second, "|")
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets(third).astype(np.int32)), both), ";").to_pylist()


def _bytes_a(tokenizer) -> list[bytes]:
    """The bytes of each entry of a byte-level vocabulary."""
    # Printable bytes stand for themselves, the others for the characters from U+0100 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return out


def _bytes_b(model) -> list[bytes]:
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if "▁" in piece.lstrip("▁"):
            raise ValueError("a piece with a blank inside: texts cannot be cut at blanks")
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return out


_BLOCKS = (
    "block long, text_key binary, salts long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "parts array<int>, times array<int>, pairs array<long>, weights array<long>, sizes array<int>, places array<int>, links array<int>"
)


def blocks(unique: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Texts with their measures, and for each block one row more (without text_key) with its pairs.

    ``unique``: text, text_key, rows (that hold it) and salts (bits).  A text row has
    its distinct parts (numbers within the block) and how often each occurs; a block row
    has the pairs of its texts with their weights, and the links of each part (``sizes``:
    how many, ``places``: which pair, ``links``: how often).
    """
    schema = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}[k]) for n, k in (c.split(" ") for c in _BLOCKS.split(", "))])

    def run(batches):
        aligner = Aligner(path_a, path_b)
        base, number = TaskContext.get().partitionId() << 24, 0
        held: list = []
        size = 0
        for piece in slices(batches):
            parts, counts = cut_texts(piece.column("text"))
            coded = parts.dictionary_encode()
            codes = np.array(aligner.codes(coded.dictionary.to_pylist()), np.int64)[coded.indices.to_numpy()]
            each = np.split(codes, np.cumsum(counts)[:-1])
            held += zip(*(piece.column(c).to_pylist() for c in ("text_key", "rows", "salts")), each)
            size += piece.column("text").nbytes
            if size >= block_bytes:
                yield from _block(aligner, base + number, held, schema)
                number, held, size = number + 1, [], 0
                if aligner.characters > REMEMBERED:
                    aligner.forget()
        if held:
            yield from _block(aligner, base + number, held, schema)
        give_back()

    return unique.select("text", "text_key", "rows", "salts").mapInArrow(run, _BLOCKS)


def _block(aligner: Aligner, block: int, held: list, schema: pa.Schema):
    good = [bool(aligner.good[codes].all()) for _, _, _, codes in held]
    held = [h for h, g in zip(held, good) if g]
    if not held:
        return
    keys, rows, salts, codes = zip(*held)
    rows = np.array(rows, np.int64)
    length = np.array([len(c) for c in codes], np.int64)
    text, flat = np.repeat(np.arange(len(held)), length), np.concatenate(codes)
    used = np.flatnonzero(np.bincount(flat))
    place = np.zeros(len(aligner.good), np.int64)
    place[used] = np.arange(len(used))
    flat = place[flat]
    shas = [hashlib.sha256(";".join(map(aligner.groups.__getitem__, c)).encode()).hexdigest() for c in map(np.ndarray.tolist, codes)]
    seen = np.sort(text * len(used) + flat)
    first = np.flatnonzero(np.diff(seen, prepend=-1))
    times = np.diff(np.append(first, len(seen)))
    of_text, part = np.divmod(seen[first], len(used))
    counts = aligner.counts[used]
    totals = np.stack([np.bincount(of_text, weights=counts[part, i] * times, minlength=len(held)) for i in range(4)]).astype(np.int64)
    each = np.bincount(of_text, minlength=len(held))

    pairs, links, sizes = aligner.links(used)
    known, place = np.unique(pairs, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    # Each pair counts once for a text, with the rows that hold the text; some texts at a time.
    weights = np.zeros(len(known), np.int64)
    cuts = np.searchsorted(of_text, np.arange(0, len(held) + 64, 64))
    for a, b in zip(cuts, cuts[1:]):
        many = sizes[part[a:b]]
        take = np.arange(int(many.sum())) + np.repeat(starts[part[a:b]] - (np.cumsum(many) - many), many)
        once = distinct(np.repeat(of_text[a:b], many) * len(known) + place[take])
        if len(once):
            weights += np.bincount(once % len(known), weights=rows[once // len(known)], minlength=len(known)).astype(np.int64)

    n = len(held)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, block)), pa.array(keys, pa.binary()), pa.array(salts, pa.int64()), *(pa.array(t) for t in totals), pa.array(shas),
            list_array(part, each, pa.int32()), list_array(times, each, pa.int32()), *(pa.nulls(n, schema.field(c).type) for c in ("pairs", "weights", "sizes", "places", "links")),
        ],
        schema=schema,
    )
    one = {"block": block, "pairs": known, "weights": weights, "sizes": sizes, "places": place, "links": links}
    yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) if f.name not in one else pa.array([one[f.name]], f.type) for f in schema], schema=schema)


def pair_counts(stored_blocks: DataFrame) -> DataFrame:
    """pair, n (rows that hold it linked) and best (no pair with the same A id has more)."""
    weighed = stored_blocks.where("text_key IS NULL").select(F.inline(F.arrays_zip("pairs", "weights"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("weights").alias("n"))
    a = F.floor(F.col("pair") / SHIFT).cast("long")
    counts = stored(weighed.withColumn("a", a), "alignment-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    return counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


_MEASURES = "text_key binary, salts long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of neighbouring values, ``sizes`` at a time, in whole numbers."""
    total = offsets(values)
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _measure(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over the links of each text of a block (left), from the counts of its pairs (right)."""
    whole = pc.is_null(left.column("text_key"))
    block = left.filter(whole).slice(0, 1).combine_chunks()
    rows = left.filter(pc.invert(whole)).combine_chunks()
    right = right.sort_by("pair")
    flat = lambda table, c: np.asarray(pc.list_flatten(table.column(c).combine_chunks()), np.int64)
    links, place, sizes, parts, times = flat(block, "links"), flat(block, "places"), flat(block, "sizes"), flat(rows, "parts"), flat(rows, "times")
    slot = np.searchsorted(np.asarray(right.column("pair")), flat(block, "pairs"))
    each = np.asarray(pc.list_value_length(rows.column("parts").combine_chunks()), np.int64)
    out = []
    for name in ("best", "n"):
        value = np.asarray(right.column(name).cast(pa.int64()))[slot]
        by_part = _sums(value[place] * links, sizes)
        out.append(pa.array(_sums(by_part[parts] * times, each)))
    keep = [rows.column(c).combine_chunks() for c in ("text_key", "salts", "n_a", "n_b", "n_groups", "n_links")]
    return pa.Table.from_arrays([*keep, *out, rows.column("groups_sha256").combine_chunks()], names=[c.split(" ")[0] for c in _MEASURES.split(", ")])


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 for every row of ``docs``."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("salt", salt)
    full = rows.where("text IS NOT NULL AND text <> ''")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("salt"))
    unique = full.groupBy("text").agg(F.count("*").alias("rows"), F.bit_or(bit).alias("salts"))
    key = F.unhex(F.sha2("text", 256)).alias("text_key")
    found = stored(blocks(unique.select("text", key, "rows", "salts"), path_a, path_b), "alignment-blocks")
    of_block = found.where("text_key IS NULL").select(F.col("block").alias("in_block"), F.explode("pairs").alias("pair"))
    counted = of_block.join(pair_counts(found), "pair").select("in_block", "pair", "n", "best")
    measures = stored(found.drop("weights").groupBy("block").cogroup(counted.groupBy("in_block")).applyInArrow(_measure, _MEASURES), "alignment-measures")

    salts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.call_function("shiftright", F.col("salts"), s).bitwiseAND(1) == 1)
    names = [c.split(" ")[0] for c in _MEASURES.split(", ")[2:]]
    by_salt = measures.select("text_key", *names, F.explode(salts).alias("salt"))
    joined = rows.select("doc_id", F.unhex(F.sha2("text", 256)).alias("text_key"), "salt", (F.length("text") > 0).alias("full"))
    some = joined.where("full").join(by_salt, ["text_key", "salt"], "left")
    none = joined.where("full IS NULL OR NOT full")
    zero = lambda c: F.lit("" if c == "groups_sha256" else 0).cast("string" if c == "groups_sha256" else "long")
    return some.select("doc_id", *[F.coalesce(c, zero(c)).alias(c) for c in names]).unionByName(none.select("doc_id", *[zero(c).alias(c) for c in names]))
