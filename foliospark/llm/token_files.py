"""Token-id files: Parquet list columns in document order.

Each document is one row: ``doc_id``, ``part`` (the file's number), ``part_start``
(ids of the documents before it in the same file), ``n_tokens`` and ``tokens``
(list of int).  Columns are separate chunks, so metadata is read without ids;
row groups are small and have page indexes, so a range of documents reads only
its pages.  Ids are dictionary-coded (16 bits and less each) or, with
``encoding="delta"``, DELTA_BINARY_PACKED; both are compressed with zstd.

Null texts count as empty, so such a document holds the end id only.  Rows with
the same id stay separate rows, next to each other; a null id sorts first.  An
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Codes, arrow_loop, expanded, list_array, offsets

SCHEMA = "doc_id long, part int, part_start long, n_tokens int, tokens array<int>"

LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")

#: Texts whose ids must be those of their words.
PROBES = ("One two,  three. Four's caf\u00e9, 5.0 x", " lead\n\nnext line \u4e2d\u6587 \u4e2d. end.", "a . b ,c d.e f.\ng", "\u00e9. \u00d7. A\u0301. B", "a-b (c) d/e,f \"g\" it's 'x y.'s z-'t [q]; --\u00e9= _u_ 4.5x <i>\u0301v <|w|> k@l**#")

_coders: dict[str, Codes] = {}


def word_coder(path: str) -> Codes:
    """Ids of blank-separated words, by the tokenizers library; one per Python worker.

    The pre-tokenizer drops white space and never matches across it, and no
    normalizer step looks across it, so a text's ids are its words' ids in order.
    """
    if path not in _coders:
        from tokenizers import Tokenizer

        # A task has one core; threads of the library would take those of other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        library = Tokenizer.from_file(path)
        ends = np.zeros(library.get_vocab_size(with_added_tokens=True), bool)
        for token, i in library.get_vocab(with_added_tokens=True).items():
            ends[i] = token.endswith("</w>")

        for probe in [*PROBES, *(f"a{t.content}b. {t.content}" for t in library.get_added_tokens_decoder().values())]:
            words = cut_texts(pa.array([probe]))[0].to_pylist()
            apart = chain.from_iterable(e.ids for e in library.encode_batch_fast(words, add_special_tokens=False))
            if library.encode(probe, add_special_tokens=False).ids != list(apart):
                raise ValueError("a cut at white space changes the result of this tokenizer")

        def compute(words):
            # Words of letters are one pre-token each, so many can go through the library as one text.
            plain = np.array([LETTERS.fullmatch(w) is not None for w in words], bool)
            parts = [list(compress(words, plain)), list(compress(words, ~plain))]
            joined = [" ".join(parts[0][at : at + 1000]) for at in range(0, len(parts[0]), 1000)]
            ids = [e.ids for e in library.encode_batch_fast([*joined, *parts[1]], add_special_tokens=False)]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
            cuts = np.flatnonzero(ends[flat[: int(lengths[: len(joined)].sum())]]) + 1
            if len(cuts) != len(parts[0]):
                raise ValueError("a word of letters is not one pre-token of this tokenizer")
            sizes = np.concatenate([np.diff(cuts, prepend=0), lengths[len(joined) :]])
            place = np.argsort(np.argsort(~plain, kind="stable"))
            return expanded(place, offsets(sizes), flat)

        _coders[path] = Codes(compute, np.int32)
    return _coders[path]


#: Kinds of bytes: letters, signs that are cut from letters, and the first byte of letters of Latin-1.
#: An apostrophe may begin a token with the letters behind it, and bars stand in the names of special tokens.
LETTER, SIGN, LATIN = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = LETTER
_KIND[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~")] = SIGN
_KIND[0xC3] = LATIN


def cut_texts(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, without the blanks and line breaks between them, and the number of words of each text.

    Between a letter of ASCII or Latin-1 and a sign a token ends, so words are cut there too.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, places, data = column.buffers()
    borders = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    text = np.frombuffer(b"" if data is None else data, np.uint8)[borders[0] : borders[-1]]
    borders = borders - borders[0]
    cut = np.zeros(len(text) + 1, bool)
    kind = _KIND[text]
    signs = np.flatnonzero(kind == SIGN)
    # A sign behind a letter, and a letter behind a sign.
    last, lead = signs - 1, signs - 2
    latin = (kind[lead] == LATIN) & (text[last] >= 0x80) & (text[last] != 0x97) & (text[last] != 0xB7) & (last > 0)
    cut[signs[(last >= 0) & ((kind[last] == LETTER) | latin)]] = True
    after = signs + 1
    at, then = np.minimum(after, len(text) - 1), np.minimum(after + 1, len(text) - 1)
    latin = (kind[at] == LATIN) & (text[then] != 0x97) & (text[then] != 0xB7)
    cut[after[(kind[at] == LETTER) | latin]] = True
    cut[borders] = True
    white = (text == ord(" ")) | (text == ord("\n"))
    # A word begins behind each blank; the blanks themselves belong to no word.
    cut[1:] |= white
    starts = np.flatnonzero(cut)
    counts = np.diff(np.searchsorted(starts, borders))
    blanks = np.flatnonzero(white)
    starts -= np.searchsorted(blanks, starts)
    words = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(text[~white])) if len(text) else pa.array([], pa.large_string())
    return words, counts


def encode_texts(path: str, end_id: int, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by the end id, and the number of ids of each."""
    words, counts = cut_texts(batch)
    coded = words.dictionary_encode()
    ids, sizes = word_coder(path).expand(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy())
    ends = offsets(sizes)[np.cumsum(counts)]
    lengths = np.diff(ends, prepend=0) + 1
    return np.insert(ids, ends, end_id).astype(np.int32), lengths


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, encoding: str = "dictionary", row_group_bytes: int = 8 << 20, page_rows: int = 2000) -> None:
    """Encode the texts of ``docs`` (doc_id, text) and write them to ``path`` in ascending doc_id order.

    The texts, which are smaller than their ids, are what is range-partitioned.
    """
    from pyspark import TaskContext

    def make():
        part, seen = TaskContext.get().partitionId(), 0

        def step(rows):
            nonlocal seen
            ids, lengths = encode_texts(tokenizer, end_id, rows.column("text"))
            starts = seen + np.cumsum(lengths) - lengths
            seen += int(lengths.sum())
            columns = [rows.column("doc_id"), pa.array(np.full(len(lengths), part, np.int32)), pa.array(starts), pa.array(lengths.astype(np.int32)), list_array(ids, lengths, pa.int32())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "part_start", "n_tokens", "tokens"])

        return step

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    options = {
        "compression": "zstd",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.writer.version": "v1" if encoding == "dictionary" else "v2",
    }
    ordered.mapInArrow(arrow_loop(make, rows=2000, caches=True, size=4 << 20), SCHEMA).write.options(**options).parquet(path)


def _with_start(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """``start`` over all files.  One row per file, not per document, goes through the running sum."""
    totals = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "part").withColumn("start", F.col("base") + F.col("part_start")).withColumn("n_tokens", F.col("n_tokens").cast("long"))


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and n_tokens, without reading ids."""
    return _with_start(spark.read.schema(SCHEMA).parquet(path), spark, path).select("doc_id", "start", "n_tokens")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """doc_id, part, part_start, n_tokens and tokens; with bounds only the pages of those documents."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    return rows if last is None else rows.where(F.col("doc_id") <= last)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, all read from the files."""

    def make():
        def step(rows):
            lists = rows.column("tokens")
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            ends = 4 * np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            sums, at = [], 0
            for end in ends.tolist():
                sums.append(zlib.crc32(ids[at:end]))
                at = end
            columns = [rows.column(c) for c in ("doc_id", "part", "part_start", "n_tokens")] + [pa.array(sums, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

        return step

    each = read_tokens(spark, path).mapInArrow(arrow_loop(make), "doc_id long, part int, part_start long, n_tokens int, ids_crc32 long")
    return _with_start(each, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
