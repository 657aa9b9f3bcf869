"""Helpers shared by the operators: intermediate tables, Arrow loops over texts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.session import work_folder

#: Rows, and about so many bytes of text, that are handled at a time inside a task.
SLICE, SLICE_BYTES = 512, 1 << 20


def stored(df: DataFrame, purpose: str, **options) -> DataFrame:
    """The rows written as Parquet below ``spark.checkpoint.dir`` and read again.

    This cuts the lineage: a lost executor costs no stage before the table.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables that go when the block ends, but for those that are kept.

    What is kept must not depend on the others: keep only stored tables.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def stored(self, df: DataFrame, purpose: str) -> DataFrame:
        path = work_folder(self.spark, purpose)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path, out
        self.collect()
        return out

    def collect(self) -> None:
        """Shuffle files, broadcasts and generated code go when the driver has collected the plans that made them."""
        gc.collect()
        self.spark._jvm.System.gc()

    def keep(self, df: DataFrame) -> DataFrame:
        self.paths.pop(id(df))
        return df

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df))[0])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.drop(*[df for _, df in self.paths.values()])
        self.collect()


def text_key(text: Column) -> Column:
    """What tells the texts of one id, or of none, apart; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Texts can be long: fewer rows than the default go to Python at a time.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batches that are bounded in rows and, by the column ``text``, in bytes."""
    for batch in batches:
        starts = set(range(0, batch.num_rows, rows))
        if "text" in batch.schema.names:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64)
            starts.update((np.flatnonzero(np.diff(np.cumsum(sizes) // size, prepend=0))).tolist())
        cuts = [*sorted(starts), batch.num_rows]
        for at, end in zip(cuts, cuts[1:]):
            yield batch.slice(at, end - at)


def give_back() -> None:
    """Return freed memory to the system.

    Python workers outlive their tasks, and what one keeps is missing to the next.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def arrow_loop(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], rows: int = SLICE, caches: bool = False, size: int = SLICE_BYTES):
    """A ``mapInArrow`` function: ``make()`` once per task, its result once per slice of rows.

    Without ``caches`` the strings that other tasks of this worker remember are dropped first.
    """

    def run(batches):
        if not caches:
            Codes.forget()
        step = make()
        for piece in slices(batches, rows, size):
            out = step(piece)
            if out is not None and out.num_rows:
                yield out
        step = piece = out = None
        give_back()

    return run


def texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting beats the hash table of ``np.unique`` by far."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets(lengths).astype(np.int32)), pa.array(values, kind))


class Codes:
    """Strings seen so far with one integer array each, kept in one flat array.

    ``expand`` looks strings up at C speed and computes only those not seen
    before (``compute`` gives a sequence for each, or all values and the sizes).  Once ``most`` strings are held they become the older half, which
    is asked only for strings that are not in the newer half, and goes when that
    is full; so memory is bounded and common strings stay.
    """

    alive: list[Codes] = []

    def __init__(self, compute: Callable[[list[str]], list], dtype, most: int = 450_000):
        self.compute, self.dtype, self.most = compute, dtype, most
        Codes.alive.append(self)
        self._empty()

    @staticmethod
    def forget() -> None:
        for codes in Codes.alive:
            codes._empty()

    def _empty(self):
        self._renew()
        self.old = {}, self.starts, self.flat

    def _renew(self):
        self.index: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def expand(self, words: list[str], places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All values in order, and the number of values of each word.

        With ``places`` the order is that of ``words[i]`` for every i in it.
        """
        ids = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(ids < 0).tolist()
        if missing:
            new = {words[i] for i in missing}
            if len(self.index) + len(new) > self.most:
                self.old = self.index, self.starts, self.flat
                self._renew()
                new, missing = set(words), range(len(words))
            self._add(new)
            ids[missing] = np.fromiter((self.index[words[i]] for i in missing), np.int64, len(missing))
        return expanded(ids if places is None else ids[places], self.starts, self.flat)

    def _add(self, new: set[str]):
        index, starts, flat = self.old
        kept = [w for w in new if w in index] if index else []
        fresh = [w for w in new if w not in index] if index else list(new)
        values, sizes = expanded(np.array([index[w] for w in kept], np.int64), starts, flat)
        found, more = _flat(self.compute(fresh) if fresh else [], self.dtype)
        at = len(self.index)
        self.index.update(zip(chain(kept, fresh), range(at, at + len(new))))
        self.flat = np.concatenate([self.flat, values, found])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate([sizes, more]))])


def _flat(found, dtype) -> tuple[np.ndarray, np.ndarray]:
    """What ``compute`` gave, a sequence for each string or already flat values and sizes, in the second form."""
    if isinstance(found, tuple):
        return found
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), dtype, int(sizes.sum())), sizes


def expanded(ids: np.ndarray, starts: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = starts[ids]
    sizes = starts[ids + 1] - first
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(first - (ends - sizes), sizes)], sizes
