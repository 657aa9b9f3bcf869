"""A stored table that is changed by upserts, one version after another."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.search_index import Conflict
from ..operators.state import merge_rows, repeated_keys

BUCKET = "_bucket"


class VersionedTable:
    """Rows with unique keys, stored in folders by key bucket.

    An upsert reads and writes the buckets of its own keys only.  A version is a
    small file that names the folder of every bucket; it takes its final name in
    one step and never changes, so readers of older versions keep their files,
    and a writer whose base is outdated is refused.  Files of refused or old
    versions stay until the user removes them.  The number of buckets is fixed
    when the table is made.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, keys: list[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.keys, self.buckets = spark, root.rstrip("/"), schema, list(keys), buckets

    # --- versions ----------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The newest version; 0 for a table that has none."""
        found = self._files().globStatus(self._path("versions/*.json"))
        return max((int(f.getPath().getName().split(".")[0]) for f in found or ()), default=0)

    def folders(self, version: int) -> dict[int, str]:
        """The folder of every bucket that has rows."""
        if version == 0:
            return {}
        text = self.spark.read.text(f"{self.root}/versions/{version:012d}.json", wholetext=True).first()
        return {int(b): folder for b, folder in json.loads(text["value"]).items()}

    def _commit(self, folders: dict[int, str], base: int) -> int:
        if self.version() != base:
            raise Conflict(f"version {base} is outdated")
        draft, final = self._path(f"drafts/{uuid.uuid4().hex}.json"), self._path(f"versions/{base + 1:012d}.json")
        files, jvm = self._files(), self.spark._jvm
        files.mkdirs(final.getParent())
        out = files.create(draft, False)
        try:
            out.write(bytearray(json.dumps(folders).encode()))
        finally:
            out.close()
        # Unlike a plain rename this one never replaces a file that is there.
        strict = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, final, strict)
        except Py4JJavaError as problem:
            if "FileAlreadyExistsException" not in problem.java_exception.getClass().getName():
                raise
            raise Conflict(f"version {base + 1} is taken") from problem
        return base + 1

    # --- rows ----------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _read(self, folders: dict[int, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/rows/{folder}/{BUCKET}={b}" for b, folder in sorted(folders.items())])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default of the newest."""
        return self._read(self.folders(self.version() if version is None else version))

    def _write(self, df: DataFrame, kind: str) -> str:
        name = uuid.uuid4().hex
        # Large buckets become several files and small ones share a task.
        df.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{kind}/{name}")
        return name

    def merge(self, source: DataFrame, update: list[str], base: int | None = None) -> int:
        """Rows with known keys take the source's ``update`` columns, others are added; returns the new version.

        The source must hold every key once.  A key with a null never equals
        another, so such a row is always added.  ``base`` is the version that the
        source was computed from; if another commit came since, ``Conflict`` is
        raised and nothing changes.  A source without rows makes no version.
        """
        base = self.version() if base is None else base
        name = self._write(source, "changes")
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
        changes = self.spark.read.schema(f"{kinds}, {BUCKET} int").parquet(f"{self.root}/changes/{name}")
        if not repeated_keys(changes.dropna(subset=self.keys), self.keys).isEmpty():
            raise ValueError("the source holds a key more than once")
        # One row for each bucket at most.
        touched = {r[BUCKET] for r in changes.select(BUCKET).distinct().collect()}
        before = self.folders(base)
        old = self._read({b: f for b, f in before.items() if b in touched})
        if touched:
            folder = self._write(merge_rows(old, changes.drop(BUCKET), self.keys, update), "rows")
            base = self._commit({**before, **dict.fromkeys(touched, folder)}, base)
        self._files().delete(self._path(f"changes/{name}"), True)
        return base
