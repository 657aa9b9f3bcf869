"""Folder listings by many tasks, as a Python data source."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LISTING_SCHEMA = "relative_path string, size bigint, last_modified timestamp, file_url string"
ROWS_PER_BATCH = 10_000


def _open(base: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a folder, its path there, and the URL in front of relative paths."""
    base = base.rstrip("/")
    if base.startswith("file:"):
        base = "/" + base[len("file:") :].lstrip("/")
    if "://" not in base:
        return fs.LocalFileSystem(), base, f"file:{base}"
    system, path = fs.FileSystem.from_uri(base.replace("s3a://", "s3://", 1))
    return system, path.rstrip("/"), base


def can_list(base: str) -> bool:
    """Whether the folder's kind of file system can be listed here."""
    try:
        _open(base)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return False
    return True


def _hidden(name: str) -> bool:
    """Names that Spark's own file sources leave out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _entries(system: fs.FileSystem, folder: str) -> tuple[list[str], list[fs.FileInfo]]:
    """Folders and files that stand directly in a folder.  A folder that is gone by now is empty."""
    found = [i for i in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if not _hidden(i.base_name)]
    return sorted(i.path for i in found if i.type == fs.FileType.Directory), [i for i in found if i.type == fs.FileType.File]


class _Folders(InputPartition):
    """One folder, with all below it or only the files that stand directly in it."""

    def __init__(self, path: str, deep: bool):
        self.path = path
        self.deep = deep


class _Reader(DataSourceReader):
    def __init__(self, base: str, folders: int):
        self.base = base
        self.folders = folders

    def partitions(self) -> list[_Folders]:
        """The upper levels of the tree are walked here, until there are enough folders to share out."""
        system, root, _ = _open(self.base)
        if system.get_file_info(root).type != fs.FileType.Directory:
            raise FileNotFoundError(f"no such folder: {self.base}")
        opened, level = [], [root]
        while level and len(level) < self.folders:
            opened += level
            level = [below for folder in level for below in _entries(system, folder)[0]]
        return [_Folders(p, False) for p in opened] + [_Folders(p, True) for p in level]

    def read(self, partition: _Folders) -> Iterator[pa.RecordBatch]:
        system, root, url = _open(self.base)
        waiting = [partition.path]
        while waiting:
            below, files = _entries(system, waiting.pop())
            if partition.deep:
                waiting += below
            for start in range(0, len(files), ROWS_PER_BATCH):
                part = files[start : start + ROWS_PER_BATCH]
                names = [i.path[len(root) + 1 :] for i in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.string()),
                        pa.array([i.size for i in part], pa.int64()),
                        pa.array([_time(i) for i in part], pa.timestamp("us", "UTC")),
                        pa.array([f"{url}/{n}" for n in names], pa.string()),
                    ],
                    names=["relative_path", "size", "last_modified", "file_url"],
                )


def _time(info: fs.FileInfo) -> datetime | None:
    return info.mtime.astimezone(timezone.utc) if info.mtime else None


class FolderListing(DataSource):
    """``spark.read.format("folder_listing").load(base)``: one row per file at any depth, files of zero bytes too.

    The driver lists the upper levels only, until there are ``folders`` folders
    (option, 64 if not given); tasks list what is below them, one folder at a
    time.  The files of one single folder are always listed by one task, since
    file systems give them out in one sequence.  No file is opened.
    """

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("folders", 64)))
