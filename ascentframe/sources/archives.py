"""Archive files: discovery and members.

Folders are listed by tasks, which hand the files on a few thousand at a time: the driver never holds the files of a tree.
``read_members`` lists members from the tail of each archive: tasks open the files and seek to the end record and the
directory, so an archive's data are never read.  ``list_members`` does the same on contents that Spark has read, for
stores that only Spark can open.
"""

from __future__ import annotations

import fnmatch
import io
import os
import re
import stat
import zipfile
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ascentframe.session import ensure_checkpoint_dir

FILES_SCHEMA = "path string, length long, modificationTime timestamp"
MEMBERS_SCHEMA = "archive string, member string, ord int, size long, error string"
_MEMBER_ROWS = f"{MEMBERS_SCHEMA}, bytes_read long"


def discover(spark: SparkSession, root: str, pattern: str = "*.jar") -> DataFrame:
    """path, length, modificationTime of every file below ``root`` whose name
    matches; file contents are not read.  A missing root gives no rows.

    The files are those of now: the list is stored.  As Spark's readers do, names that begin with a dot or an underscore
    are left out.  A store that only Spark can open is listed by the driver.
    """
    if not exists(spark, root):
        return spark.createDataFrame([], FILES_SCHEMA)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    if not _is_folder(whole):
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern)
            .load(root)
        )
        return files.select("path", "length", "modificationTime")
    wanted = f"(?s)^(?:{spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()})$"
    found = _listing(spark, whole, lambda name, folder: not _hidden(name))
    ensure_checkpoint_dir(spark)
    return found.where(F.substring_index("path", "/", -1).rlike(wanted)).select(
        F.concat(F.lit(f"{whole}/"), "path").alias("path"), "length", F.timestamp_micros("modified").alias("modificationTime"),
    ).checkpoint(eager=True)


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    hidden = name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")
    return hidden and not name.startswith(("_common_metadata", "_metadata"))


#: Files that are handed on at once.
LISTED = 10_000
_LISTING = "folder boolean, path string, length long, modified long"


def _store(root: str) -> tuple[fs.FileSystem, str]:
    """``open_store``, also for local names that are no URI."""
    local = re.match("(file:)?/+", root)
    store, place = (fs.LocalFileSystem(), f"/{root[local.end():]}") if local else open_store(root)
    return store, place.rstrip("/")


def _is_folder(root: str) -> bool:
    try:
        store, place = _store(root)
        return store.get_file_info(place or "/").type == fs.FileType.Directory
    except (pa.ArrowException, OSError):  # a store that only Spark can open
        return False


def _children(store: fs.FileSystem, place: str) -> Iterator[tuple[bool, str, int | None, int]]:
    """(folder, name, length, microseconds of the last change) of what lies in a folder; one that is gone holds nothing."""
    if not isinstance(store, fs.LocalFileSystem):
        for f in store.get_file_info(fs.FileSelector(place, allow_not_found=True)):
            if f.type in (fs.FileType.File, fs.FileType.Directory):
                yield f.type == fs.FileType.Directory, f.base_name, f.size, (f.mtime_ns or 0) // 1_000_000 * 1000
        return
    try:
        entries = os.scandir(place or "/")  # one after the other, however many there are
    except FileNotFoundError:
        return
    with entries:
        for entry in entries:
            try:
                found = entry.stat()
            except FileNotFoundError:  # removed meanwhile, or a link to nothing
                continue
            if stat.S_ISDIR(found.st_mode) or stat.S_ISREG(found.st_mode):
                yield stat.S_ISDIR(found.st_mode), entry.name, found.st_size, found.st_mtime_ns // 1_000_000 * 1000


def _opened(root: str, keep: Callable[[str, bool], bool], deep: bool):
    """Replaces folders by what lies in them, or by all files below them; files are handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(root)
        schema = pa.schema([("folder", pa.bool_()), ("path", pa.string()), ("length", pa.int64()), ("modified", pa.int64())])
        for batch in batches:
            out, open_ = [], []
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[0]:
                    open_.append(row[1])
                else:
                    out.append(row)
            while open_:
                at = open_.pop()
                for folder, name, length, modified in _children(store, f"{place}/{at}" if at else place):
                    if not keep(name, folder):
                        continue
                    path = f"{at}/{name}" if at else name
                    if folder and deep:
                        open_.append(path)
                    else:
                        out.append((folder, path, length, modified))
                    if len(out) >= LISTED:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _listing(spark: SparkSession, root: str, keep: Callable[[str, bool], bool]) -> DataFrame:
    """Files below ``root``, by their path in it.  The folders of two levels are dealt out, tasks list what lies deeper."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(1, numPartitions=1).selectExpr("true AS folder", "'' AS path", "0L AS length", "0L AS modified")
    for deep in (False, False, True):
        rows = rows.mapInArrow(_opened(root, keep, deep), _LISTING)
        if not deep:
            rows = rows.repartition(parts, "path")
    return rows.drop("folder")


def exists(spark: SparkSession, root: str) -> bool:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_archives(spark: SparkSession, root: str, pattern: str = "*.jar") -> DataFrame:
    """(archive, content) of the matching files."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return files.select(F.col("path").alias("archive"), "content")


def _entries(file):
    with zipfile.ZipFile(file) as archive:
        return [(info.filename, info.file_size) for info in archive.infolist()]


def _damage(name: str, exc: Exception) -> str:
    return f"Corrupted zip file: {name} - {exc}"


class _Counted:
    """A file that counts the bytes read from it."""

    def __init__(self, file):
        self.file, self.bytes = file, 0
        self.tell, self.seekable = file.tell, file.seekable

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return self.file.seek(offset, whence)
        except pa.ArrowInvalid as exc:  # before the start of a short file
            raise OSError(str(exc)) from exc

    def read(self, size: int = -1) -> bytes:
        data = self.file.read(None if size < 0 else size)
        self.bytes += len(data)
        return data


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path or URI and the path in it, without Spark."""
    return fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", path))


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _MemberReader(DataSourceReader):
    def __init__(self, root: str, pattern: str, at_once: int):
        self.root, self.pattern, self.at_once = root, pattern, at_once

    def partitions(self):
        store, place = open_store(self.root)
        found = store.get_file_info(fs.FileSelector(place, recursive=True, allow_not_found=True))
        paths = sorted(f.path for f in found if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, self.pattern))
        return [_Files(paths[k : k + self.at_once]) for k in range(0, len(paths), self.at_once)] or [_Files([])]

    def read(self, partition: _Files):
        store, _ = open_store(self.root)
        yield from _members_of(store, partition.paths)


def _members_of(store: fs.FileSystem, paths: Iterator[str]) -> Iterator[tuple]:
    """Members of the archives, and what was read of each (``MemberSource``)."""
    for path in paths:
        name, counted = path.rsplit("/", 1)[-1], None
        try:
            with store.open_input_file(path) as file:
                counted = _Counted(file)
                found = _entries(counted)
        except Exception as exc:  # any damage rejects this archive only
            yield path, None, None, None, _damage(name, exc), counted.bytes if counted else 0
            continue
        for place, (member, size) in enumerate(found):
            yield path, member, place, size, None, counted.bytes
        if not found:
            yield path, None, None, None, None, counted.bytes


class MemberSource(DataSource):
    """``spark.read.format("archive_members").option("pattern", "*.jar").load(root)``: one row per member of every archive
    below ``root``.  A damaged archive gives one row with ``error``, an empty one a row without a member.  ``bytes_read`` is
    what was read of the archive.  A partition takes ``filesPerPartition`` files; a root that is absent gives no rows.
    The driver lists the files of this source; ``read_members`` gives the same rows, listed by tasks."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        return _MEMBER_ROWS

    def reader(self, schema) -> DataSourceReader:
        get = self.options.get
        return _MemberReader(get("path"), get("pattern", "*.jar"), int(get("filesPerPartition", "256")))


def read_members(spark: SparkSession, root: str, pattern: str = "*.jar") -> DataFrame:
    """Rows of ``MemberSource``; the files are listed and opened by tasks."""
    spark.dataSource.register(MemberSource)
    names = [(f.name, t) for f, t in zip(StructType.fromDDL(_MEMBER_ROWS), (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64()))]

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _store(root)
        for batch in batches:
            rows = _members_of(store, (f"{place}/{path}" for path in batch.column("path").to_pylist()))
            while some := list(islice(rows, LISTED)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*some), names)], names=[n for n, _ in names])

    files = _listing(spark, root, lambda name, folder: folder or fnmatch.fnmatch(name, pattern))
    return files.select("path").mapInArrow(tails, _MEMBER_ROWS)


def list_members(archives: DataFrame) -> DataFrame:
    """One row per archive member; a damaged archive gives one row with only
    ``error``.  Archives are opened where their partition lives."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for archive, content in zip(batch.column("archive"), batch.column("content")):
                name = archive.as_py()
                try:
                    found = _entries(io.BytesIO(content.as_py()))
                except Exception as exc:  # any damage rejects this archive only
                    out.append((name, None, None, None, _damage(name, exc)))
                    continue
                out += [(name, member, ord_, size, None) for ord_, (member, size) in enumerate(found)]
            cols = list(zip(*out)) if out else [[]] * 5
            types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string()]
            names = ["archive", "member", "ord", "size", "error"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return archives.select("archive", "content").mapInArrow(members, MEMBERS_SCHEMA)
