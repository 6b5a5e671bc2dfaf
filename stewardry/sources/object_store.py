"""Object stores as Spark data sources: `objects` lists, `object_copies` copies.

Spark's file sources pass over objects of zero bytes and list a folder on the driver. Here
the driver looks at the first level alone; every folder it finds there is listed below by a
task. Copies are written by tasks under names of their own and put into place when all tasks
are done, so that a failed copy leaves nothing behind.

Paths are those that `pyarrow.fs` opens: a mounted folder, `s3://`, `gs://`, `hdfs://`.
"""

from __future__ import annotations

import posixpath
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

# Python workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING = "object_name string, length long, modificationTime timestamp"
CONTENT = LISTING + ", content binary"

#: Objects of the first level that a task hands on, and bytes that a copy moves at once.
_NAMES_A_TASK, _BLOCK = 10_000, 1 << 22
#: Where a copy's files are until it is committed, below its folder.
_PENDING = "_pending"


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    where, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    return where, root.rstrip("/")


def _hidden(name: str) -> bool:
    """Names that belong to writers, as Spark has it."""
    last = posixpath.basename(name)
    return last.startswith(("_", "."))


class _Folder(InputPartition):
    """Everything below one folder, to be listed by a task."""

    def __init__(self, path: str):
        self.path = path


class _Names(InputPartition):
    """Objects already listed: (path, size, time)."""

    def __init__(self, found: list[tuple]):
        self.found = found


class _ObjectReader(DataSourceReader):
    def __init__(self, folder: str, prefix: str, schema: StructType):
        self.folder, self.prefix = folder, prefix
        self.with_content = "content" in schema.names

    def partitions(self) -> list[InputPartition]:
        where, root = _opened(self.folder)
        found = where.get_file_info(fs.FileSelector(root, allow_not_found=True))
        below = [f.path for f in found if f.type == fs.FileType.Directory and not _hidden(f.path) and self._may_hold(root, f.path)]
        here = [(f.path, f.size, f.mtime) for f in found if f.type == fs.FileType.File and self._wanted(root, f.path)]
        chunks = [here[i:i + _NAMES_A_TASK] for i in range(0, len(here), _NAMES_A_TASK)]
        return [*map(_Folder, below), *map(_Names, chunks)] or [_Names([])]

    def _may_hold(self, root: str, path: str) -> bool:
        name = path[len(root) + 1:] + "/"
        return name.startswith(self.prefix) or self.prefix.startswith(name)

    def _wanted(self, root: str, path: str) -> bool:
        name = path[len(root) + 1:]
        return name.startswith(self.prefix) and not any(_hidden(part) for part in name.split("/"))

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        where, root = _opened(self.folder)
        if isinstance(partition, _Names):
            found = partition.found
        else:
            listed = where.get_file_info(fs.FileSelector(partition.path, recursive=True))
            found = [(f.path, f.size, f.mtime) for f in listed if f.type == fs.FileType.File and self._wanted(root, f.path)]
        step = 1 if self.with_content else 4096
        for lo in range(0, len(found), step):
            part = found[lo:lo + step]
            columns = [
                pa.array([path[len(root) + 1:] for path, _, _ in part], pa.string()), pa.array([size for _, size, _ in part], pa.int64()),
                pa.array([time for _, _, time in part], pa.timestamp("us", "UTC")),
            ]
            if self.with_content:
                columns.append(pa.array([where.open_input_stream(path).read() for path, _, _ in part], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in (CONTENT if self.with_content else LISTING).split(", ")])


class ObjectSource(DataSource):
    """`objects`: what lies below the folder `path`, names being paths below it.

    Options: `prefix` (names begin with it; folders that cannot hold any are not listed),
    `content` (true: adds the bytes). Names with a part that begins with `_` or `.` are left
    out; objects of zero bytes are not.
    """

    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return CONTENT if self.options.get("content", "false").lower() == "true" else LISTING

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ObjectReader(self.options["path"], self.options.get("prefix", ""), schema)


@dataclass
class _Copied(WriterCommitMessage):
    """(pending path, final path) of the files of one task."""

    files: list[tuple[str, str]]


class _CopyWriter(DataSourceWriter):
    def __init__(self, source: str, target: str):
        self.source, self.target, self.run = source, target, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        origin, source = _opened(self.source)
        where, target = _opened(self.target)
        pending, files = f"{target}/{_PENDING}/{self.run}/{uuid.uuid4().hex}", []
        where.create_dir(pending, recursive=True)
        for row in iterator:
            path = f"{pending}/{len(files)}"
            with origin.open_input_stream(f"{source}/{row['object_name']}") as given, where.open_output_stream(path) as out:
                while block := given.read(_BLOCK):
                    out.write(block)
            files.append((path, f"{target}/{row['file_name']}"))
        return _Copied(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        where, target = _opened(self.target)
        for path, final in (pair for m in messages if m is not None for pair in m.files):
            where.create_dir(posixpath.dirname(final), recursive=True)
            where.move(path, final)
        self._clear(where, target)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*_opened(self.target))

    def _clear(self, where: fs.FileSystem, target: str) -> None:
        pending = f"{target}/{_PENDING}/{self.run}"
        if where.get_file_info(pending).type == fs.FileType.Directory:
            where.delete_dir(pending)


class CopySource(DataSource):
    """`object_copies`: rows `object_name, file_name` become files of the folder `path`, copied
    from the folder in the option `source`. A file that is there already is replaced."""

    @classmethod
    def name(cls) -> str:
        return "object_copies"

    def schema(self) -> str:
        return "object_name string, file_name string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _CopyWriter(self.options["source"], self.options["path"])


def read_bytes(folder: str, name: str) -> bytes:
    """An object's content, inside a task."""
    where, root = _opened(folder)
    with where.open_input_stream(f"{root}/{name}") as given:
        return given.read()


def register(spark: SparkSession) -> SparkSession:
    """The session, knowing both formats."""
    for source in (ObjectSource, CopySource):
        spark.dataSource.register(source)
    return spark


def scan_store(spark: SparkSession, folder: str, prefix: str = "", content: bool = False) -> DataFrame:
    """`object_name, length, modificationTime` (and `content`) of all objects below a folder."""
    reader = register(spark).read.format("objects").option("prefix", prefix).option("content", str(content).lower())
    return reader.load(folder)


def store_objects(sample: DataFrame, source: str, target: str) -> None:
    """Copies the objects of `sample` (`object_name, file_name`) into a folder, all or none."""
    register(sample.sparkSession)
    sample.select("object_name", "file_name").write.format("object_copies").option("source", source).mode("append").save(target)
