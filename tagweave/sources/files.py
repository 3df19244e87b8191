"""Rows as files under their own names, and folders of files as rows.

Spark's own sinks name their files, and its file sources leave out empty ones. Here a file that
is empty or cannot be read is a row without content, so that nobody takes it for missing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from tagweave import fixed_values as fixed

SCHEMA = "filename string, path string, length long, content binary"
DONE = "_SUCCESS"
OPEN_BYTES = 128 << 10  # what opening a file costs, in bytes, when files are dealt to tasks of 1,000 small ones
TASK_BYTES = 128 << 20
BATCH_BYTES = 4 << 20


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    # Some readers name the same store differently.
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("file:/", "file:///", 1) if "://" not in path else path.replace("s3a://", "s3://", 1))


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class NamedFiles(DataSource):
    """``df.write.format("named_files").mode(...).save(path)`` for rows ``(filename, content)``.

    A file appears whole: it is written beside its place and moved there. A task that runs again
    writes the same names again, so a lost executor leaves nothing twice. A failed job
    removes the files of its finished tasks. ``overwrite`` clears the folder first. A null
    content is an empty file; a null or empty name, or one with a folder in it, is an error.
    """

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> NamedFilesReader:
        return NamedFilesReader(self.options["path"], [e for e in self.options.get("extensions", "").split(",") if e])

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        if [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields] != ["filename string", "content binary"]:
            raise ValueError(f"rows are (filename string, content binary), not {schema.simpleString()}")
        folder = self.options["path"]
        store, path = file_system(folder)
        if overwrite and store.get_file_info(path).type != fs.FileType.NotFound:
            store.delete_dir_contents(path)
        store.create_dir(path, recursive=True)
        return NamedFilesWriter(folder)


@dataclass
class Files(InputPartition):
    paths: list[tuple[str, int]]


class NamedFilesReader(DataSourceReader):
    """Files of a folder in order of names, a few to a task, with hidden ones left out."""

    def __init__(self, folder: str, extensions: list[str]):
        self.folder, self.extensions = folder, extensions

    def partitions(self) -> list[Files]:
        store, path = file_system(self.folder)
        infos = store.get_file_info(fs.FileSelector(path))
        ends = tuple("." + e.lower() for e in self.extensions)
        infos = sorted((i.path, i.size or 0) for i in infos if i.type == fs.FileType.File and i.base_name[:1] not in "._")
        infos = [(p, n) for p, n in infos if not ends or p.lower().endswith(ends)]
        parts, held = [], TASK_BYTES
        for p, n in infos:
            if held + OPEN_BYTES + n > TASK_BYTES:
                parts.append([])
                held = 0
            parts[-1].append((p, n))
            held += OPEN_BYTES + n
        return [Files(x) for x in parts] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = file_system(self.folder)
        rows, size = [], 0
        for p, n in partition.paths:
            try:
                with store.open_input_stream(p) as file:
                    content = file.read()
            except OSError:
                content = None
            rows.append((p.rsplit("/", 1)[-1], p, n, content or None))
            size += n
            if size > BATCH_BYTES:
                yield _file_rows(rows)
                rows, size = [], 0
        if rows:
            yield _file_rows(rows)


def _file_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["filename", "path", "length", "content"])


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import uuid

        store, path = file_system(self.folder)
        names = []
        for batch in iterator:
            for name, content in zip(batch.column("filename").to_pylist(), batch.column("content")):
                if not name or "/" in name or name in (".", "..", DONE):
                    raise ValueError(f"not a file name: {name!r}")
                # Hidden from scans until it is whole.
                beside = f"{path}/_{uuid.uuid4().hex}"
                with store.open_output_stream(beside) as out:
                    if content.is_valid:
                        out.write(content.as_buffer())
                store.move(beside, f"{path}/{name}")
                names.append(name)
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = file_system(self.folder)
        with store.open_output_stream(f"{path}/{DONE}"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        store, path = file_system(self.folder)
        for message in messages:
            for name in message.names if message else ():
                if store.get_file_info(f"{path}/{name}").type == fs.FileType.File:
                    store.delete_file(f"{path}/{name}")


def write_files(files: DataFrame, folder: str, overwrite: bool = True) -> None:
    """Write ``files (filename, content)`` into a folder that every task can reach, one file a row."""
    register(files.sparkSession)
    files.select("filename", "content").write.format("named_files").mode("overwrite" if overwrite else "append").save(folder)


def scan_files(spark: SparkSession, folder: str, extensions: list[str] = fixed.IMAGE_EXTENSIONS) -> DataFrame:
    """Files of a folder with one of ``extensions`` in any case, as ``(filename, path, length, content)``.

    An empty file, or one that cannot be read, has null content.
    """
    register(spark)
    return spark.read.format("named_files").option("extensions", ",".join(extensions)).load(folder)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NamedFiles)
