"""One named text file per row: a Spark data source that writes in two phases.

    register(spark)
    df.select("name", "text").write.format("named_files").mode("append").save(folder)

Tasks write to a staging folder inside the target, one sub-folder per attempt; only when all tasks have
ended are the files moved to their names, all in the target folder itself.  A job that fails or is
aborted leaves no file there (a task that was still running may leave the hidden staging folder), and an attempt that is run again or in double adds none.  A name that comes
twice, or that is no plain file name, fails the job before any file is moved.  An existing file of the
same name is replaced; ``mode("overwrite")`` first removes what the folder holds.

Read, the source gives a row per file of the target folder itself, empty ones too, whose name matches the
option ``glob`` (default: all), many small files to a task:

    spark.read.format("named_files").option("glob", "*.md").load(folder)

The folder has to be one that driver and executors share, as a path or a URI that pyarrow opens.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

STAGING = "_staging"
TASK_BYTES, TASK_FILES = 32 << 20, 2000


def _open(folder: str):
    """(file system, path) of a folder."""
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder[5:]
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _check(name) -> None:
    if not name or "/" in name or "\\" in name or name[0] in "._":
        raise ValueError(f"not a plain file name: {name!r}")


@dataclass
class Written(WriterCommitMessage):
    """Where an attempt put its files, and their names."""

    staged: str
    names: list[str]


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite, self.job = folder.rstrip("/"), overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _open(self.folder)
        staged, names = f"{root}/{STAGING}/{self.job}/{uuid.uuid4().hex}", []
        store.create_dir(staged, recursive=True)
        for batch in iterator:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text"), strict=True):
                _check(name)
                with store.open_output_stream(f"{staged}/{name}") as f:
                    f.write((text.as_py() or "").encode())
                names.append(name)
        return Written(staged, names)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _open(self.folder)
        seen: set[str] = set()
        for m in filter(None, messages):
            for name in m.names:
                if name in seen:
                    self.abort(messages)
                    raise ValueError(f"two rows are named {name!r}")
                seen.add(name)
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(root)):
                if old.base_name != STAGING:
                    (store.delete_dir if old.type == fs.FileType.Directory else store.delete_file)(old.path)
        for m in filter(None, messages):
            for name in m.names:
                store.move(f"{m.staged}/{name}", f"{root}/{name}")
        self._clear(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_open(self.folder))

    def _clear(self, store, root: str) -> None:
        """Remove this job's staging folder, and the common one if no other job uses it."""
        if store.get_file_info(f"{root}/{STAGING}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{STAGING}/{self.job}")
        if store.get_file_info(f"{root}/{STAGING}").type == fs.FileType.Directory and \
                not store.get_file_info(fs.FileSelector(f"{root}/{STAGING}")):
            store.delete_dir(f"{root}/{STAGING}")


@dataclass
class Files(InputPartition):
    paths: list[str]


class NamedFilesReader(DataSourceReader):
    def __init__(self, folder: str, glob: str):
        self.folder, self.glob = folder.rstrip("/"), glob

    def partitions(self) -> list[Files]:
        store, root = _open(self.folder)
        out, size = [Files([])], 0
        for f in sorted(store.get_file_info(fs.FileSelector(root)), key=lambda f: f.path):
            if f.type != fs.FileType.File or f.base_name[0] in "._" or not fnmatchcase(f.base_name, self.glob):
                continue
            if out[-1].paths and (size + f.size > TASK_BYTES or len(out[-1].paths) >= TASK_FILES):
                out.append(Files([]))
                size = 0
            out[-1].paths.append(f.path)
            size += f.size
        return out

    def read(self, partition: Files) -> Iterator[tuple[str, str]]:
        store, _ = _open(self.folder)
        for path in partition.paths:
            with store.open_input_stream(path) as f:
                yield path.rsplit("/", 1)[1], f.read().decode("utf-8", "replace")


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, text string"

    def reader(self, schema) -> NamedFilesReader:
        return NamedFilesReader(self.options["path"], self.options.get("glob", "*"))

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NamedFiles)


def write_named_files(df: DataFrame, folder: str, name: str = "name", text: str = "text", mode: str = "append") -> None:
    """Each row's text as a file of its own in ``folder``."""
    register(df.sparkSession)
    (df.select(F.col(name).cast("string").alias("name"), F.col(text).cast("string").alias("text"))
     .write.format("named_files").mode(mode).save(folder))


def read_named_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``name, text`` of the files directly inside ``folder``."""
    register(spark)
    return spark.read.format("named_files").option("glob", glob).load(folder)
