"""``format("filetree")``: a sink that writes one file for each row (path, content), or for the parts of each path.

Tasks write straight to the target on any file system that Arrow knows (local
and mounted folders, hdfs, s3, gs), each file in a passing folder first and then
moved, so a reader never sees a part of one; a task that is tried again writes the
same files again.  With ``parts``, rows of one path that follow each other go to one
file as they come: it may be larger than a task's memory.  The driver moves
nothing: it clears the target before an overwrite, deletes the passing folder, and
marks the end with ``_SUCCESS``, which holds the number of files.  A job that fails
leaves whole files without that mark.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from docweave.ship import shipped


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")  # Hadoop writes file:/folder too


@dataclass
class _Written(WriterCommitMessage):
    files: int


class FileTreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "filetree"

    def schema(self) -> str:
        return "path string, content string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], self.options.get("parts") == "true")


class _Writer(DataSourceWriter):
    def __init__(self, root: str, parts: bool = False):
        self.root, self.parts = root.rstrip("/"), parts
        self.passing = f"{self.root}/_passing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> _Written:
        system, root = file_system(self.root)
        _, passing = file_system(self.passing)
        system.create_dir(passing, recursive=True)
        n, made, current, out, held = 0, set[str](), None, None, ""

        def finished() -> int:
            if out is None:
                return 0
            out.close()
            target = f"{root}/{current}"
            folder = target.rpartition("/")[0]
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            system.move(held, target)
            return 1

        try:
            for row in iterator:
                relative = PurePosixPath(row.path)
                if relative.is_absolute() or ".." in relative.parts:
                    raise ValueError(f"not below the target: {row.path}")
                if not self.parts or out is None or str(relative) != current:
                    n += finished()
                    current, held = str(relative), f"{passing}/{uuid.uuid4().hex}"
                    out = system.open_output_stream(held)
                out.write((row.content or "").encode())
            return _Written(n + finished())
        except BaseException:
            if out is not None and not out.closed:
                out.close()
            raise

    def _cleaned(self) -> None:
        system, passing = file_system(self.passing)
        if system.get_file_info(passing).type != fs.FileType.NotFound:
            system.delete_dir(passing)

    def commit(self, messages: list[_Written | None]) -> None:
        self._cleaned()
        system, root = file_system(self.root)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/_SUCCESS") as out:
            out.write(str(sum(m.files for m in messages if m)).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        self._cleaned()


def files_written(root: str) -> int:
    """How many files the last write to ``root`` has made."""
    system, path = file_system(root.rstrip("/"))
    with system.open_input_stream(f"{path}/_SUCCESS") as mark:
        return int(mark.read())


def cleared(root: str) -> None:
    """Delete what is below ``root`` (a fresh run)."""
    system, path = file_system(root)
    if system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_dir_contents(path)


def write_tree(files: DataFrame, root: str, mode: str = "append", order: str | None = None) -> None:
    """Write rows of (path, content) below ``root``; of rows with one path the last by ``order`` is written.

    ``append`` keeps what is there (resume), ``overwrite`` clears first (fresh).
    """
    if order is not None:
        files = files.groupBy("path").agg(F.max_by("content", order).alias("content"))
    _write(files.select("path", "content"), root, mode, "false")


def _write(files: DataFrame, root: str, mode: str, parts: str) -> None:
    shipped(files.sparkSession).dataSource.register(FileTreeSource)
    if mode == "overwrite":
        cleared(root)
    files.write.format("filetree").option("parts", parts).mode("append").save(root)


def _in_order(parts: DataFrame) -> DataFrame:
    """All parts of a path in one task, in order: a sort that spills, no group in memory."""
    return parts.repartition("path").sortWithinPartitions("path", "ord").select("path", "part")


def write_parts(parts: DataFrame, root: str, mode: str = "append") -> None:
    """Write files from their parts (path, ord, part) in the order of ``ord``, each streamed to its file."""
    _write(_in_order(parts).withColumnRenamed("part", "content"), root, mode, "true")


def gathered(parts: DataFrame) -> DataFrame:
    """path and content of files from their parts, for files that fit in a row."""
    listed = F.array_sort(F.collect_list(F.struct("ord", "part")))
    return parts.groupBy("path").agg(F.array_join(F.transform(listed, lambda p: p["part"]), "").alias("content"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, current, digest, size = ["path", "n_bytes", "content_md5"], None, None, 0
    for batch in batches:
        out: list[tuple[str, int, str]] = []
        for path, part in zip(batch.column("path").to_pylist(), batch.column("part").to_pylist(), strict=True):
            if digest is None or path != current:
                if digest is not None:
                    out.append((current, size, digest.hexdigest()))
                current, digest, size = path, hashlib.md5(), 0
            raw = (part or "").encode()
            digest.update(raw)
            size += len(raw)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=names)
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([size], pa.int64()), pa.array([digest.hexdigest()])], names=names)


def digested(parts: DataFrame) -> DataFrame:
    """path, n_bytes and content_md5 of the files that ``write_parts`` would write; no file is ever whole in memory."""
    return _in_order(parts).mapInArrow(_hashed, "path string, n_bytes long, content_md5 string")


def listed(files: DataFrame) -> DataFrame:
    """path, n_bytes and content_md5 of files (path, content)."""
    return files.select("path", F.octet_length("content").cast("long").alias("n_bytes"), F.md5("content").alias("content_md5"))
