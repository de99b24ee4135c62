"""Page files found and read by tasks: the driver holds no names of files.

Spark's own file scans list every file on the driver and keep it there, a kilobyte
and more for each file and scan.  Here the driver looks up the folders that a path
names; tasks list them, on any file system that Arrow knows.  One task lists from the
top until it meets ``SPREAD`` folders, which are dealt to all; what they find is dealt
again for reading.  A folder's listing is one task's work: streamed where it is local,
else in that task's memory.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.ship import shipped
from docweave.sources import filetree

SPREAD = 64
_FOUND = "root string, at string, depth int, path string"  # below a root; folders still to list have no path
_BATCH = 4096
_ENCODED = re.compile(r'["\x00-\x20\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000#%<>?\[\\\]^`{|}]')  # what Java's URIs quote


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that a path or glob names, as Hadoop resolves it; none where tasks can't list each of them through Arrow."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = list(given.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(given) or [])
    roots = [status.getPath().toString() for status in found]
    return roots if all(status.isDirectory() for status in found) and all(map(_known, roots)) else []


def _known(root: str) -> bool:
    try:
        filetree.file_system(root)
    except (pa.ArrowException, OSError):
        return False
    return True


@lru_cache(maxsize=64)
def _system(root: str) -> tuple[fs.FileSystem, str]:
    return filetree.file_system(root)


def uri(path: str) -> str:
    """A path as the URI that Spark's scans give."""
    return _ENCODED.sub(lambda m: quote(m[0], safe=""), path)


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(system: fs.FileSystem, folder: str, wanted: Callable[[str], bool]) -> Iterator[tuple[str, bool]]:
    """Name of each folder (true) and of each wanted file that isn't empty (false)."""
    if not isinstance(system, fs.LocalFileSystem):
        for info in system.get_file_info(fs.FileSelector(folder)):
            if info.type == fs.FileType.Directory or wanted(info.base_name) and info.size:
                yield info.base_name, info.type == fs.FileType.Directory
        return
    with os.scandir(folder) as listed:
        for entry in listed:
            try:
                if (is_folder := entry.is_dir()) or wanted(entry.name) and entry.stat().st_size:
                    yield entry.name, is_folder
            except FileNotFoundError:  # a link that leads nowhere, or a file that is gone
                continue


def _lister(pattern: str, first: int, last: int | None, spread: int | None):
    """Lists folders from rows of _FOUND; with ``spread``, hands on those that are left when there are so many."""
    matching = re.compile(pattern, re.DOTALL).fullmatch

    def below(root: str, at: str, depth: int) -> Iterator[tuple]:
        system, base = _system(root)
        left = deque([(at, depth)])
        while left:
            folder, level = left.popleft() if spread else left.pop()
            wanted = (lambda name: not _hidden(name) and matching(name) is not None) if level >= first else (lambda name: False)
            for name, is_folder in _entries(system, f"{base.rstrip('/')}/{folder}".rstrip("/") or "/", wanted):
                inner = f"{folder}/{name}" if folder else name
                if not is_folder:
                    yield root, inner, level, uri(f"{root.rstrip('/')}/{inner}")
                elif not _hidden(name) and (last is None or level < last):
                    left.append((inner, level + 1))
                    if spread and len(left) >= spread:
                        yield from ((root, *x, None) for x in left)
                        left.clear()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for root, at, depth, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path is None:
                    yield from below(root, at, depth)
                else:
                    yield root, at, depth, path

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = rows(batches)
        while some := list(islice(found, _BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), (pa.string(), pa.string(), pa.int32(), pa.string()), strict=True)], names=["root", "at", "depth", "path"])

    return listed


def _content(root: str, at: str) -> bytes:
    system, base = _system(root)
    with system.open_input_stream(f"{base.rstrip('/')}/{at}") as file:
        return file.read()


def files(spark: SparkSession, roots: list[str], pattern: str, first: int = 0, last: int | None = None) -> DataFrame:
    """path, file_name (both encoded, as Spark's scans give them) and html of the files ``first`` to ``last`` folders below the roots whose name a Hadoop glob matches.

    What Spark's scans leave out is left out: hidden files and folders, empty files.
    Folders are listed when the rows are asked for.  A file is read only where its
    row is kept and html used; a hundred at a time are in a task's memory.
    """
    shipped(spark)
    name = spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()
    cores = spark.sparkContext.defaultParallelism
    at_top = spark.createDataFrame([(root, "", 0, None) for root in roots], _FOUND)
    met = at_top.mapInArrow(_lister(name, first, last, SPREAD), _FOUND).repartition(cores, "at")
    # How many tasks read doesn't follow from bytes, as names are small; they stream, so four a core will do for any number of files.
    found = met.mapInArrow(_lister(name, first, last, None), _FOUND).repartition(min(4 * cores, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")
    read = F.udf(_content, "binary", useArrow=False)
    return found.select("path", F.substring_index("path", "/", -1).alias("file_name"), read("root", "at").cast("string").alias("html"))
