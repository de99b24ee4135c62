"""The crawl log as a stream: landed pages, each URL's first kept by state, written to log, tree and errors.

The seen set is keyed state.  It begins with the URLs that other runs have logged,
so a run that has lost its checkpoint goes on from the log; with its checkpoint
it goes on from its state.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from docweave.functions.text import utrim
from docweave.functions.urls import SITE, Site, page_file_path
from docweave.ship import shipped
from docweave.sources.filetree import write_tree

LANDED = "url string, status_code int, content string, error string"
#: Where a page stands among those that have landed: files by time and name, and within a file its place.
PLACE = "place"
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the running number of a task's rows at the end of their place (streams have no such expression)."""
    n = 0
    for batch in batches:
        numbers = pa.array(range(n, n + batch.num_rows), pa.int64())
        n += batch.num_rows
        place = batch.column(PLACE)
        arrays = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name != PLACE]
        yield pa.RecordBatch.from_arrays([*arrays, pa.StructArray.from_arrays([*place.flatten(), numbers], [*place.type.names, "row"])], [*[c for c in batch.schema.names if c != PLACE], PLACE])


def landed_pages(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """JSON rows of fetched pages as they land in a folder, with their place."""
    shipped(spark)
    rows = spark.readStream.schema(LANDED).option("maxFilesPerTrigger", max_files).json(path)
    file = F.struct(*[F.col(f"_metadata.{c}") for c in ("file_modification_time", "file_path", "file_block_start")])
    kind = "struct<file_modification_time: timestamp, file_path: string, file_block_start: bigint, row: bigint>"
    return rows.select("*", file.alias(PLACE)).mapInArrow(_numbered, f"{LANDED}, {PLACE} {kind}")


def log_rows(pages: DataFrame, site: Site = SITE) -> DataFrame:
    """Rows of the crawl log with the content they stand for; failed pages are left out."""
    title = utrim(F.regexp_extract("content", r"(?is)<title[^>]*>(.*?)</title>", 1))
    place = [PLACE] if PLACE in pages.columns else []
    return pages.where("error is null and content is not null").select(
        "url", page_file_path(F.col("url"), site).alias("file_path"), F.sha2("content", 256).alias("content_hash"),
        F.octet_length("content").cast("long").alias("content_length"), "status_code", F.coalesce(F.nullif(title, F.lit("")), F.lit("Untitled")).alias("title"), "content", *place,
    )


def error_rows(pages: DataFrame) -> DataFrame:
    return pages.where("error is not null").select("url", "error")


class FirstOfUrl(StatefulProcessor):
    """Hands on a URL's first row by the columns ``place``, once for all batches; a URL of the initial state never."""

    def __init__(self, columns: list[str], place: list[str]):
        self.columns, self.place = columns, place

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("seen", T.BooleanType())]))

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        self.seen.update((True,))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            return
        first = None
        for part in rows:  # one row is held, however many pages of a URL have landed
            if part.empty:
                continue
            named = part.set_axis(self.columns, axis=1)  # with an initial state, columns come without names
            first = pd.concat([x for x in (first, named) if x is not None]).sort_values(self.place, kind="stable").iloc[:1]
        if first is None:
            return
        self.seen.update((True,))
        yield first.drop(columns=self.place)

    def close(self) -> None:
        pass


def first_of_url(rows: DataFrame, logged: DataFrame) -> DataFrame:
    """Of each URL the first row by place, unless ``logged`` (url) has it; rows without a URL count as of one URL.

    ``place`` may be any struct of values that sort.  State is a row for each URL:
    it grows with the site, not with the pages that land.
    """
    shipped(rows.sparkSession)
    parts = rows.schema[PLACE].dataType.names
    names = [f"_place{i}" for i in range(len(parts))]
    kept = [c for c in rows.columns if c != PLACE]
    placed = rows.select(*kept, *[F.col(f"{PLACE}.{c}").alias(n) for c, n in zip(parts, names, strict=True)])
    out = T.StructType([rows.schema[c] for c in kept])
    return placed.groupBy("url").transformWithStateInPandas(FirstOfUrl(placed.columns, names), out, "append", "none", logged.select("url").distinct().groupBy("url"))


def run_of(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the run that a checkpoint belongs to; None of a new one."""
    try:
        line = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id").alias("id")).first()
    except AnalysisException:
        return None
    return line["id"] if line else None


def logged_urls(spark: SparkSession, log_path: str, but_run: str | None = None) -> DataFrame:
    """URLs in the log, but those of one run; none where there is no log yet."""
    try:
        rows = spark.read.schema("url string, run string").json(log_path)
    except AnalysisException:
        return spark.createDataFrame([], "url string")
    return rows.where(~F.col("run").eqNullSafe(but_run)).select("url") if but_run else rows.select("url")


def start_log(pages: DataFrame, log_path: str, checkpoint: str, errors_path: str | None = None, tree_path: str | None = None) -> list[StreamingQuery]:
    """Start writing each URL's first successful page to the log, its content to the tree, and errors to theirs.

    Returns the queries, the log's first; each takes the available rows and ends.
    ``pages`` have a place (``landed_pages``).  A batch writes to the folder
    ``run=<id>/batch=<n>`` of its own run, which a repeated batch overwrites, and the
    tree's files are named by their pages, so replays change nothing; a run with
    a new checkpoint never touches what another has written.
    """
    spark = pages.sparkSession

    def started(rows: DataFrame, name: str, write: Callable[[DataFrame, str], None]) -> StreamingQuery:
        run: dict[str, str] = {}
        known = threading.Event()

        def batch(found: DataFrame, number: int) -> None:
            known.wait()  # the first batch can come before start() has returned
            write(found, f"run={run['id']}/batch={number}")

        query = rows.writeStream.foreachBatch(batch).option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start()
        run["id"] = str(query.id)
        known.set()
        return query

    def log(rows: DataFrame, folder: str) -> None:
        if tree_path is not None:
            rows = rows.persist()
            write_tree(rows.select(F.col("file_path").alias("path"), "content"), tree_path)
        rows.drop("content").write.mode("overwrite").json(f"{log_path}/{folder}")
        rows.unpersist()

    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():  # the query takes the session's settings as it starts
        spark.conf.set(k, v)
    try:
        seen = logged_urls(spark, log_path, but_run=run_of(spark, f"{checkpoint}/log"))
        queries = [started(first_of_url(log_rows(pages), seen), "log", log)]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if errors_path is not None:
        queries.append(started(error_rows(pages), "errors", lambda rows, folder: rows.write.mode("overwrite").json(f"{errors_path}/{folder}")))
    return queries
