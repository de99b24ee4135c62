"""Data-quality operators: statistics in single passes, and issues as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docweave.ship import shipped

#: Prefixes of documentation ids.
ID_PREFIXES = ("T:", "P:", "M:", "F:", "E:")


def count_of(condition: Column) -> Column:
    return F.count_if(condition).cast("long")


def filled(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) != ""


def coverage(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows, and for each field how many are filled and their floored percentage; one pass."""
    total = F.count("*")
    out = [total.cast("long").alias("total")]
    for c in fields:
        n = count_of(filled(c))
        out += [n.alias(f"with_{c}"), F.when(total > 0, F.floor(n * 100 / total)).otherwise(0).cast("long").alias(f"pct_{c}")]
    return df.agg(*out)


def duplicates(df: DataFrame, key: str, listed: str) -> DataFrame:
    """Keys of more than one row with their sorted members, joined by blanks."""
    return (
        df.groupBy(key)
        .agg(F.count("*").cast("long").alias("n"), F.array_join(F.array_sort(F.collect_list(F.col(listed).cast("string"))), " ").alias("members"))
        .where("n > 1")
    )


#: Messages that a task holds at once, and parts in which the tasks' findings meet first.
HELD_MESSAGES, MEETINGS = 100_000, 64


def _first_rows(samples: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Folds a task's rows (error, ord, url) into one of each message: how many, and the first ``samples`` by ord and url."""

    def given(held: dict[str, list]) -> pa.RecordBatch:
        rows = [{"error": e, "n": n, "first": [{"ord": o, "url": u} for o, u in first]} for e, (n, first) in held.items()]
        return pa.RecordBatch.from_pylist(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by([("error", "ascending"), ("ord", "ascending"), ("url", "ascending")])
            code = table["error"].combine_chunks().dictionary_encode().indices.to_numpy()
            begins = np.flatnonzero(np.diff(code, prepend=-1))
            for start, end in zip(begins.tolist(), [*begins[1:].tolist(), len(code)], strict=True):
                top = table.slice(start, min(samples, end - start)).to_pylist()
                known = held.setdefault(top[0]["error"], [0, []])
                known[0] += end - start
                known[1] = sorted([*known[1], *[(r["ord"], r["url"]) for r in top]], key=lambda r: (r[0], r[1] is not None, r[1] or ""))[:samples]
            if len(held) > HELD_MESSAGES:
                yield given(held)
                held.clear()
        yield given(held)

    return run


def error_histogram(log: DataFrame, samples: int = 3) -> DataFrame:
    """Errors by message: their number, and the first URLs by ``ord`` (ties by URL).

    A bounded fold with a map-side part: each task hands on one row of a message, with
    sorted arrays of ``samples`` rows; these meet in parts and then by message.  No
    message's rows are ever sorted or held in one task.  Rows need an ``ord``.
    """
    shipped(log.sparkSession)
    failed = log.where(F.col("error").isNotNull() & F.col("ord").isNotNull()).select("error", "ord", "url")
    kinds = failed.schema
    schema = T.StructType([kinds["error"], T.StructField("n", T.LongType()), T.StructField("first", T.ArrayType(T.StructType([kinds["ord"], kinds["url"]])))])
    part = failed.mapInArrow(_first_rows(samples, to_arrow_schema(schema)), schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MEETINGS)))
    for keys in (["error", "part"], ["error"]):
        part = part.groupBy(*keys).agg(F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, samples).alias("first"))
    return part.select("error", "n", F.array_join(F.transform("first", lambda s: s["url"]), " ").alias("urls"))


def page_issues(pages: DataFrame) -> DataFrame:
    """(url, issue) warnings of crawled pages: missing fields, little content, no HTML."""
    low = F.lower(F.coalesce("content", F.lit("")))
    checks = F.array_compact(
        F.array(
            F.when(~filled("url"), "missing url"),
            F.when(~filled("content"), "missing content"),
            F.when(filled("content") & (F.length("content") < 100), "short content"),
            F.when(filled("content") & ~low.contains("<html") & ~low.contains("<!doctype"), "no html"),
        )
    )
    return pages.select("url", F.explode(checks).alias("issue"))


def doc_id_issues(ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """(doc_id, issue) errors of documentation ids: prefix, blanks, empty parts."""
    value = F.col(column)
    name = F.regexp_replace(value, "^[^:]*:", "")
    checks = F.array_compact(
        F.array(
            F.when(~F.substring(value, 1, 2).isin(*ID_PREFIXES), "prefix"),
            F.when(value.contains(":") & name.contains(" "), "blank"),
            F.when(value.contains(":") & (name.contains("..") | name.startswith(".") | name.endswith(".")), "empty part"),
        )
    )
    return ids.select(column, F.explode(checks).alias("issue"))


def markdown_issue(content: Column) -> Column:
    """The first fault of a Markdown page with front matter, null if it has none."""
    lines = F.split(content, "\n")
    closing = F.array_position(F.slice(lines, 2, 19), "---")
    return (
        F.when(F.coalesce(F.trim(content), F.lit("")) == "", "empty")
        .when(~content.startswith("---\n"), "no front matter")
        .when(closing == 0, "front matter not closed")
        .when(~content.rlike(r"(?m)^#"), "no heading")
    )


def missing(source: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys of ``source`` that ``found`` lacks."""
    return source.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")


def two_way_missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, with the side that lacks them."""
    a = left.select(key).distinct().withColumn("_a", F.lit(1))
    b = right.select(key).distinct().withColumn("_b", F.lit(1))
    side = F.when(F.col("_b").isNull(), "right").otherwise("left")
    return a.join(b, key, "full").where("_a is null or _b is null").select(key, side.alias("lacking"))


def hash_mismatches(log: DataFrame, pages: DataFrame, key: str, content: str) -> DataFrame:
    """Rows of ``log`` (key, logged) whose page has another hash; pages are hashed where they are, only hashes travel."""
    actual = pages.select(key, F.sha2(content, 256).alias("_actual"))
    return log.join(actual, key).where(F.col("_actual") != F.col("logged"))
