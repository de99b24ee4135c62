"""Checks over written corpora and exports: rows of (name, severity, passed, detail), and what is made of them.

A check is a one-row DataFrame, so a validator is a union of checks; nothing is
sampled where the whole can be checked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(df: DataFrame, name: str, passed: Column, detail: Column, severity: str = "error") -> DataFrame:
    """One check from aggregates over ``df``."""
    return df.agg(F.coalesce(passed, F.lit(False)).alias("passed"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail")).select(F.lit(name).alias("name"), F.lit(severity).alias("severity"), "passed", "detail")


def check_each(df: DataFrame, key: str, name: str, passed: Column, detail: Column, severity: str = "error") -> DataFrame:
    """The same check for each value of ``key``, which stands behind its name."""
    found = df.groupBy(key).agg(F.coalesce(passed, F.lit(False)).alias("passed"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail"))
    return found.select(F.concat_ws(" ", F.lit(name), key).alias("name"), F.lit(severity).alias("severity"), "passed", "detail")


def existing(files: DataFrame, expected: list[str], severity: str = "error") -> DataFrame:
    """One check for each expected file or directory (ending in ``/``) against a listing (path) of files."""
    wanted = F.explode(F.array(*[F.lit(e) for e in expected])).alias("expected")
    parts = F.split("path", "/")
    parents = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat(F.array_join(F.slice(parts, F.lit(1), n), "/"), F.when(n < F.size(parts), "/").otherwise("")))
    have = files.select(F.explode(parents).alias("expected")).distinct().withColumn("_have", F.lit(True))
    asked = files.sparkSession.range(1).select(wanted)
    return asked.join(have, "expected", "left").select(
        F.concat(F.lit("exists "), "expected").alias("name"), F.lit(severity).alias("severity"), F.coalesce("_have", F.lit(False)).alias("passed"),
        F.when(F.col("_have").isNull(), F.concat(F.lit("missing: "), "expected")).otherwise("").alias("detail"),
    )


def required_keys(documents: DataFrame, keys: list[str], name: str = "name", json: str = "json", severity: str = "warning") -> DataFrame:
    """One check for each JSON document (name, json): that it is an object with the required keys."""
    parsed = F.from_json(F.col(json), "map<string,string>")
    lacking = F.array_except(F.array(*[F.lit(k) for k in keys]), F.coalesce(F.map_keys(parsed), F.array().cast("array<string>")))
    valid = F.coalesce(F.json_object_keys(F.col(json)).isNotNull(), F.lit(False))
    detail = F.when(~valid, "not a JSON object").when(F.size(lacking) > 0, F.concat(F.lit("missing keys: "), F.array_join(lacking, ", "))).otherwise("")
    return documents.select(F.concat(F.lit("keys of "), name).alias("name"), F.lit(severity).alias("severity"), (valid & (F.size(lacking) == 0)).alias("passed"), detail.alias("detail"))


def crawl_run(log: DataFrame, sources: DataFrame | None = None, least_rows: int = 138, least_percent: int = 95, boundary: Column | None = None) -> DataFrame:
    """Checks of a crawl's run: prerequisites (distinct source URLs), rows, success rate, URLs within the boundary.

    The runs differ in ``least_rows`` (a test run asks for fewer) and
    ``least_percent``.  log: url, error; sources: url.
    """
    good = F.count_if(F.col("error").isNull())
    parts = [
        check(log, "rows", good >= least_rows, good),
        check(log, "success rate", good * 100 >= F.count("*") * least_percent, F.floor(good * 100 / F.greatest(F.count("*"), F.lit(1)))),
        check(log, "rows have a URL", F.count_if(F.coalesce("url", F.lit("")) == "") == 0, F.count_if(F.coalesce("url", F.lit("")) == "")),
    ]
    if sources is not None:
        parts.append(check(sources, "source URLs", F.countDistinct("url") > 0, F.countDistinct("url")))
    if boundary is not None:
        parts.append(check(log, "inside the boundary", F.count_if(~boundary) == 0, F.count_if(~boundary)))
    return united(parts)


def united(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def stated_counts(stated: DataFrame, counted: DataFrame) -> DataFrame:
    """One check for each number of a statistics file (one row) that a count of the data (one row) has too: that they are equal."""

    def long(row: DataFrame, value: str) -> DataFrame:
        names = [c for c in stated.columns if c in counted.columns]
        return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("bigint").alias(value)) for c in names])).alias("r")).select("r.*")

    joined = long(stated, "stated").join(long(counted, "counted"), "name")
    detail = F.format_string("%s stated, %s counted", F.coalesce(F.col("stated").cast("string"), F.lit("nothing")), F.col("counted").cast("string"))
    return joined.select("name", F.lit("error").alias("severity"), F.col("stated").eqNullSafe(F.col("counted")).alias("passed"), detail.alias("detail"))


def files_by_extension(files: DataFrame) -> DataFrame:
    """extension, number and bytes of a listing (path, bytes)."""
    extension = F.regexp_extract(F.substring_index("path", "/", -1), r"\.([^.]*)$", 1)
    return files.groupBy(F.lower(extension).alias("extension")).agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes"))


def first_rows(log: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of a crawl log by ``ord``: a sample to look at."""
    return log.orderBy("ord").limit(n)


def hash_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows chosen by the hash of their key: a sample that every run repeats."""
    return rows.orderBy(F.md5(key), key).limit(n)


def guide_pages(files: DataFrame) -> DataFrame:
    """Markdown files below docs/ but those with a directory ``examples`` in their path."""
    parts = F.split("path", "/")
    return files.where((F.get(parts, F.lit(0)) == "docs") & F.col("path").endswith(".md") & ~F.array_contains(F.slice(parts, 2, F.size(parts)), "examples"))


def verdict(checks: DataFrame) -> DataFrame:
    """One row: whether no error failed, and the numbers of checks, errors and warnings; no checks pass nothing."""
    error = (F.col("severity") == "error") & ~F.col("passed")
    warning = (F.col("severity") == "warning") & ~F.col("passed")
    return checks.agg((F.coalesce(F.bool_and(~error), F.lit(False))).alias("passed"), F.count("*").alias("checks"), F.count_if(error).alias("errors"), F.count_if(warning).alias("warnings"))


def exit_code(checks: DataFrame) -> int:
    """0 where the verdict is good, else 1."""
    return 0 if verdict(checks).first()["passed"] else 1


def report(checks: DataFrame) -> DataFrame:
    """One row: the report as JSON, with statistics, and the errors and warnings that failed, by name."""

    def failed(severity: str) -> Column:
        return F.array_sort(F.collect_list(F.when((F.col("severity") == severity) & ~F.col("passed"), F.concat_ws(": ", "name", F.nullif("detail", F.lit(""))))))

    stats = F.struct(F.count("*").alias("checks"), F.count_if("passed").alias("passed"))
    return checks.agg(F.to_json(F.struct(stats.alias("statistics"), failed("error").alias("errors"), failed("warning").alias("warnings"))).alias("report"))
