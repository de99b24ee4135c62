"""Quality rules with DataFrame functions only: text statistics and line frequency.

Statistics and line hashes come from each whole text in one pass without a
shuffle.  The cross-document rule counts for each host the distinct documents
that hold a normalised line, removes lines above the limits, and rejects
documents with too few words left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.carry import CARRIED, carried
from docweave.llm.line_dedup import line_keys
from docweave.llm.store import written

#: Word, symbol and white-space patterns.
NOT_WORD = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also within lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, NOT_WORD), "")


def repeated_words(all_words: Column, width: int = 5) -> Column:
    """How many words stand in windows of ``width`` words that occur twice or more in the text.

    Window hashes are sorted with their places; places with an equal neighbour
    are sorted again, and each covers as many words as come before the next.
    """

    def covered(places: Column) -> Column:
        gaps = F.zip_with(F.slice(places, 2, F.size(places) - 1), F.slice(places, 1, F.size(places) - 1), lambda b, a: F.least(b - a, F.lit(width)))
        return F.aggregate(gaps, F.lit(width), lambda s, g: s + g)

    def places(pairs: Column) -> Column:
        n = F.size(pairs)
        before = F.concat(F.array(F.lit(None).cast("bigint")), F.slice(pairs["h"], 1, n - 1))
        after = F.concat(F.slice(pairs["h"], 2, n - 1), F.array(F.lit(None).cast("bigint")))
        joined = F.arrays_zip(pairs.alias("p"), before.alias("b"), after.alias("a"))
        same = F.filter(joined, lambda x: x["p"]["h"].eqNullSafe(x["b"]) | x["p"]["h"].eqNullSafe(x["a"]))
        return F.array_sort(F.transform(same, lambda x: x["p"]["i"]))

    def count(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(let(pairs, places), covered))

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - width),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(width)]),
        )

    hashed = F.transform(all_words, lambda w: F.xxhash64(w))
    return F.when(F.size(all_words) < width, F.lit(0)).otherwise(let(let(hashed, windows), count)).cast("long")


def statistics(whole: Column) -> dict[str, Column]:
    """_stats (n_words, word_chars, n_repeat_words), n_symbols and n_dup_lines of a text."""
    stats = let(
        words(whole),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    duplicates = let(F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD_CHAR)), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return {"_stats": stats, "_symbols": F.regexp_count(whole, F.lit(SYMBOL)).cast("long"), "_dup": duplicates}


def line_hashes(whole: Column, min_chars: int) -> Column:
    """Of each line of enough characters: the hash of its key in two halves, and its number of words."""
    long = F.filter(line_keys(whole), lambda key: F.length(key) >= min_chars)
    return F.transform(long, lambda key: F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"), F.size(F.split(key, NOT_WORD)).alias("n")))


def quality_rules(docs: DataFrame, host: str = "source", doc_id: str = "doc_id", text: str = "text", min_words: int = 10, max_repeat_percent: int = 20, min_line_chars: int = 10, min_line_docs: int = 20, max_host_percent: int = 10, max_line_docs: int = 10_000) -> DataFrame:
    """One row for each row of ``docs``: its columns but the text, statistics, base_failed, n_boilerplate_words, kept.

    base_failed: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` of them in repeated windows.  A line is above the
    limits where more than ``min_line_docs`` documents of a host, and more than
    ``max_host_percent`` of them, hold it, or more than ``max_line_docs`` at
    all, which is what acts on very large hosts.  A document is depleted when
    fewer than ``min_words`` words are outside such lines.  A null or empty text
    has no words; null hosts are one host; rows that share a doc_id are one
    document, and so are those without; rows that repeat get the same verdict
    each; an empty table gives no rows.  Columns may have any name but the eight
    made here, which replace them.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_boilerplate_words", "kept"]
    whole = F.coalesce(F.col(text), F.lit(""))
    # One pass over the texts; what follows reads hashes and numbers only.
    rows = docs.select(
        carried(docs, None, [*made, text]), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"), F.col(doc_id).alias("_id"),
        *[c.alias(n) for n, c in statistics(whole).items()], line_hashes(whole, min_line_chars).alias("_lines"),
    )
    rows = written(rows.withColumn("_rid", F.monotonically_increasing_id()), "quality-rows")
    lines = rows.select("_rid", "_host", "_id", F.explode("_lines").alias("_line")).select("_rid", "_host", "_id", "_line.h1", "_line.h2", "_line.n")
    hosts = rows.groupBy("_host", "_id").agg(F.lit(1).alias("_one")).groupBy("_host").agg(F.count("*").alias("_total"))
    frequent = (
        lines.groupBy("_host", "h1", "h2", "_id")
        .agg(F.lit(1).alias("_one"))
        .groupBy("_host", "h1", "h2")
        .agg(F.count("*").alias("_docs"))
        .where(F.col("_docs") > min(min_line_docs, max_line_docs))
        .join(hosts, "_host")
        .where((F.col("_docs") > max_line_docs) | ((F.col("_docs") > min_line_docs) & (F.col("_docs") * 100 > F.col("_total") * max_host_percent)))
        .select("_host", "h1", "h2")
    )
    removed = lines.join(frequent, ["_host", "h1", "h2"]).groupBy("_rid").agg(F.sum("n").cast("long").alias("_removed"))
    joined = rows.join(removed, "_rid", "left").withColumn("_removed", F.coalesce("_removed", F.lit(0).cast("long")))
    failed = (F.col("_stats.n_words") < min_words) | (100 * F.col("_stats.n_repeat_words") > max_repeat_percent * F.col("_stats.n_words"))
    return joined.select(
        f"{CARRIED}.*",
        "_stats.n_words", "_stats.word_chars", F.col("_symbols").alias("n_symbols"), F.col("_dup").alias("n_dup_lines"), "_stats.n_repeat_words",
        failed.alias("base_failed"),
        F.col("_removed").alias("n_boilerplate_words"),
        (~failed & (F.col("_stats.n_words") - F.col("_removed") >= min_words)).alias("kept"),
    )
