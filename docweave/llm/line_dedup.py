"""Line deduplication across documents, with DataFrame functions only.

Lines are exploded as 128-bit hashes of their keys, once, and stored; an
aggregate with map-side combine finds the keys that at least two documents hold and the smallest of
those documents; the other holders lose the line.  Only hashes and positions
are shuffled for that; the texts meet the positions in one final join.  A key
that a third of all documents hold is one row on the small side of a join whose
large side streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.carry import CARRIED, carried, resolved
from docweave.llm.store import written

#: The characters stripped from both ends of a line, A-Z and a-z.
STRIP = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` where the text is all ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_keys(text: Column) -> Column:
    """The keys of all lines, in order."""
    return F.transform(F.split(lower_ascii(text), "\n"), lambda line: F.trim(line, F.lit(STRIP)))


def line_dedup(docs: DataFrame, min_chars: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``text`` deduplicated, plus n_lines, n_dropped.

    A null text counts as an empty one: one empty line.  Rows without doc_id
    keep their lines and count for no other.  Rows that share a doc_id are one
    document, and rows that repeat wholly fare alike.  An empty table gives an
    empty result.  Texts of any length are split whole.  Further columns pass
    through unchanged, whatever their names, but n_lines and n_dropped, which
    are replaced.
    """
    made = ["n_lines", "n_dropped"]
    whole = F.coalesce(F.col(text), F.lit(""))
    taken = {resolved(docs, c) for c in made}
    names = [c for c in docs.columns if resolved(docs, c) not in taken]
    # What names a row: rows that share both hold the same lines.
    source = docs.select(carried(docs, names, [text]), F.col(doc_id).alias("_id"), whole.alias("_text")).withColumn("_row", F.xxhash64("_text"))
    lines = (
        source.where(F.col("_id").isNotNull())
        .select("_id", "_row", F.posexplode(line_keys(F.col("_text"))).alias("_pos", "_key"))
        .where(F.length("_key") >= min_chars)
        .select("_id", "_row", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit("line"), "_key").alias("_h2"))
    )
    lines = written(lines, "line-hashes")  # read twice below, and hashed once
    shared = (
        lines.groupBy("_h1", "_h2")
        .agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
        .where(F.col("_first") != F.col("_last"))
        .select("_h1", "_h2", "_first")
    )
    shared = written(shared, "line-shared")  # so that both sides of the join below are shuffled for it, and a hot line can be split
    dropped = (
        lines.join(shared, ["_h1", "_h2"])
        .where(F.col("_id") != F.col("_first"))
        .groupBy("_id", "_row")
        .agg(F.collect_set("_pos").alias("_drop"))
    )
    # A column of its own, which the projection below reads more than once: within a lambda the split would run for each line.
    joined = source.join(dropped, ["_id", "_row"], "left").withColumn("_parts", F.split("_text", "\n"))
    parts = F.col("_parts")
    keep = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_drop"))
    kept = F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(F.array_join(F.transform(keep, lambda i: F.get(parts, i)), "\n"))
    out = joined.select(
        CARRIED, kept.alias("_kept"), F.size(parts).cast("long").alias("_n_lines"), F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("_n_dropped")
    )
    return out.select(
        *[F.col("_kept").alias(c) if resolved(docs, c) == resolved(docs, text) else F.col(CARRIED)[c].alias(c) for c in names],
        F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
    )
