"""The training-corpus pipeline: five stages over ``documents``.

Each stage gets what the one before kept, as a table of the columns of
``documents``, and its decision takes effect: rejected documents go, duplicate
lines go, one document of each near-duplicate group stays, documents with
benchmark passages go, and the rest are tokenized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.bpe import tokenized
from docweave.llm.carry import CARRIED, carried
from docweave.llm.decontaminate import decontaminate
from docweave.llm.jaccard_join import jaccard_join
from docweave.llm.line_dedup import line_dedup
from docweave.llm.quality_rules import quality_rules
from docweave.llm.queries import tokenizer_path
from docweave.llm.store import written


#: What names a row: rows that agree in these have equal doc_id, source and text (by two hashes).
KEY = ["_id", "_host", "_h1", "_h2"]


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` as one struct, and the key of each row."""
    whole = F.coalesce("text", F.lit(""))
    return docs.select(carried(docs, None), F.col("doc_id").alias("_id"), F.col("source").alias("_host"), F.xxhash64(whole).alias("_h1"), F.xxhash64(F.lit("text"), whole).alias("_h2"))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key is in ``rejected``; nulls are equal."""
    rows, gone = _keyed(docs), rejected.select(*[F.col(c).alias(f"{c}_gone") for c in KEY]).distinct()
    return rows.join(gone, [F.col(c).eqNullSafe(F.col(f"{c}_gone")) for c in KEY], "left_anti").select(f"{CARRIED}.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    found = quality_rules(_keyed(docs).select(*KEY, F.col(CARRIED)["text"].alias("text")), host="_host", doc_id="_id")
    return _without(docs, found.where(~F.col("kept")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has; n_chars follows the text."""
    out = line_dedup(docs.select(carried(docs, None), F.col("doc_id").alias("_id"), F.col("text").alias("_text")), doc_id="_id", text="_text")
    own = {c: F.col(CARRIED)[c] for c in docs.columns}
    n_chars = F.when(F.col("n_dropped") > 0, F.length("_text").cast("long")).otherwise(own.get("n_chars"))
    made = {"text": F.col("_text"), "n_chars": n_chars}
    return out.select(*[made.get(c, own[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates.

    Rows without doc_id go where a row with one is in their group.
    """
    classes = jaccard_join(_keyed(docs).select(*KEY, F.col(CARRIED)["text"].alias("text")), doc_id="_id", keep=KEY)
    return _without(docs, classes.where(~F.col("_id").eqNullSafe(F.col("component_id"))))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(_keyed(docs).select(*KEY, F.col(CARRIED)["text"].alias("text")), items, keep=KEY)
    return _without(docs, found.where(F.size("bench_hits") > 0))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digest of the ids of each document, checked against its decoded text."""
    out = tokenized(docs, tokenizer_path(), keep=["doc_id", "text"], want=("n_tokens", "ids_sha256", "decoded_sha256"))
    return out.select("doc_id", "n_tokens", "ids_sha256", (F.col("decoded_sha256") == F.sha2(F.coalesce("text", F.lit("")), 256)).alias("exact"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("bpe", tokens),
]

#: SQL can't express the last stage; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and reread for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
