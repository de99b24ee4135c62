"""Columns that pass through an operator, and ids of any type.

All columns that an operator hands through travel as one struct, so none of its
internal names can clash with theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docweave.llm.store import written

CARRIED = "_carried"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def resolved(docs: DataFrame, name: str) -> str:
    """A name as the session tells it from others: without case, unless it is set to mind that."""
    return name if docs.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else name.lower()


def carried(docs: DataFrame, keep: list[str] | None, made: list[str] | tuple[str, ...] = ()) -> Column:
    """The columns of ``keep`` (all by default) but those named ``made``, as one struct."""
    taken = {resolved(docs, c) for c in made}
    names = [c for c in (keep or docs.columns) if resolved(docs, c) not in taken]
    return (F.struct(*[F.col(quoted(c)).alias(c) for c in names]) if names else F.expr("named_struct()")).alias(CARRIED)


def extended(docs: DataFrame, keep: list[str], made: str) -> StructType:
    """The schema of some columns of ``docs`` and of those that the DDL ``made`` names."""
    return StructType([*[docs.schema[c] for c in keep], *StructType.fromDDL(made).fields])


def numbered(docs: DataFrame, doc_id: str) -> DataFrame:
    """``docs`` (of internal columns) plus _order: a long that ascends with ``doc_id``; null ids come last.

    Integers are their own order.  Ids of another type get the numbers of a
    distributed sort, written so that they can't change on recomputation.
    """
    last = F.lit((1 << 63) - 1)
    if dict(docs.dtypes)[doc_id] in ("tinyint", "smallint", "int", "bigint"):
        return docs.withColumn("_order", F.coalesce(F.col(doc_id).cast("long"), last))
    ids = docs.where(F.col(doc_id).isNotNull()).select(doc_id).distinct().orderBy(doc_id).withColumn("_order", F.monotonically_increasing_id())
    return docs.join(written(ids, "order"), doc_id, "left").withColumn("_order", F.coalesce("_order", last))
