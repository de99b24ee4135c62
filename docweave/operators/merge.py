"""Merges of extracted facts on the dotted type name.

Where order decides (first creator, last value that isn't empty), an explicit
``ord`` column does, through min_by and max_by: aggregates with map-side combine
in place of chains of outer joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.dotnet import signature_params


def merge_types(members: DataFrame, types: DataFrame, enums: DataFrame) -> DataFrame:
    """One row for each type that any of three listings names: the first supplies assembly and namespace."""

    def keyed(df: DataFrame, rank: int, **extra: Column) -> DataFrame:
        none = {"description": F.lit(None).cast("string"), "remarks": F.lit(None).cast("string"), "n_enum": F.lit(0)}
        return df.select("fqn", "assembly", "namespace", "type_name", F.struct(F.lit(rank), F.col("ord")).alias("o"), *[c.alias(n) for n, c in (none | extra).items()])

    rows = keyed(members, 0).unionAll(keyed(types, 1, description=F.col("description"), remarks=F.col("remarks"))).unionAll(keyed(enums, 2, n_enum=F.lit(1)))
    first = [F.min_by(c, "o").alias(c) for c in ("assembly", "namespace", "type_name")]
    text = [F.coalesce(F.max_by(c, F.when(F.col(c) != "", F.col("o"))), F.lit("")).alias(c) for c in ("description", "remarks")]
    return rows.groupBy("fqn").agg(*first, *text, F.sum("n_enum").cast("long").alias("n_enum_members"), (F.max("n_enum") > 0).alias("is_enum"))


DETAILS = ("description", "signature", "params", "returns", "remarks")


def last_details(details: DataFrame) -> DataFrame:
    """Of each (type, member): the last value of each field that isn't empty; ``params`` may be a text or a list."""
    some = {c: F.size(c) > 0 if details.schema[c].dataType.typeName() == "array" else F.col(c) != "" for c in DETAILS}
    return details.groupBy("fqn", "member").agg(*[F.max_by(c, F.when(some[c], F.col("ord"))).alias(c) for c in DETAILS])


def enrich_members(members: DataFrame, details: DataFrame, fields: tuple[str, ...] = ("description", "signature", "returns", "remarks")) -> DataFrame:
    """Members with their details: all properties of a name, or else all methods of it; what is missing is empty."""
    kinds = members.groupBy("fqn", "member").agg(F.bool_or(F.col("kind") == "property").alias("_property"))
    found = last_details(details).join(kinds, ["fqn", "member"])
    joined = members.join(found, ["fqn", "member"], "left")
    taken = (F.col("kind") == "property") == F.coalesce("_property", F.lit(True))
    none = {c: F.array().cast(details.schema[c].dataType) if details.schema[c].dataType.typeName() == "array" else F.lit("") for c in fields}
    return joined.select("ord", "fqn", "member", "kind", *[F.coalesce(F.when(taken, F.col(c)), none[c]).alias(c) for c in fields])


def unmatched_details(details: DataFrame, members: DataFrame) -> DataFrame:
    return details.join(members.select("fqn", "member"), ["fqn", "member"], "left_anti")


def zip_params(names: Column, signature: Column) -> Column:
    """(name, type) of parameters by position, as many as both have."""
    types = F.coalesce(signature_params(signature), F.array().cast("array<string>"))
    pairs = F.zip_with(names, types, lambda n, t: F.struct(n.alias("name"), t.alias("type")))
    return F.filter(pairs, lambda p: p["name"].isNotNull() & p["type"].isNotNull())


def attach_members(types: DataFrame, details: DataFrame) -> DataFrame:
    """Details attached to their types alone; whatever has a parenthesis in its signature is a method."""
    kind = F.when(F.coalesce("signature", F.lit("")).contains("("), "method").otherwise("property")
    return details.join(types.select("fqn").distinct(), "fqn").withColumn("member_kind", kind)


def example_exact(refs: DataFrame, examples: DataFrame) -> DataFrame:
    """Content for example URLs by the very same URL; null where there is none."""
    return refs.join(examples.groupBy("url").agg(F.max_by("content", "ord").alias("content")), "url", "left")


def _ends(urls: DataFrame, column: str, lengths: DataFrame) -> DataFrame:
    """The ends of each URL, itself included, as long as one of ``lengths`` (_n): a row for each."""
    sizes = F.explode(F.sequence(F.lit(0), F.length(column))).alias("_n")
    return urls.select("*", sizes).join(lengths, "_n", "left_semi").withColumn("_end", F.right(column, F.col("_n"))).drop("_n")


def _lengths(urls: DataFrame, column: str) -> DataFrame:
    return urls.select(F.length(column).alias("_n")).distinct()


def example_lookup(refs: DataFrame, examples: DataFrame) -> DataFrame:
    """Content for example URLs: the same URL, else the first whose URL ends with the other's or the other way.

    Both ways are equi-joins on whole ends.  The first name of each end is found by
    an aggregate, so that a URL meets one row however many names end with it; the
    ends of a URL meet the names that are such an end.  So a lookup costs the
    length of its URL and its matches, whatever ending the URLs share.  Only ends
    as long as some URL of the other side are made.
    """
    left = refs.withColumn("_url", F.regexp_replace("url", "^/+", ""))
    right = examples.groupBy("url").agg(F.max_by("content", "ord").alias("content"), F.min("ord").alias("_ord")).select(F.col("url").alias("_found"), "content", "_ord")
    exact = left.join(right, F.col("_url") == F.col("_found"), "left").drop("_found", "_ord")
    missing = exact.where(F.col("content").isNull()).select("_url").distinct()
    names = examples.groupBy("url").agg(F.min("ord").alias("_ord")).select(F.col("url").alias("_found"), "_ord")
    first = F.min(F.struct("_ord", "_found")).alias("_first")
    longer = missing.join(_ends(names, "_found", _lengths(missing, "_url")).groupBy("_end").agg(first), F.col("_url") == F.col("_end")).select("_url", "_first")
    shorter = _ends(missing, "_url", _lengths(names, "_found")).join(names, F.col("_end") == F.col("_found")).select("_url", F.struct("_ord", "_found").alias("_first"))
    pick = longer.unionAll(shorter).groupBy("_url").agg(F.min("_first").alias("_first")).select("_url", F.col("_first._found").alias("_found"))
    contents = pick.join(right.select("_found", F.col("content").alias("_near")), "_found").drop("_found")
    return exact.join(contents, "_url", "left").withColumn("content", F.coalesce("content", "_near")).drop("_url", "_near")


def category_join(types: DataFrame, categories: DataFrame) -> DataFrame:
    """Types with their category: by the exact name, else by the name in lower case; the last listing wins."""
    exact = categories.groupBy(F.col("type_fqn").alias("fqn")).agg(F.max_by("category", "ord").alias("_exact"))
    lowered = categories.groupBy(F.lower("type_fqn").alias("_low")).agg(F.max_by("category", "ord").alias("_lower"))
    joined = types.withColumn("_low", F.lower("fqn")).join(exact, "fqn", "left").join(lowered, "_low", "left")
    return joined.withColumn("category", F.coalesce("_exact", "_lower")).drop("_low", "_exact", "_lower")


def example_category(refs: DataFrame, categorised: DataFrame) -> DataFrame:
    """The most common category of the types that refer to an example; the first seen on ties, else Other."""
    used = refs.withColumn("url", F.regexp_replace("url", "^/+", "")).join(categorised.select("fqn", "category"), "fqn", "left")
    counts = used.groupBy("url", "category").agg(F.count("*").alias("n"), F.min("ord").alias("o"))
    best = F.max_by("category", F.when(F.col("category").isNotNull(), F.struct("n", -F.col("o"))))
    return counts.groupBy("url").agg(F.coalesce(best, F.lit("Other")).alias("category"))


def keep_first(df: DataFrame, key: list[str], order: str = "ord") -> DataFrame:
    """The first row of each key by ``order``."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def keep_last(df: DataFrame, key: list[str], order: str = "ord") -> DataFrame:
    """The last row of each key by ``order``."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])
