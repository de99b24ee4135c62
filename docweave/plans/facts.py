"""Queries over merged facts: merges, joins, aggregates, indexes, rendered pages, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import dotnet, names, render, text, urls
from docweave.operators import merge, quality
from docweave.plans.base import base
from docweave.plans.registry import query

c = F.col


def n(column: Column | str = "*") -> Column:
    return F.count(column).cast("long")


def long(column: Column) -> Column:
    return column.cast("long")


# --- merges
_MERGED = """(
  WITH u AS (
    SELECT fqn, assembly, namespace, type_name, 0 AS r, ord, NULL AS description, NULL AS remarks, 0 AS e FROM [members] m
    UNION ALL SELECT fqn, assembly, namespace, type_name, 1, ord, description, remarks, 0 FROM [types] t
    UNION ALL SELECT fqn, assembly, namespace, type_name, 2, ord, NULL, NULL, 1 FROM [enums] x
  ) SELECT fqn, arg_min(assembly, r * 1000000000 + ord) AS assembly, arg_min(namespace, r * 1000000000 + ord) AS namespace, arg_min(type_name, r * 1000000000 + ord) AS type_name,
      coalesce(max(nullif(description, '')), '') AS description, coalesce(max(nullif(remarks, '')), '') AS remarks, CAST(sum(e) AS BIGINT) AS n_enum_members, max(e) > 0 AS is_enum
  FROM u GROUP BY fqn)"""


def merged_types(spark, sf_dir) -> DataFrame:
    return merge.merge_types(*[base(spark, sf_dir, r) for r in ("members", "types", "enums")])


query("merge_types", f"SELECT * FROM {_MERGED} t")(merged_types)

_LAST = """(SELECT fqn, member, arg_max(description, ord) FILTER (WHERE description <> '') AS description, arg_max(signature, ord) FILTER (WHERE signature <> '') AS signature,
  arg_max(returns, ord) FILTER (WHERE returns <> '') AS returns, arg_max(remarks, ord) FILTER (WHERE remarks <> '') AS remarks FROM [details] d GROUP BY fqn, member)"""
_ENRICHED = f"""(SELECT m.ord, m.fqn, m.member, m.kind, coalesce(CASE WHEN t THEN l.description END, '') AS description, coalesce(CASE WHEN t THEN l.signature END, '') AS signature,
  coalesce(CASE WHEN t THEN l.returns END, '') AS returns, coalesce(CASE WHEN t THEN l.remarks END, '') AS remarks
  FROM (SELECT m.*, (kind = 'property') = bool_or(kind = 'property') OVER (PARTITION BY fqn, member) AS t FROM [members] m) m LEFT JOIN {_LAST} l ON m.fqn = l.fqn AND m.member = l.member)"""


@query("enrich_members", f"SELECT * FROM {_ENRICHED} e")
def enrich_members(spark, sf_dir):
    return merge.enrich_members(base(spark, sf_dir, "members"), base(spark, sf_dir, "details"))


@query("unmatched_details", "SELECT ord, fqn, member FROM [details] d WHERE NOT EXISTS (SELECT 1 FROM [members] m WHERE m.fqn = d.fqn AND m.member = d.member)")
def unmatched_details(spark, sf_dir):
    return merge.unmatched_details(base(spark, sf_dir, "details"), base(spark, sf_dir, "members")).select("ord", "fqn", "member")


@query("zip_params", "SELECT ord, 'a:System.String' || CASE WHEN size % 3 = 0 THEN '|b:System.Int32@' WHEN size % 7 = 0 THEN '|b:Acme.List<System.int,X>' ELSE '' END || CASE WHEN size % 21 = 0 THEN '|c:Acme.List<System.int,X>' ELSE '' END AS params FROM [details] d WHERE params <> ''")
def zip_params(spark, sf_dir):
    rows = base(spark, sf_dir, "details").where("params <> ''")
    pairs = merge.zip_params(F.split("params", r"\|"), c("signature"))
    return rows.select("ord", F.array_join(F.transform(pairs, lambda p: F.concat(p["name"], F.lit(":"), p["type"])), "|").alias("params"))


@query("attach_members", "SELECT d.ord, d.fqn, d.member, CASE WHEN contains(signature, '(') THEN 'method' ELSE 'property' END AS member_kind FROM [details] d WHERE fqn IN (SELECT fqn FROM [types] t)")
def attach_members(spark, sf_dir):
    return merge.attach_members(base(spark, sf_dir, "types"), base(spark, sf_dir, "details")).select("ord", "fqn", "member", "member_kind")


@query(
    "example_lookup",
    """WITH e AS (SELECT CASE WHEN ord % 3 = 0 THEN 'site/' || url ELSE url END AS url, content, ord FROM [examples] x),
       r AS (SELECT ord, url, regexp_replace(url, '^/+', '') AS u FROM [example_refs] r),
       x AS (SELECT r.ord, e.content, e.ord AS o, CASE WHEN e.url = r.u THEN 0 ELSE 1 END AS k FROM r JOIN e ON ends_with(e.url, r.u) OR ends_with(r.u, e.url))
       SELECT r.ord, r.url, md5(b.content) AS content_md5 FROM r LEFT JOIN (SELECT ord, arg_min(content, k * 1000000000 + o) AS content FROM x GROUP BY ord) b USING (ord)""",
)
def example_lookup(spark, sf_dir):
    examples = base(spark, sf_dir, "examples").withColumn("url", F.when(c("ord") % 3 == 0, F.concat(F.lit("site/"), "url")).otherwise(c("url")))
    return merge.example_lookup(base(spark, sf_dir, "example_refs"), examples).select("ord", "url", F.md5("content").alias("content_md5"))


_CATEGORISED = f"""(SELECT t.*, coalesce(a.category, b.category) AS category FROM {_MERGED} t
  LEFT JOIN (SELECT type_fqn, arg_max(category, ord) AS category FROM [categories] c GROUP BY 1) a ON a.type_fqn = t.fqn
  LEFT JOIN (SELECT lower(type_fqn) AS low, arg_max(category, ord) AS category FROM [categories] c GROUP BY 1) b ON b.low = lower(t.fqn))"""


def categorised(spark, sf_dir) -> DataFrame:
    return merge.category_join(merged_types(spark, sf_dir), base(spark, sf_dir, "categories"))


@query("category_join", f"SELECT fqn, category FROM {_CATEGORISED} t")
def category_join(spark, sf_dir):
    return categorised(spark, sf_dir).select("fqn", "category")


_REF_CATS = f"(SELECT regexp_replace(r.url, '^/+', '') AS url, k.category, count(*) AS n, min(r.ord) AS o FROM [example_refs] r LEFT JOIN {_CATEGORISED} k ON k.fqn = r.fqn GROUP BY 1, 2)"
_EXAMPLE_CAT = f"(SELECT url, coalesce(arg_max(category, n * 1000000000 - o) FILTER (WHERE category IS NOT NULL), 'Other') AS category FROM {_REF_CATS} x GROUP BY url)"


def example_categories(spark, sf_dir) -> DataFrame:
    return merge.example_category(base(spark, sf_dir, "example_refs"), categorised(spark, sf_dir))


query("example_category", f"SELECT * FROM {_EXAMPLE_CAT} t")(example_categories)


@query("example_types", "SELECT regexp_replace(url, '^/+', '') AS url, string_agg(DISTINCT fqn, '|' ORDER BY fqn) AS types FROM [example_refs] r GROUP BY 1")
def example_types(spark, sf_dir):
    refs = base(spark, sf_dir, "example_refs").withColumn("url", F.regexp_replace("url", "^/+", ""))
    return refs.groupBy("url").agg(F.array_join(F.array_sort(F.collect_set("fqn")), "|").alias("types"))


@query("example_urls_distinct", "SELECT DISTINCT trim(url) AS url FROM [example_refs] r")
def example_urls_distinct(spark, sf_dir):
    return base(spark, sf_dir, "example_refs").select(text.utrim(c("url")).alias("url")).where("url <> ''").distinct()


@query("dedupe_first", "SELECT url, arg_min(title, ord) AS title, CAST(min(ord) AS BIGINT) AS ord FROM [crawl_log] l GROUP BY url")
def dedupe_first(spark, sf_dir):
    return merge.keep_first(base(spark, sf_dir, "crawl_log").select("url", "title", "ord", c("ord").alias("o")), ["url"], "o").select("url", "title", "ord")


@query("dedupe_last", "SELECT url, arg_max(content, ord) AS content, CAST(max(ord) AS BIGINT) AS ord FROM (SELECT regexp_replace(url, '_[0-9]+\\.htm$', '') AS url, content, ord FROM [examples] e) GROUP BY url")
def dedupe_last(spark, sf_dir):
    rows = base(spark, sf_dir, "examples").select(F.regexp_replace("url", r"_[0-9]+\.htm$", "").alias("url"), "content", "ord", c("ord").alias("o"))
    return merge.keep_last(rows, ["url"], "o").select("url", "content", long(c("ord")).alias("ord"))


@query("dedupe_url", "SELECT DISTINCT url FROM [crawl_log] l")
def dedupe_url(spark, sf_dir):
    return base(spark, sf_dir, "crawl_log").select("url").dropDuplicates(["url"])


# --- crawl sets
@query("member_urls", "SELECT DISTINCT url FROM [members] m WHERE kind IN ('property', 'method')")
def member_urls(spark, sf_dir):
    members = base(spark, sf_dir, "members")
    return members.where("kind = 'property'").select("url").union(members.where("kind = 'method'").select("url")).distinct()


@query("crawl_frontier", "SELECT DISTINCT 'https://docs.example.com' || url AS url FROM [members] m ORDER BY 1")
def crawl_frontier(spark, sf_dir):
    return base(spark, sf_dir, "members").select(urls.absolute_url(c("url"), "https://docs.example.com").alias("url")).distinct().orderBy("url")


@query("frontier_limit", "SELECT DISTINCT url FROM [members] m ORDER BY 1 LIMIT 100")
def frontier_limit(spark, sf_dir):
    """The first 100 pages: the limit of a test crawl."""
    return base(spark, sf_dir, "members").select("url").distinct().orderBy("url").limit(100)


_CRAWLED = "(SELECT DISTINCT url FROM [crawl_log] l WHERE error IS NULL)"
_SOURCES = "(SELECT DISTINCT url FROM [crawl_log] l)"


@query("missing_urls", f"SELECT url FROM {_SOURCES} s WHERE url NOT IN (SELECT url FROM {_CRAWLED} k)")
def missing_urls(spark, sf_dir):
    log = base(spark, sf_dir, "crawl_log")
    return quality.missing(log, log.where("error is null"), "url")


@query("orphan_missing", "SELECT coalesce(a.fqn, b.fqn) AS fqn, CASE WHEN b.fqn IS NULL THEN 'right' ELSE 'left' END AS lacking FROM (SELECT DISTINCT fqn FROM [members] m) a FULL JOIN (SELECT DISTINCT fqn FROM [enums] e UNION SELECT DISTINCT fqn FROM [types] t) b ON a.fqn = b.fqn WHERE a.fqn IS NULL OR b.fqn IS NULL")
def orphan_missing(spark, sf_dir):
    other = base(spark, sf_dir, "enums").select("fqn").union(base(spark, sf_dir, "types").select("fqn"))
    return quality.two_way_missing(base(spark, sf_dir, "members"), other, "fqn")


@query("resume_pending", "SELECT DISTINCT url FROM [crawl_log] l WHERE url NOT IN (SELECT url FROM [crawl_log] k WHERE title = '')")
def resume_pending(spark, sf_dir):
    """URLs that are still to be fetched where the pages without a title are the ones logged so far."""
    log = base(spark, sf_dir, "crawl_log")
    return quality.missing(log, log.where("title = ''"), "url")


@query("hash_mismatch", "SELECT page_id FROM pages WHERE page_id % 10 = 3")
def hash_mismatch(spark, sf_dir):
    """Logged hashes against the pages' own; the log is made to be wrong for some."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    log = pages.select("page_id", F.sha2(F.when(c("page_id") % 10 == 3, F.concat("html", F.lit("x"))).otherwise(c("html")), 256).alias("logged"))
    return quality.hash_mismatches(log, pages.select("page_id", "html"), "page_id", "html").select("page_id")


@query("toc_html_join", "SELECT id, url, EXISTS (SELECT 1 FROM supplier s WHERE s_suppkey % 3 <> 0 AND t.url = '/help/api/guide/s' || CAST(s_suppkey AS STRING) || '.htm') AS found FROM [toc] t WHERE is_leaf")
def toc_html_join(spark, sf_dir):
    have = spark.read.parquet(f"{sf_dir}/supplier.parquet").where("s_suppkey % 3 <> 0")
    files = have.select(F.concat(F.lit("/help/api/guide/s"), c("s_suppkey").cast("string"), F.lit(".htm")).alias("url"), F.lit(True).alias("_have"))
    return base(spark, sf_dir, "toc").where("is_leaf").join(files, "url", "left").select("id", "url", F.coalesce("_have", F.lit(False)).alias("found"))


@query("cross_count_check", "SELECT (SELECT count(*) FROM [members] m) AS n_members, (SELECT count(*) FROM [details] d) AS n_details, (SELECT count(*) FROM [members] m) = (SELECT count(*) FROM [details] d) AS equal_counts")
def cross_count_check(spark, sf_dir):
    left = base(spark, sf_dir, "members").agg(n().alias("n_members"))
    return left.crossJoin(base(spark, sf_dir, "details").agg(n().alias("n_details"))).withColumn("equal_counts", c("n_members") == c("n_details"))


# --- crawl statistics
@query("crawl_stats", "SELECT count(*) AS total, count(*) FILTER (WHERE error IS NULL) AS successful, count(*) FILTER (WHERE error IS NOT NULL) AS failed, count(*) FILTER (WHERE title = '') AS untitled FROM [crawl_log] l")
def crawl_stats(spark, sf_dir):
    of = quality.count_of
    return base(spark, sf_dir, "crawl_log").agg(n().alias("total"), of(c("error").isNull()).alias("successful"), of(c("error").isNotNull()).alias("failed"), of(c("title") == "").alias("untitled"))


@query("success_rate", "SELECT round(100.0 * count(*) FILTER (WHERE error IS NULL) / count(*), 6)::DOUBLE AS rate, 100.0 * count(*) FILTER (WHERE error IS NULL) / count(*) >= 95 AS passed FROM [crawl_log] l")
def success_rate(spark, sf_dir):
    rate = F.count_if(c("error").isNull()) * F.lit(100.0).cast("double") / F.count("*")
    return base(spark, sf_dir, "crawl_log").agg(F.round(rate, 6).alias("rate"), (rate >= 95).alias("passed"))


@query("crawl_log_summary", "SELECT count(*) AS total, count(DISTINCT url) AS unique_urls, CAST(sum(content_length) AS BIGINT) AS total_bytes, round(avg(content_length), 6) AS avg_bytes FROM [crawl_log] l")
def crawl_log_summary(spark, sf_dir):
    return base(spark, sf_dir, "crawl_log").agg(n().alias("total"), long(F.countDistinct("url")).alias("unique_urls"), long(F.sum("content_length")).alias("total_bytes"), F.round(F.avg("content_length"), 6).alias("avg_bytes"))


@query("duplicate_content", "SELECT content_hash, count(*) AS n, string_agg(CAST(doc_id AS STRING), ' ' ORDER BY CAST(doc_id AS STRING)) AS members FROM (SELECT md5(text) AS content_hash, doc_id FROM documents) GROUP BY 1 HAVING count(*) > 1")
def duplicate_content(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.md5("text").alias("content_hash"), "doc_id")
    return quality.duplicates(docs, "content_hash", "doc_id")


@query("duplicate_types", "SELECT type_name, count(*) AS n, string_agg(fqn, ' ' ORDER BY fqn) AS members FROM [types] t GROUP BY 1 HAVING count(*) > 1")
def duplicate_types(spark, sf_dir):
    return quality.duplicates(base(spark, sf_dir, "types"), "type_name", "fqn")


@query("error_histogram", "SELECT error, count(*) AS n, array_to_string((list(url ORDER BY ord))[1:3], ' ') AS urls FROM [crawl_log] l WHERE error IS NOT NULL GROUP BY error")
def error_histogram(spark, sf_dir):
    return quality.error_histogram(base(spark, sf_dir, "crawl_log"))


@query("metadata_consistency", "SELECT count(*) - count(DISTINCT url) AS duplicate_urls, count(*) FILTER (WHERE coalesce(title, '') = '' OR coalesce(url, '') = '') AS incomplete FROM [crawl_log] l")
def metadata_consistency(spark, sf_dir):
    lacking = ~quality.filled("title") | ~quality.filled("url")
    return base(spark, sf_dir, "crawl_log").agg(long(F.count("*") - F.countDistinct("url")).alias("duplicate_urls"), quality.count_of(lacking).alias("incomplete"))


# --- coverage
def _coverage_sql(relation: str, fields: list[str]) -> str:
    parts = ", ".join(f"count(*) FILTER (WHERE coalesce({f}, '') <> '') AS with_{f}, CAST(floor(count(*) FILTER (WHERE coalesce({f}, '') <> '') * 100 / count(*)) AS BIGINT) AS pct_{f}" for f in fields)
    return f"SELECT count(*) AS total, {parts} FROM [{relation}] t"


_TYPE_FIELDS, _MEMBER_FIELDS = ["description", "remarks", "type_name"], ["description", "signature", "params", "returns", "remarks", "member", "fqn"]


@query("coverage_types", _coverage_sql("types", _TYPE_FIELDS))
def coverage_types(spark, sf_dir):
    return quality.coverage(base(spark, sf_dir, "types"), _TYPE_FIELDS)


@query("coverage_members", _coverage_sql("details", _MEMBER_FIELDS))
def coverage_members(spark, sf_dir):
    return quality.coverage(base(spark, sf_dir, "details"), _MEMBER_FIELDS)


@query("member_summary", "SELECT count(*) AS total, count(*) FILTER (WHERE params <> '') AS with_params, count(*) FILTER (WHERE returns <> '') AS with_returns, count(*) FILTER (WHERE remarks <> '') AS with_remarks FROM [details] d")
def member_summary(spark, sf_dir):
    return base(spark, sf_dir, "details").agg(n().alias("total"), *[quality.count_of(quality.filled(f)).alias(f"with_{f}") for f in ("params", "returns", "remarks")])


_COUNTED = "(SELECT fqn, count(*) FILTER (WHERE kind = 'property') AS p, count(*) FILTER (WHERE kind = 'method') AS m FROM [members] m GROUP BY fqn)"


@query("type_stats", f"SELECT count(*) AS total, count(*) FILTER (WHERE p > 0) AS with_properties, count(*) FILTER (WHERE m > 0) AS with_methods, count(*) FILTER (WHERE p + m = 0) AS with_none, CAST(sum(p) AS BIGINT) AS properties, CAST(sum(m) AS BIGINT) AS methods FROM {_COUNTED} t")
def type_stats(spark, sf_dir):
    of = quality.count_of
    counted = base(spark, sf_dir, "members").groupBy("fqn").agg(F.count_if(c("kind") == "property").alias("p"), F.count_if(c("kind") == "method").alias("m"))
    return counted.agg(n().alias("total"), of(c("p") > 0).alias("with_properties"), of(c("m") > 0).alias("with_methods"), of(c("p") + c("m") == 0).alias("with_none"), long(F.sum("p")).alias("properties"), long(F.sum("m")).alias("methods"))


@query("missing_names", "SELECT ord FROM [crawl_log] l WHERE trim(coalesce(title, '')) = ''")
def missing_names(spark, sf_dir):
    return base(spark, sf_dir, "crawl_log").where(text.utrim(F.coalesce("title", F.lit(""))) == "").select("ord")


# --- indexes
_FULL = f"""(SELECT k.*, coalesce(x.p, 0) AS n_properties, coalesce(x.m, 0) AS n_methods FROM {_CATEGORISED} k LEFT JOIN {_COUNTED} x ON x.fqn = k.fqn)"""


def full_types(spark, sf_dir) -> DataFrame:
    counted = base(spark, sf_dir, "members").groupBy("fqn").agg(F.count_if(c("kind") == "property").alias("p"), F.count_if(c("kind") == "method").alias("m"))
    joined = categorised(spark, sf_dir).join(counted, "fqn", "left")
    zero = F.lit(0)
    return joined.withColumns({"n_properties": long(F.coalesce("p", zero)), "n_methods": long(F.coalesce("m", zero))}).drop("p", "m")


@query("by_assembly", f"SELECT assembly, count(*) AS n, string_agg(fqn, '|' ORDER BY type_name, fqn) AS types FROM {_MERGED} t GROUP BY assembly")
def by_assembly(spark, sf_dir):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("type_name", "fqn"))), lambda t: t["fqn"])
    return merged_types(spark, sf_dir).groupBy("assembly").agg(n().alias("n"), F.array_join(listed, "|").alias("types"))


@query("by_assembly_category", f"SELECT assembly, category, count(*) AS n FROM {_CATEGORISED} t GROUP BY 1, 2")
def by_assembly_category(spark, sf_dir):
    return categorised(spark, sf_dir).groupBy("assembly", "category").agg(n().alias("n"))


_ENTRY = """'- [' || type_name || '](../' || CASE WHEN is_enum THEN 'enums' ELSE 'types' END || '/' || type_name || '/_overview.md)'"""


@query("category_index", f"SELECT coalesce(category, 'Uncategorized') AS category, category IS NULL AS last, count(*) AS n, string_agg({_ENTRY} || CASE WHEN category IS NOT NULL AND description <> '' THEN ' - ' || CASE WHEN length(description) > 100 THEN left(description, 100) || '...' ELSE description END ELSE '' END, chr(10) ORDER BY type_name, fqn) AS entries FROM {_CATEGORISED} t GROUP BY 1, 2")
def category_index(spark, sf_dir):
    link = F.concat(F.lit("- ["), "type_name", F.lit("](../"), F.when(c("is_enum"), "enums").otherwise("types"), F.lit("/"), "type_name", F.lit("/_overview.md)"))
    about = F.when(c("category").isNotNull() & (c("description") != ""), F.concat(F.lit(" - "), text.truncate_description(c("description")))).otherwise("")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("type_name", "fqn", F.concat(link, about).alias("e")))), lambda t: t["e"])
    grouped = categorised(spark, sf_dir).groupBy(F.coalesce("category", F.lit("Uncategorized")).alias("category"), c("category").isNull().alias("last"))
    return grouped.agg(n().alias("n"), F.array_join(listed, "\n").alias("entries"))


@query("assembly_index", f"SELECT assembly, count(*) AS n, count(*) FILTER (WHERE NOT is_enum) AS regular, count(*) FILTER (WHERE is_enum) AS enums FROM {_MERGED} t GROUP BY assembly")
def assembly_index(spark, sf_dir):
    return merged_types(spark, sf_dir).groupBy("assembly").agg(n().alias("n"), quality.count_of(~c("is_enum")).alias("regular"), quality.count_of(c("is_enum")).alias("enums"))


@query("global_stats", f"SELECT count(*) AS types, count(*) FILTER (WHERE is_enum) AS enums, count(*) FILTER (WHERE NOT is_enum) AS regular, CAST(sum(n_properties) AS BIGINT) AS properties, CAST(sum(n_methods) AS BIGINT) AS methods, CAST(sum(n_enum_members) AS BIGINT) AS enum_members FROM {_FULL} t")
def global_stats(spark, sf_dir):
    of = quality.count_of
    return full_types(spark, sf_dir).agg(n().alias("types"), of(c("is_enum")).alias("enums"), of(~c("is_enum")).alias("regular"), *[long(F.sum(f"n_{k}")).alias(k) for k in ("properties", "methods", "enum_members")])


@query("category_counts", f"SELECT category, count(*) AS n FROM {_CATEGORISED} t WHERE category IS NOT NULL GROUP BY category ORDER BY n DESC, category")
def category_counts(spark, sf_dir):
    return categorised(spark, sf_dir).where("category is not null").groupBy("category").agg(n().alias("n")).orderBy(F.desc("n"), "category")


@query("category_summary", "SELECT category, count(*) AS type_count, string_agg(type_fqn, '|' ORDER BY ord) AS types FROM [categories] c GROUP BY category")
def category_summary(spark, sf_dir):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ord", "type_fqn"))), lambda t: t["type_fqn"])
    return base(spark, sf_dir, "categories").groupBy("category").agg(n().alias("type_count"), F.array_join(listed, "|").alias("types"))


@query("top_types", f"SELECT fqn, n_properties + n_methods AS members FROM {_FULL} t WHERE NOT is_enum ORDER BY 2 DESC, fqn LIMIT 20")
def top_types(spark, sf_dir):
    """The 20 largest types; a top-k report."""
    return full_types(spark, sf_dir).where(~c("is_enum")).select("fqn", (c("n_properties") + c("n_methods")).alias("members")).orderBy(F.desc("members"), "fqn").limit(20)


@query("sorted_members", "SELECT fqn, member, ord FROM [members] m ORDER BY fqn, member, ord")
def sorted_members(spark, sf_dir):
    return base(spark, sf_dir, "members").select("fqn", "member", "ord").orderBy("fqn", "member", "ord")


@query("export_stats", f"SELECT (SELECT count(*) FROM {_MERGED} t) AS types, (SELECT count(*) FROM [members] m WHERE kind = 'property') AS properties, (SELECT count(*) FROM [members] m WHERE kind = 'method') AS methods, (SELECT count(*) FROM [enums] e) AS enum_members, (SELECT count(*) FROM [examples] e) AS examples, (SELECT count(DISTINCT category) FROM [categories] c) AS categories")
def export_stats(spark, sf_dir):
    members = base(spark, sf_dir, "members").agg(quality.count_of(c("kind") == "property").alias("properties"), quality.count_of(c("kind") == "method").alias("methods"))
    ones = [merged_types(spark, sf_dir).agg(n().alias("types")), members, base(spark, sf_dir, "enums").agg(n().alias("enum_members")), base(spark, sf_dir, "examples").agg(n().alias("examples"))]
    out = base(spark, sf_dir, "categories").agg(long(F.countDistinct("category")).alias("categories"))
    for one in ones:
        out = out.crossJoin(one)  # one row each
    return out.select("types", "properties", "methods", "enum_members", "examples", "categories")


@query("xmldoc_stats", f"SELECT count(DISTINCT fqn) AS types, count(*) AS members, count(*) FILTER (WHERE kind = 'property') AS properties, count(*) FILTER (WHERE kind = 'method') AS methods, count(*) FILTER (WHERE contains(signature, '(')) AS with_params, count(*) FILTER (WHERE description = '') AS placeholders FROM {_ENRICHED} e")
def xmldoc_stats(spark, sf_dir):
    of = quality.count_of
    return enrich_members(spark, sf_dir).agg(
        long(F.countDistinct("fqn")).alias("types"), n().alias("members"), of(c("kind") == "property").alias("properties"), of(c("kind") == "method").alias("methods"),
        of(dotnet.signature_params(c("signature")).isNotNull()).alias("with_params"), of(c("description") == "").alias("placeholders"),
    )


_IDS = "(SELECT assembly, CASE WHEN kind = 'property' THEN 'P:' ELSE 'M:' END || fqn || '.' || member AS doc_id FROM [members] m UNION ALL SELECT assembly, 'F:' || fqn || '.' || enum_member FROM [enums] e UNION ALL SELECT assembly, 'T:' || fqn FROM [types] t)"


def all_ids(spark, sf_dir) -> DataFrame:
    members, enums, types = (base(spark, sf_dir, r) for r in ("members", "enums", "types"))
    ids = members.select("assembly", F.concat(F.when(c("kind") == "property", "P:").otherwise("M:"), "fqn", F.lit("."), "member").alias("doc_id"))
    return ids.unionAll(enums.select("assembly", F.concat(F.lit("F:"), "fqn", F.lit("."), "enum_member"))).unionAll(types.select("assembly", F.concat(F.lit("T:"), "fqn")))


@query("docid_prefix_counts", "SELECT assembly, " + ", ".join(f"count(*) FILTER (WHERE starts_with(doc_id, '{p}:')) AS {p.lower()}_ids" for p in "TPMFE") + f" FROM {_IDS} i GROUP BY assembly")
def docid_prefix_counts(spark, sf_dir):
    return all_ids(spark, sf_dir).groupBy("assembly").agg(*[quality.count_of(c("doc_id").startswith(p + ":")).alias(f"{p.lower()}_ids") for p in "TPMFE"])


@query("issues_by_severity", "SELECT severity, count(*) AS n FROM (SELECT CASE WHEN size % 5 IN (0, 2, 3, 4) THEN 'error' END AS severity FROM [members] m UNION ALL SELECT CASE WHEN NOT ends_with(url, '.html') THEN 'warning' END FROM [members] m) WHERE severity IS NOT NULL GROUP BY severity")
def issues_by_severity(spark, sf_dir):
    from docweave.plans.scalars import _BAD_ID

    members = base(spark, sf_dir, "members")
    errors = quality.doc_id_issues(members.select(F.expr(_BAD_ID).alias("doc_id"))).select(F.lit("error").alias("severity"))
    warnings = members.where(~c("url").endswith(".html")).select(F.lit("warning").alias("severity"))
    return errors.unionAll(warnings).groupBy("severity").agg(n().alias("n"))


_CODE = "(CASE WHEN contains(content, '<code>') THEN trim(regexp_extract(content, '<code>(.*?)</code>', 1, 's')) ELSE '' END)"


@query("parse_stats", "SELECT count(*) AS total, count(*) FILTER (WHERE contains(content, '<code>')) AS with_code, count(*) FILTER (WHERE NOT contains(content, '<code>')) AS text_only, count(*) FILTER (WHERE content = '') AS empty_rows FROM [examples] e")
def parse_stats(spark, sf_dir):
    of = quality.count_of
    return base(spark, sf_dir, "examples").agg(n().alias("total"), of(c("content").contains("<code>")).alias("with_code"), of(~c("content").contains("<code>")).alias("text_only"), of(c("content") == "").alias("empty_rows"))


@query("example_issues", f"SELECT count(*) FILTER (WHERE length({_CODE}) = 0) AS no_code, count(*) FILTER (WHERE length({_CODE}) BETWEEN 1 AND 49) AS short_code, count(*) - count(DISTINCT {_CODE}) AS repeated FROM [examples] e")
def example_issues(spark, sf_dir):
    size = F.length("code")
    coded = base(spark, sf_dir, "examples").select(text.first_code(c("content")).alias("code"))
    return coded.agg(quality.count_of(size == 0).alias("no_code"), quality.count_of(size.between(1, 49)).alias("short_code"), long(F.count("*") - F.countDistinct("code")).alias("repeated"))


@query("guide_checks", "SELECT count(*) AS leaves, count(*) >= 100 AS enough, count(*) FILTER (WHERE url = '') AS without_url FROM [toc] t WHERE is_leaf")
def guide_checks(spark, sf_dir):
    return base(spark, sf_dir, "toc").where("is_leaf").agg(n().alias("leaves"), (F.count("*") >= 100).alias("enough"), quality.count_of(c("url") == "").alias("without_url"))


@query("files_per_dir", "SELECT split_part(file_path, '/', 2) AS dir, count(DISTINCT file_path) AS files FROM [crawl_log] l GROUP BY 1")
def files_per_dir(spark, sf_dir):
    return base(spark, sf_dir, "crawl_log").groupBy(F.split_part("file_path", F.lit("/"), F.lit(2)).alias("dir")).agg(long(F.countDistinct("file_path")).alias("files"))


@query("dirs_without_overview", "SELECT dir FROM (SELECT fqn AS dir, bool_or(size % 13 = 0) AS has FROM [members] m GROUP BY fqn) WHERE NOT has")
def dirs_without_overview(spark, sf_dir):
    files = base(spark, sf_dir, "members").select(F.concat("fqn", F.lit("/"), F.when(c("size") % 13 == 0, "_overview").otherwise(c("member")), F.lit(".md")).alias("path"))
    by_dir = files.groupBy(F.substring_index("path", "/", 1).alias("dir")).agg(F.bool_or(F.substring_index("path", "/", -1) == "_overview.md").alias("has"))
    return by_dir.where(~c("has")).select("dir")


@query("example_dirs", f"SELECT category AS dir, count(*) AS files FROM {_EXAMPLE_CAT} t GROUP BY 1")
def example_dirs(spark, sf_dir):
    return example_categories(spark, sf_dir).groupBy(text.category_dir_name(c("category")).alias("dir")).agg(n().alias("files"))


@query("examples_by_language", "SELECT fqn, language, count(*) AS n, string_agg(name, '|' ORDER BY ord) AS names FROM [example_refs] r GROUP BY 1, 2")
def examples_by_language(spark, sf_dir):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda e: e["name"])
    return base(spark, sf_dir, "example_refs").groupBy("fqn", "language").agg(n().alias("n"), F.array_join(listed, "|").alias("names"))


# --- rendered pages
_HEAD = "'assembly: ' || assembly || chr(10) || 'namespace: ' || namespace || chr(10) || CASE WHEN category IS NOT NULL THEN 'category: ' || category || chr(10) ELSE '' END"
_SEE = "regexp_replace({x}, '<see cref=\"[^\"]+\">([^<]+)</see>', '[[\\1]]', 'g')"
_NL = "chr(10)"


@query(
    "render_member_md",
    f"""SELECT e.ord, '---' || {_NL} || 'type: ' || type_name || {_NL} || 'member: ' || member || {_NL} || 'kind: ' || kind || {_NL} || {_HEAD} || '---' || {_NL} || {_NL} || '# ' || type_name || '.' || member || {_NL}
        || CASE WHEN e.description <> '' THEN {_NL} || e.description || {_NL} ELSE '' END || CASE WHEN signature <> '' THEN {_NL} || '**Signature**: `' || signature || '`' || {_NL} ELSE '' END
        || CASE WHEN returns <> '' THEN {_NL} || '## Returns' || {_NL} || {_NL} || returns || {_NL} ELSE '' END
        || CASE WHEN e.remarks <> '' THEN {_NL} || '## Remarks' || {_NL} || {_NL} || {_SEE.format(x='e.remarks')} || {_NL} ELSE '' END AS page
        FROM {_ENRICHED} e JOIN {_CATEGORISED} t USING (fqn)""",
)
def render_member_md(spark, sf_dir):
    types = categorised(spark, sf_dir).select("fqn", "type_name", "assembly", "namespace", "category")
    none = F.array().cast("array<struct<name:string,description:string>>")
    page = render.member_page(c("kind"), c("type_name"), c("member"), c("assembly"), c("namespace"), c("category"), c("description"), c("signature"), none, c("returns"), c("remarks"))
    return enrich_members(spark, sf_dir).join(types, "fqn").select("ord", page.alias("page"))


@query(
    "render_enum_md",
    f"""SELECT e.ord, '---' || {_NL} || 'type: ' || e.type_name || {_NL} || 'member: ' || enum_member || {_NL} || 'kind: enum_member' || {_NL} || 'assembly: ' || e.assembly || {_NL} || 'namespace: ' || e.namespace || {_NL} || '---' || {_NL} || {_NL}
        || '# ' || e.type_name || '.' || enum_member || {_NL} || CASE WHEN description <> '' THEN {_NL} || description || {_NL} ELSE '' END AS page FROM [enums] e""",
)
def render_enum_md(spark, sf_dir):
    page = render.enum_page(c("type_name"), c("enum_member"), c("assembly"), c("namespace"), F.lit(None).cast("string"), c("description"))
    return base(spark, sf_dir, "enums").select("ord", page.alias("page"))


@query(
    "render_overview_md",
    f"""SELECT fqn, '---' || {_NL} || 'name: ' || type_name || {_NL} || {_HEAD} || 'is_enum: ' || CASE WHEN n_enum_members > 0 THEN 'True' ELSE 'False' END || {_NL} || 'property_count: ' || CAST(n_properties AS STRING) || {_NL}
        || 'method_count: ' || CAST(n_methods AS STRING) || {_NL} || 'enum_member_count: ' || CAST(n_enum_members AS STRING) || {_NL} || '---' || {_NL} || {_NL} || '# ' || type_name || {_NL} || {_NL} || '**Assembly**: ' || assembly || '  ' || {_NL}
        || '**Namespace**: ' || namespace || {_NL} || CASE WHEN category IS NOT NULL THEN '  ' || {_NL} || '**Category**: ' || category || {_NL} ELSE '' END || {_NL} || {_NL}
        || CASE WHEN description <> '' THEN '## Description' || {_NL} || {_NL} || description || {_NL} || {_NL} ELSE '' END || CASE WHEN remarks <> '' THEN '## Remarks' || {_NL} || {_NL} || remarks || {_NL} || {_NL} ELSE '' END
        || '## Members' || {_NL} || CASE WHEN n_properties > 0 THEN {_NL} || '- **Properties**: ' || CAST(n_properties AS STRING) || {_NL} ELSE '' END || CASE WHEN n_methods > 0 THEN {_NL} || '- **Methods**: ' || CAST(n_methods AS STRING) || {_NL} ELSE '' END
        || CASE WHEN n_enum_members > 0 THEN {_NL} || '- **Enumeration Members**: ' || CAST(n_enum_members AS STRING) || {_NL} ELSE '' END AS page FROM {_FULL} t""",
)
def render_overview_md(spark, sf_dir):
    page = render.overview_page(*[c(x) for x in ("type_name", "assembly", "namespace", "category", "description", "remarks", "n_properties", "n_methods", "n_enum_members")])
    return full_types(spark, sf_dir).select("fqn", page.alias("page"))


_ITEM = f"'### ' || member || {_NL} || CASE WHEN description <> '' THEN {_NL} || description || {_NL} ELSE '' END || CASE WHEN signature <> '' THEN {_NL} || '**Signature**: `' || signature || '`' || {_NL} ELSE '' END"


@query(
    "render_type_md",
    f"""WITH x AS (SELECT fqn, string_agg({_ITEM}, {_NL} ORDER BY ord) FILTER (WHERE kind = 'property') AS p, string_agg({_ITEM}, {_NL} ORDER BY ord) FILTER (WHERE kind = 'method') AS m FROM {_ENRICHED} e GROUP BY fqn)
        SELECT fqn, '# ' || type_name || {_NL} || {_NL} || '**Assembly**: ' || assembly || '  ' || {_NL} || '**Namespace**: ' || namespace || {_NL} || CASE WHEN category IS NOT NULL THEN {_NL} || '**Category**: ' || category || {_NL} ELSE '' END
        || CASE WHEN description <> '' THEN {_NL} || '## Description' || {_NL} || {_NL} || description || {_NL} ELSE '' END || CASE WHEN remarks <> '' THEN {_NL} || '## Remarks' || {_NL} || {_NL} || remarks || {_NL} ELSE '' END
        || CASE WHEN p IS NOT NULL THEN {_NL} || '## Properties' || {_NL} || {_NL} || p ELSE '' END || CASE WHEN m IS NOT NULL THEN {_NL} || '## Methods' || {_NL} || {_NL} || m ELSE '' END AS page
        FROM {_CATEGORISED} t JOIN x USING (fqn)""",
)
def render_type_md(spark, sf_dir):
    nested = enrich_members(spark, sf_dir).groupBy("fqn").agg(F.array_sort(F.collect_list(F.struct("ord", "kind", c("member").alias("name"), "description", "signature"))).alias("members"))
    page = render.type_page(*[c(x) for x in ("type_name", "assembly", "namespace", "category", "description", "remarks", "members")])
    return categorised(spark, sf_dir).join(nested, "fqn").select("fqn", page.alias("page"))


_TITLE = "string_split(content, chr(10))[1]"
_ABOUT = "array_to_string(list_filter(list_transform(string_split(split_part(content, '<code>', 1), chr(10))[2:], lambda x: trim(x)), lambda x: x <> ''), chr(10))"
_TAG = f"CASE WHEN contains({_CODE}, 'using System') OR contains({_CODE}, 'namespace ') THEN 'csharp' WHEN contains({_CODE}, 'Dim ') AND contains({_CODE}, 'As ') THEN 'vba' WHEN contains({_CODE}, '#include') THEN 'cpp' ELSE 'text' END"


@query(
    "render_example_md",
    f"""SELECT ord, '# ' || {_TITLE} || {_NL} || {_NL} || '**Source**: `' || url || '`' || {_NL} || CASE WHEN {_ABOUT} <> '' THEN {_NL} || '## Description' || {_NL} || {_NL} || {_ABOUT} || {_NL} ELSE '' END
        || CASE WHEN {_CODE} <> '' THEN {_NL} || '## Code' || {_NL} || {_NL} || '```' || {_TAG} || {_NL} || {_CODE} || {_NL} || '```' || {_NL} ELSE '' END AS page FROM [examples] e""",
)
def render_example_md(spark, sf_dir):
    parts = base(spark, sf_dir, "examples").select("ord", "url", text.example_title(c("content")).alias("title"), text.example_description(c("content")).alias("about"), text.first_code(c("content")).alias("code"))
    page = render.example_page(c("title"), c("url"), c("about"), c("code"), text.fence_tag(names.detect_language(c("url"), c("code"))))
    return parts.select("ord", page.alias("page"))


_ESC = "replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
# Remarks with a reference are fragments; the others have stray signs.
_XML_REMARKS = f"CASE WHEN contains(remarks, '<see cref') THEN remarks ELSE {_ESC.format(x='remarks')} END"


@query(
    "xmldoc_members",
    f"""SELECT ord, '<member name="' || CASE WHEN kind = 'property' THEN 'P:' ELSE 'M:' END || fqn || '.' || member || '"><summary>'
        || CASE WHEN description <> '' THEN description WHEN kind = 'property' THEN 'Gets or sets ' || member || '.' ELSE member || ' method.' END || '</summary>'
        || CASE WHEN returns = '' THEN '' WHEN kind = 'property' THEN '<value>' || returns || '</value>' ELSE '<returns>' || returns || '</returns>' END
        || CASE WHEN remarks = '' THEN '' ELSE '<remarks>' || {_NL} || {_XML_REMARKS} || {_NL} || '</remarks>' END || '</member>' AS fragment FROM {_ENRICHED} e""",
)
def xmldoc_members(spark, sf_dir):
    doc_id = F.concat(F.when(c("kind") == "property", "P:").otherwise("M:"), "fqn", F.lit("."), "member")
    none = F.array().cast("array<struct<name:string,description:string>>")
    fragment = render.xml_member(doc_id, c("kind"), c("member"), c("description"), none, c("returns"), c("remarks"))
    return enrich_members(spark, sf_dir).select("ord", fragment.alias("fragment"))
