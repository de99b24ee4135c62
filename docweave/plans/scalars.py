"""Queries of the scalar expressions and predicates (names, URLs, text, .NET signatures)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import dotnet, names, text, urls
from docweave.functions.urls import SITE
from docweave.operators import quality
from docweave.plans.base import base
from docweave.plans.registry import query

B = "https://docs.example.com"


def scalar(name: str, relation: str, columns: Callable[[], dict[str, Column]], sql: str) -> None:
    """A query that projects expressions over a relation, beside its ord."""

    @query(name, f"SELECT ord, {sql} FROM [{relation}] t")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return base(spark, sf_dir, relation).select("ord", *[c.alias(n) for n, c in columns().items()])


c = F.col
# --- names and kinds of page files
_DOT = "CASE WHEN contains({d}, '.') THEN regexp_replace({d}, '\\.[^.]*$', '') ELSE split_part(file_name, '~', 1) END"


def _identity_sql(dotted: str) -> str:
    has = "contains(file_name, '~')"
    return (
        f"CASE WHEN {has} THEN split_part(file_name, '~', 1) END AS assembly, CASE WHEN {has} THEN {_DOT.format(d=dotted)} END AS namespace, "
        f"CASE WHEN {has} THEN string_split({dotted}, '.')[-1] END AS type_name"
    )


def _identity(value: Callable[[], Column]) -> Callable[[], dict[str, Column]]:
    return lambda: {k: value()[k] for k in ("assembly", "namespace", "type_name")}


_PART = "split_part(file_name, '~', 2)"
scalar(
    "filename_identity", "files", _identity(lambda: names.file_identity(c("file_name"))),
    _identity_sql(f"(CASE WHEN contains({_PART}, '_') THEN split_part({_PART}, '_', 1) ELSE replace({_PART}, '.html', '') END)"),
)
scalar("members_filename_identity", "files", _identity(lambda: names.members_file_identity(c("file_name"))), _identity_sql(f"split_part({_PART}, '_members_', 1)"))
_STEM = "regexp_replace(regexp_replace(file_name, '(\\.(html|htmll|htm))+$', ''), '(_[0-9a-f]{8})+$', '')"
_REST = f"substr({_STEM}, strpos({_STEM}, '~') + 1)"
_ENUM_NS = f"CASE WHEN contains({_REST}, '.') THEN regexp_replace({_REST}, '\\.[^.]*$', '') ELSE split_part({_STEM}, '~', 1) END"
_ENUM_TYPE = f"CASE WHEN contains(file_name, '~') THEN string_split({_REST}, '.')[-1] ELSE {_STEM} END"
scalar(
    "enum_filename_identity", "files", _identity(lambda: names.enum_file_identity(c("file_name"))),
    f"CASE WHEN contains(file_name, '~') THEN split_part({_STEM}, '~', 1) ELSE '' END AS assembly, CASE WHEN contains(file_name, '~') THEN {_ENUM_NS} ELSE '' END AS namespace, {_ENUM_TYPE} AS type_name",
)
scalar("member_name", "files", lambda: {"member": names.member_name(c("file_name"))}, "replace(split_part(file_name, '~', 3), '.html', '') AS member")
_SPECIAL = "(starts_with(lower(file_name), 'functionalcategories') OR starts_with(lower(file_name), 'releasenotes') OR starts_with(lower(file_name), 'help_list'))"
_TILDES = "length(file_name) - length(replace(file_name, '~', ''))"
_NO_LIST = "NOT contains(lower(file_name), '_members_')"
_NO_SPACE = "NOT contains(lower(file_name), '_namespace_')"
scalar("is_type_file", "files", lambda: {"hit": names.is_type_file(c("file_name"))}, f"{_NO_LIST} AND {_NO_SPACE} AND NOT {_SPECIAL} AND contains(lower(file_name), '.html') AND {_TILDES} = 1 AS hit")
scalar("is_member_file", "files", lambda: {"hit": names.is_member_file(c("file_name"))}, f"{_NO_LIST} AND NOT {_SPECIAL} AND contains(lower(file_name), '.html') AND {_TILDES} = 2 AS hit")
scalar("is_enum_file", "files", lambda: {"hit": names.is_enum_file(c("file_name"))}, f"{_NO_LIST} AND {_NO_SPACE} AND NOT {_SPECIAL} AND contains(file_name, '~') AND ends_with({_ENUM_TYPE}, '_e') AS hit")
_LOW = "lower(href)"
scalar(
    "infer_language", "links", lambda: {"language": names.infer_language(c("href"))},
    f"CASE WHEN contains({_LOW}, 'vbnet') OR contains({_LOW}, '_net.htm') THEN 'VB.NET' WHEN contains({_LOW}, '_vb.htm') OR contains({_LOW}, 'vba') THEN 'VBA' WHEN contains({_LOW}, 'csharp') OR contains({_LOW}, '_cs.htm') THEN 'C#' WHEN contains({_LOW}, 'cpp') THEN 'C++' ELSE 'Unknown' END AS language",
)
_CODE = "(CASE WHEN contains(content, '<code>') THEN trim(regexp_extract(content, '<code>(.*?)</code>', 1, 's')) ELSE '' END)"
_DETECT = f"CASE WHEN contains({_CODE}, 'using System') OR contains({_CODE}, 'namespace ') THEN 'C#' WHEN contains({_CODE}, 'Dim ') AND contains({_CODE}, 'As ') THEN 'VBA' WHEN contains({_CODE}, '#include') THEN 'C++' ELSE 'text' END"
scalar("detect_language", "examples", lambda: {"language": names.detect_language(c("url"), text.first_code(c("content")))}, f"{_DETECT} AS language")
_FENCE = "CASE {x} WHEN 'C#' THEN 'csharp' WHEN 'VBA' THEN 'vba' WHEN 'VB.NET' THEN 'vbnet' WHEN 'C++' THEN 'cpp' WHEN 'Python' THEN 'python' ELSE 'text' END"
scalar("fence_tag", "example_refs", lambda: {"fence": text.fence_tag(c("language"))}, _FENCE.format(x="language") + " AS fence")
_LINKED = "text || CASE WHEN ord % 2 = 0 THEN ' (C#) ' ELSE '' END"
scalar(
    "example_link_parse", "links",
    lambda: {k: names.example_link_parts(F.concat("text", F.when(c("ord") % 2 == 0, " (C#) ").otherwise("")), c("href"))[k] for k in ("name", "language")},
    f"text AS name, CASE WHEN ord % 2 = 0 THEN 'C#' WHEN contains({_LOW}, 'vbnet') OR contains({_LOW}, '_net.htm') THEN 'VB.NET' WHEN contains({_LOW}, '_vb.htm') OR contains({_LOW}, 'vba') THEN 'VBA' WHEN contains({_LOW}, 'csharp') OR contains({_LOW}, '_cs.htm') THEN 'C#' WHEN contains({_LOW}, 'cpp') THEN 'C++' ELSE 'Unknown' END AS language",
)
scalar(
    "member_title_parse", "members",
    lambda: {k: names.member_title_parts(F.concat("member", F.when(c("size") % 5 == 0, " Event").when(c("kind") == "method", " Method").otherwise(" Property"), F.lit(" ("), "type_name", F.lit(")")))[k] for k in ("member", "kind", "type_name")},
    "CASE WHEN size % 5 <> 0 THEN member END AS member, CASE WHEN size % 5 = 0 THEN NULL WHEN kind = 'method' THEN 'Method' ELSE 'Property' END AS kind, CASE WHEN size % 5 <> 0 THEN type_name END AS type_name",
)
scalar(
    "type_title_parse", "members",
    lambda: {"name": names.type_title(F.concat("type_name", F.when(c("size") % 3 == 0, " Interface").when(c("size") % 3 == 1, " Class").otherwise(" Enumeration"), F.lit("  ")))},
    "type_name AS name",
)
# --- URLs, links, paths
_ABS = "CASE WHEN starts_with(href, '/') THEN '{b}' || href WHEN starts_with(href, 'http') THEN href ELSE '{b}/' || href END"
scalar("absolute_url", "links", lambda: {"url": urls.absolute_url(c("href"), B)}, _ABS.format(b=B) + " AS url")
_PATH = "regexp_replace(regexp_replace({u}, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '')"
_QUERY = "regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1)"
# Pages of the site with and without queries, from the crawled pages' paths.
_PAGE = "'https://docs.example.com/help/api/' || regexp_replace(url, '^https?://', '') || CASE WHEN page_id % 4 = 0 THEN '/x.htm' WHEN page_id % 4 = 1 THEN '/y.html' ELSE '' END || CASE WHEN page_id % 3 = 0 THEN '?id=' || CAST(page_id AS STRING) ELSE '' END"


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select(c("page_id").alias("ord"), F.regexp_replace("url", r"[?#].*$", "").alias("url"), "page_id").select("ord", F.expr(_PAGE).alias("url"))


_PAGES = f"(SELECT page_id AS ord, {_PAGE} AS url FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages))"
_STRIPPED = f"regexp_replace({_PATH.format(u='url')}, '^/+|/+$', '', 'g')"
_BELOW = f"(CASE WHEN starts_with({_STRIPPED}, 'help/api/') THEN substr({_STRIPPED}, 10) ELSE {_STRIPPED} END)"
_MARK = f"'_' || substr(md5({_QUERY.format(u='url')}), 1, 8) || '.html'"
_TWICE = f"(CASE WHEN {_QUERY.format(u='url')} <> '' THEN replace(replace({_BELOW}, '.htm', {_MARK}), '.html', {_MARK}) ELSE {_BELOW} END)"
_SAVED = f"regexp_replace(CASE WHEN ends_with({_TWICE}, '.html') THEN {_TWICE} ELSE {_TWICE} || '.html' END, '[<>:\"|?*]', '_', 'g')"


@query("url_to_path", f"SELECT ord, {_SAVED} AS path FROM {_PAGES}")
def url_to_path(spark, sf_dir):
    return page_urls(spark, sf_dir).select("ord", urls.page_file_path(c("url")).alias("path"))


@query("url_to_path_members", f"SELECT ord, {_SAVED} AS path FROM {_PAGES}")
def url_to_path_members(spark, sf_dir):
    return page_urls(spark, sf_dir).select("ord", urls.page_file_path(c("url"), toc=False).alias("path"))


_EXT = f"regexp_matches({_BELOW}, '\\.html?$')"


@query(
    "url_to_path_examples",
    f"SELECT ord, regexp_replace(CASE WHEN {_QUERY.format(u='url')} <> '' THEN regexp_replace({_BELOW}, '\\.html?$', '') || {_MARK} WHEN {_EXT} THEN {_BELOW} ELSE {_BELOW} || '.html' END, '[<>:\"|?*]', '_', 'g') AS path FROM {_PAGES}",
)
def url_to_path_examples(spark, sf_dir):
    return page_urls(spark, sf_dir).select("ord", urls.example_file_path(c("url")).alias("path"))


@query("url_boundary", f"SELECT ord, starts_with({_PATH.format(u='url')}, '/help/api/') AS inside FROM {_PAGES}")
def url_boundary(spark, sf_dir):
    return page_urls(spark, sf_dir).select("ord", urls.in_boundary(c("url"), SITE.root).alias("inside"))


@query("allowed_domain", "SELECT page_id, regexp_extract(url, '^https?://([^/?#:]*)', 1) = 'example.com' OR ends_with(regexp_extract(url, '^https?://([^/?#:]*)', 1), '.example.com') AS allowed FROM pages")
def allowed_domain(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", urls.in_domain(c("url"), "example.com").alias("allowed"))


@query("toc_expand_url", f"SELECT ord, CASE WHEN {_QUERY.format(u='url')} <> '' THEN '{B}/expandToc?version=1&queryParam=?id=' || regexp_extract({_QUERY.format(u='url')}, '(?:^|&)id=([^&]+)', 1) END AS toc_url FROM {_PAGES}")
def toc_expand_url(spark, sf_dir):
    return page_urls(spark, sf_dir).select("ord", urls.toc_expand_url(c("url"), B).alias("toc_url"))


_FILE = "replace(replace(string_split(href, '/')[-1], '.html', ''), '.htm', '')"
scalar(
    "href_to_cref", "links", lambda: {"cref": urls.href_to_cref(c("href"))},
    f"CASE WHEN contains({_FILE}, '~') THEN replace(substr({_FILE}, strpos({_FILE}, '~') + 1), '~', '.') WHEN contains({_FILE}, '.') AND NOT contains(href, '/') AND NOT contains(href, '..') THEN {_FILE} END AS cref",
)
scalar(
    "href_to_url", "links", lambda: {"url": urls.href_to_url(c("href"))},
    f"CASE WHEN regexp_matches(href, '^https?://') THEN href WHEN starts_with(href, '../') THEN '{B}/help/api/' || substr(href, 4) ELSE '{B}/help/api/reference/' || href END AS url",
)
scalar("example_filename", "example_refs", lambda: {"file": urls.example_file_name(c("url"))}, "regexp_replace(string_split(url, '/')[-1], '\\.(htm|html)$', '.md') AS file")
scalar(
    "example_link", "example_refs", lambda: {"link": urls.example_link(c("url"), F.when(c("ord") % 2 == 0, c("name")))},
    "'../../../docs/examples/' || CASE WHEN ord % 2 = 0 THEN regexp_replace(name, '[<>:\"/\\\\|?*]', '_', 'g') ELSE 'Other' END || '/' || regexp_replace(string_split(url, '/')[-1], '\\.(htm|html)$', '.md') AS link",
)
scalar("href_type", "links", lambda: {"type_name": urls.href_type(c("href"))}, "nullif(split_part(replace(string_split(href, '/')[-1], '.html', ''), '~', 2), '') AS type_name")
scalar("is_example_link", "links", lambda: {"hit": urls.is_example_link(c("href"))}, "contains(href, 'Example') AND ends_with(href, '.htm') AND NOT starts_with(href, '#') AS hit")
scalar(
    "skip_link", "links", lambda: {"skip": urls.is_skipped_link(c("href"))},
    "(regexp_matches(href, '^https?://') AND NOT contains(href, 'docs.example.com')) OR contains(href, '/reference/') OR starts_with(href, '#') OR starts_with(href, 'mailto:') AS skip",
)
# Paths in a tree of two or three levels: the common part is 0, 1 or 2 directories long.
_SRC = "'a' || CAST(size % 2 AS STRING) || '/b' || CAST(size % 3 AS STRING) || '/' || member || '.md'"
_DST = "'a' || CAST(ord % 2 AS STRING) || '/b' || CAST(ord % 3 AS STRING) || CASE WHEN ord % 5 = 0 THEN '/c' ELSE '' END || '/t.md'"
_TAIL = "CASE WHEN ord % 5 = 0 THEN 'c/' ELSE '' END || 't.md'"
scalar(
    "relative_path", "members", lambda: {"path": urls.relative_path(F.expr(_SRC), F.expr(_DST))},
    f"CASE WHEN size % 2 <> ord % 2 THEN '../../' || {_DST} WHEN size % 3 <> ord % 3 THEN '../b' || CAST(ord % 3 AS STRING) || '/' || {_TAIL} ELSE {_TAIL} END AS path",
)
# --- text
_MESSY = "'<![CDATA[ ' || chr(160) || member || ' <see cref=\"A.B.' || type_name || '\">' || type_name || '</see> and <see cref=\"A.B.C\" />' || chr(9) || ']]>'"
_MESSY_SPARK = "concat('<![CDATA[ ', '\\u00a0', member, ' <see cref=\"A.B.', type_name, '\">', type_name, '</see> and <see cref=\"A.B.C\" />', '\\t', ']]>')"
scalar("clean_text", "members", lambda: {"text": text.clean_text(F.expr(_MESSY_SPARK))}, "member || ' <see cref=\"A.B.' || type_name || '\">' || type_name || '</see> and <see cref=\"A.B.C\" />' AS text")
scalar("simplify_see", "members", lambda: {"text": text.simplify_see(text.clean_text(F.expr(_MESSY_SPARK)))}, "member || ' [[' || type_name || ']] and [[C]]' AS text")
_RAW_NAME = "' .' || replace(file_name, '~', '?') || ':' || CAST(ord AS STRING) || '. '"
scalar("sanitize_guide", "files", lambda: {"name": text.guide_file_name(F.expr(_RAW_NAME))}, f"left(regexp_replace(regexp_replace({_RAW_NAME}, '[<>:\"/\\\\|?*]', '_', 'g'), '^[. ]+|[. ]+$', '', 'g'), 200) AS name")
scalar("sanitize_api", "files", lambda: {"name": text.api_file_name(F.expr(_RAW_NAME))}, f"replace(regexp_replace({_RAW_NAME}, '[<>:\"/\\\\|?*]', '_', 'g'), ' ', '_') AS name")
scalar("sanitize_category", "links", lambda: {"name": text.category_dir_name(c("href"))}, "regexp_replace(href, '[<>:\"/\\\\|?*]', '_', 'g') AS name")
scalar("truncate_desc", "types", lambda: {"short": text.truncate_description(c("description"))}, "CASE WHEN length(description) > 100 THEN left(description, 100) || '...' ELSE description END AS short")
_SPACES = "'^[\\s\\x{85}\\x{a0}]+|[\\s\\x{85}\\x{a0}]+$', '', 'g'"
scalar("first_code", "examples", lambda: {"code": text.first_code(c("content"))}, f"{_CODE} AS code")
_LINES = "list_filter(list_transform(string_split(split_part(content, '<code>', 1), chr(10))[2:], lambda x: trim(x)), lambda x: x <> '')"
scalar(
    "example_parts", "examples", lambda: {"title": text.example_title(c("content")), "description": text.example_description(c("content")), "code": text.first_code(c("content"))},
    f"string_split(content, chr(10))[1] AS title, array_to_string({_LINES}, chr(10)) AS description, {_CODE} AS code",
)


@query(
    "example_segments",
    """SELECT ord, 'text' AS kind, 0::BIGINT AS pos, rtrim(split_part(content, '<code>', 1), chr(10)) AS text FROM [examples] t WHERE contains(content, '<code>')
       UNION ALL SELECT ord, 'code', 1, regexp_extract(content, '<code>(.*?)</code>', 1, 's') FROM [examples] t WHERE contains(content, '<code>')
       UNION ALL SELECT ord, 'text', 2, 'After' FROM [examples] t WHERE contains(content, '<code>')
       UNION ALL SELECT ord, 'text', 0, trim(content, chr(10) || ' ') FROM [examples] t WHERE NOT contains(content, '<code>')""",
)
def example_segments(spark, sf_dir):
    parts = base(spark, sf_dir, "examples").select("ord", F.posexplode(text.example_segments(c("content"))).alias("pos", "p"))
    return parts.select("ord", "p.kind", c("pos").cast("long").alias("pos"), "p.text")


# --- .NET
scalar("signature_clean", "details", lambda: {"signature": dotnet.clean_signature(F.concat(F.lit("System.Collections.List<System.int>   "), F.replace("signature", F.lit(", "), F.lit(",\n  "))))}, "signature AS signature")
_PARAM_LIST = "'System.String' || CASE WHEN size % 3 = 0 THEN '|System.Int32@' ELSE '' END || CASE WHEN size % 7 = 0 THEN '|Acme.List<System.int,X>' ELSE '' END"
scalar("signature_params", "details", lambda: {"params": F.array_join(dotnet.signature_params(c("signature")), "|")}, f"CASE WHEN size % 2 = 1 THEN {_PARAM_LIST} END AS params")
_KINDS = "CASE size % 4 WHEN 0 THEN 'System.int' WHEN 1 THEN 'System.string' WHEN 2 THEN 'Acme.Own' ELSE 'System.bool' END"
_FULL = "CASE size % 4 WHEN 0 THEN 'System.Int32' WHEN 1 THEN 'System.String' WHEN 2 THEN 'Acme.Own' ELSE 'System.Boolean' END"
scalar("dotnet_type", "members", lambda: {"type": dotnet.dotnet_type(F.expr(_KINDS))}, f"{_FULL} AS type")
scalar("param_type", "members", lambda: {"type": dotnet.param_type(F.concat(F.when(c("ord") % 3 == 0, " out ").otherwise(" "), F.expr(_KINDS), F.lit(" value ")))}, f"{_FULL} || CASE WHEN ord % 3 = 0 THEN '@' ELSE '' END AS type")
_BARE = "CASE size % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'string' WHEN 2 THEN 'Acme.Own' ELSE 'bool' END"
scalar(
    "encode_param_type", "members",
    lambda: {"type": dotnet.encoded_param_type(F.concat(F.when(c("ord") % 3 == 0, "ref ").otherwise(""), F.expr(_BARE), F.when(c("ord") % 5 == 0, "*").otherwise(""), F.when(c("ord") % 2 == 0, "[]").when(c("ord") % 7 == 0, "[,]").otherwise("")))},
    f"{_FULL} || CASE WHEN ord % 5 = 0 THEN '*' ELSE '' END || CASE WHEN ord % 2 = 0 THEN '[]' WHEN ord % 7 = 0 THEN '[,]' ELSE '' END || CASE WHEN ord % 3 = 0 THEN '@' ELSE '' END AS type",
)


@query("doc_ids", f"SELECT d.ord, CASE WHEN size % 2 = 0 THEN 'P:' || fqn || '.' || member ELSE 'M:' || fqn || '.' || member || '(' || replace({_PARAM_LIST}, '|', ',') || ')' END AS doc_id, 'T:' || fqn AS type_id FROM [details] d")
def doc_ids(spark, sf_dir):
    namespace, type_name = F.regexp_replace("fqn", r"\.[^.]*$", ""), F.substring_index("fqn", ".", -1)
    params = dotnet.signature_params(c("signature"))
    own = F.when(c("size") % 2 == 0, dotnet.doc_id("P", namespace, type_name, c("member"), params)).otherwise(dotnet.doc_id("M", namespace, type_name, c("member"), params))
    return base(spark, sf_dir, "details").select("ord", own.alias("doc_id"), dotnet.doc_id("T", namespace, type_name).alias("type_id"))


# --- predicates over merged facts
scalar("member_kind", "details", lambda: {"kind": F.when(F.coalesce("signature", F.lit("")).contains("("), "method").otherwise("property")}, "CASE WHEN contains(signature, '(') THEN 'method' ELSE 'property' END AS kind")


@query("url_format_issues", "SELECT ord, url FROM [members] m WHERE NOT ends_with(url, '.html')")
def url_format_issues(spark, sf_dir):
    return base(spark, sf_dir, "members").where(~c("url").endswith(".html")).select("ord", "url")


@query("csharp_examples", "SELECT fqn, string_agg(name, '|' ORDER BY ord) AS names FROM [example_refs] r WHERE language = 'C#' GROUP BY fqn")
def csharp_examples(spark, sf_dir):
    refs = base(spark, sf_dir, "example_refs")
    nested = refs.groupBy("fqn").agg(F.array_sort(F.collect_list(F.struct("ord", "name", "language"))).alias("examples"))
    own = F.filter("examples", lambda e: e["language"] == "C#")
    return nested.where(F.size(own) > 0).select("fqn", F.array_join(F.transform(own, lambda e: e["name"]), "|").alias("names"))


_BAD_ID = "CASE size % 5 WHEN 0 THEN 'X:' || fqn WHEN 1 THEN 'T:' || fqn WHEN 2 THEN 'M:' || fqn || '.' WHEN 3 THEN 'P:' || replace(fqn, '.', '..') ELSE 'F:' || fqn || ' x' END"


@query(
    "doc_id_issues",
    f"SELECT doc_id, CASE k WHEN 0 THEN 'prefix' WHEN 4 THEN 'blank' ELSE 'empty part' END AS issue FROM (SELECT {_BAD_ID} AS doc_id, size % 5 AS k FROM [members] m) WHERE k <> 1",
)
def doc_id_issues(spark, sf_dir):
    return quality.doc_id_issues(base(spark, sf_dir, "members").select(F.expr(_BAD_ID).alias("doc_id")))


_MD = "CASE size % 5 WHEN 0 THEN '' WHEN 1 THEN '# ' || member WHEN 2 THEN '---' || chr(10) || 'a: b' || chr(10) || '# ' || member WHEN 3 THEN '---' || chr(10) || 'a: b' || chr(10) || '---' || chr(10) || member ELSE '---' || chr(10) || 'a: b' || chr(10) || '---' || chr(10) || '# ' || member END"
scalar(
    "markdown_issues", "members", lambda: {"issue": quality.markdown_issue(F.expr(_MD))},
    "CASE size % 5 WHEN 0 THEN 'empty' WHEN 1 THEN 'no front matter' WHEN 2 THEN 'front matter not closed' WHEN 3 THEN 'no heading' END AS issue",
)
