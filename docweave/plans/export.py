"""Queries over exports and checks: whole files by path, and validators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import render, urls
from docweave.operators import checks, export, merge, toc
from docweave.operators.storage import shared_folder
from docweave.plans import pages  # noqa: F401  (registers toc_paths)
from docweave.plans.base import base
from docweave.plans.facts import _CATEGORISED, _ENRICHED, _ENTRY, _EXAMPLE_CAT, _FULL, _NL, _XML_REMARKS, c, categorised, enrich_members, example_categories, full_types, n
from docweave.plans.registry import ORACLES, query
from docweave.sources import filetree, readers

_NO_PARAMS = "array<struct<name:string,description:string>>"


def enum_values(spark, sf_dir) -> DataFrame:
    return base(spark, sf_dir, "enums").select("fqn", "ord", c("enum_member").alias("member"), "description")


def api_files(spark, sf_dir) -> DataFrame:
    members = enrich_members(spark, sf_dir).withColumn("params", F.array().cast(_NO_PARAMS))
    return export.api_files(full_types(spark, sf_dir), members, enum_values(spark, sf_dir))


def _saved(column: str) -> str:
    return f"replace(regexp_replace({column}, '[<>:\"/\\\\|?*]', '_', 'g'), ' ', '_')"


def _page_sql(name: str) -> str:
    """The SQL of a rendered page, as registered, without its relation's alias."""
    return f"({ORACLES[name]})"


_FOLDER = f"'api/' || CASE WHEN t.is_enum THEN 'enums' ELSE 'types' END || '/' || {_saved('t.type_name')} || '/'"
_API = f"""(SELECT path, arg_max(content, printf('%s %d %012d', f, r, o)) AS content FROM (
  SELECT {_FOLDER} || '_overview.md' AS path, p.page AS content, t.fqn AS f, 0 AS r, 0 AS o FROM {_FULL} t JOIN {_page_sql('render_overview_md')} p USING (fqn)
  UNION ALL SELECT {_FOLDER} || {_saved('member')} || '.md', p.page, e.fqn, CASE WHEN kind = 'property' THEN 1 ELSE 2 END, e.ord FROM {_ENRICHED} e JOIN {_CATEGORISED} t USING (fqn) JOIN {_page_sql('render_member_md')} p USING (ord)
  UNION ALL SELECT {_FOLDER} || {_saved('enum_member')} || '.md', replace(p.page, 'namespace: ' || x.namespace || chr(10), 'namespace: ' || x.namespace || chr(10) || CASE WHEN category IS NOT NULL THEN 'category: ' || category || chr(10) ELSE '' END), x.fqn, 3, x.ord
    FROM [enums] x JOIN {_CATEGORISED} t USING (fqn) JOIN {_page_sql('render_enum_md')} p USING (ord)
) GROUP BY path)"""


@query("export_api_tree", f"SELECT path, md5(content) AS content_md5 FROM {_API} a")
def export_api_tree(spark, sf_dir):
    """Every file below api/, the last of each path."""
    return export.last_of_path(api_files(spark, sf_dir)).select("path", F.md5("content").alias("content_md5"))


_EXAMPLE_PATH = "'docs/examples/' || regexp_replace(coalesce(category, 'Other'), '[<>:\"/\\\\|?*]', '_', 'g') || '/' || regexp_replace(string_split(url, '/')[-1], '\\.(htm|html)$', '.md')"
_EXAMPLES = f"(SELECT {_EXAMPLE_PATH} AS path, arg_max(p.page, ord) AS content FROM [examples] e LEFT JOIN {_EXAMPLE_CAT} k USING (url) JOIN {_page_sql('render_example_md')} p USING (ord) GROUP BY 1)"


def example_files(spark, sf_dir) -> DataFrame:
    return export.example_files(base(spark, sf_dir, "examples"), example_categories(spark, sf_dir))


@query("export_example_tree", f"SELECT path, md5(content) AS content_md5 FROM {_EXAMPLES} x")
def export_example_tree(spark, sf_dir):
    return export.last_of_path(example_files(spark, sf_dir)).select("path", F.md5("content").alias("content_md5"))


_GUIDE = ORACLES["toc_paths"].replace("SELECT id, CASE", "SELECT url, CASE")


def guide_files(spark, sf_dir) -> DataFrame:
    nodes = base(spark, sf_dir, "toc")
    pages = nodes.where("is_leaf").select("url", F.concat(F.lit("# "), "name", F.lit("\n")).alias("markdown"))
    return export.guide_files(toc.toc_walk(nodes), pages)


@query("export_guide_tree", f"SELECT path, '# ' || name || chr(10) AS content FROM ({_GUIDE}) g JOIN [toc] t USING (url)")
def export_guide_tree(spark, sf_dir):
    return guide_files(spark, sf_dir).select("path", "content")


@query("export_type_pages", f"SELECT 'types/' || {_saved('type_name')} || '.md' AS path, arg_max(md5(page), fqn) AS content_md5 FROM ({ORACLES['render_type_md']}) p JOIN {_CATEGORISED} t USING (fqn) GROUP BY 1")
def export_type_pages(spark, sf_dir):
    """One file a type with members."""
    members = enrich_members(spark, sf_dir)
    types = categorised(spark, sf_dir).join(members.select("fqn").distinct(), "fqn")
    return export.last_of_path(export.type_files(types, members)).select("path", F.md5("content").alias("content_md5"))


@query("stats_file", """SELECT 'crawl_stats.json' AS path, CAST(count(*) AS STRING) AS total, CAST(count(*) FILTER (WHERE error IS NULL) AS STRING) AS successful FROM [crawl_log] l""")
def stats_file(spark, sf_dir):
    """The statistics of a crawl as a JSON file, and read back from it."""
    log = base(spark, sf_dir, "crawl_log")
    file = export.json_file(log.agg(n().alias("total"), F.count_if(c("error").isNull()).alias("successful")), "crawl_stats.json")
    return file.select("path", F.get_json_object("content", "$.total").alias("total"), F.get_json_object("content", "$.successful").alias("successful"))


# --- XML docs
_XML_PROSE = "CASE WHEN {x} <> '' THEN '<{t}>' || {b} || {x} || {b} || '</{t}>' ELSE '' END"
_TYPE_XML = "'<member name=\"T:' || fqn || '\">' || " + _XML_PROSE.format(x="description", t="summary", b="''") + " || " + _XML_PROSE.format(x="remarks", t="remarks", b=_NL) + " || coalesce(x.examples, '') || '</member>'"
_EX_ESC = "replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_EXAMPLE_XML = f"""'<example>' || CASE WHEN contains(content, '<code>') THEN {_EX_ESC.format(x="split_part(content, '<code>', 1)")} || '<code><![CDATA[' || split_part(split_part(content, '<code>', 2), '</code>', 1) || ']]></code>' || {_EX_ESC.format(x="split_part(content, '</code>', 2)")}
  ELSE {_EX_ESC.format(x='content')} END || '</example>'"""
_CS = f"(SELECT r.fqn, string_agg({_EXAMPLE_XML}, '' ORDER BY r.ord) AS examples FROM [example_refs] r JOIN [examples] e ON e.url = regexp_replace(r.url, '^/+', '') WHERE language = 'C#' GROUP BY r.fqn)"
_MEMBER_XML = ORACLES["xmldoc_members"]
_FRAGMENTS = f"""(SELECT assembly, type_name, fqn, 0 AS r, 0 AS o, {_TYPE_XML} AS fragment FROM {_CATEGORISED} t LEFT JOIN {_CS} x USING (fqn)
  UNION ALL SELECT t.assembly, t.type_name, e.fqn, CASE WHEN kind = 'property' THEN 1 ELSE 2 END, e.ord, p.fragment FROM {_ENRICHED} e JOIN {_CATEGORISED} t USING (fqn) JOIN ({_MEMBER_XML}) p USING (ord)
  UNION ALL SELECT t.assembly, t.type_name, x.fqn, 3, x.ord, '<member name="F:' || x.fqn || '.' || enum_member || '"><summary>' || CASE WHEN x.description <> '' THEN x.description ELSE enum_member END || '</summary></member>'
    FROM [enums] x JOIN {_CATEGORISED} t USING (fqn))"""


def xml_fragments(spark, sf_dir) -> DataFrame:
    types = categorised(spark, sf_dir)
    keyed = types.select("fqn", "assembly", "type_name")
    refs = base(spark, sf_dir, "example_refs").where("language = 'C#'").select("ord", "fqn", F.regexp_replace("url", "^/+", "").alias("url"))
    used = merge.example_exact(refs, base(spark, sf_dir, "examples")).where("content is not null")
    examples = used.groupBy("fqn").agg(F.array_sort(F.collect_list(F.struct("ord", "content")))["content"].alias("examples"))

    def row(rank: int | object, at: object, fragment: object) -> list:
        return ["assembly", F.struct("type_name", "fqn", F.lit(rank).alias("r") if isinstance(rank, int) else rank.alias("r"), F.lit(at).cast("long").alias("o") if isinstance(at, int) else at.cast("long").alias("o")).alias("ord"), fragment.alias("fragment")]

    none = F.array().cast(_NO_PARAMS)
    own = types.join(examples, "fqn", "left").withColumn("examples", F.coalesce("examples", F.array().cast("array<string>")))
    of_type = own.select(*row(0, 0, render.xml_type(F.concat(F.lit("T:"), "fqn"), c("description"), c("remarks"), c("examples"))))
    doc_id = F.concat(F.when(c("kind") == "property", "P:").otherwise("M:"), "fqn", F.lit("."), "member")
    member = render.xml_member(doc_id, c("kind"), c("member"), c("description"), none, c("returns"), c("remarks"))
    of_member = enrich_members(spark, sf_dir).join(keyed, "fqn").select(*row(F.when(c("kind") == "property", 1).otherwise(2), c("ord"), member))
    value = render.xml_member(F.concat(F.lit("F:"), "fqn", F.lit("."), "member"), F.lit("field"), c("member"), c("description"), none, F.lit(""), F.lit(""))
    of_value = enum_values(spark, sf_dir).join(keyed, "fqn").select(*row(3, c("ord"), value))
    return of_type.unionAll(of_member).unionAll(of_value)


@query(
    "export_xmldoc_files",
    f"""SELECT assembly || '.xml' AS path, md5('<?xml version="1.0" ?>' || {_NL} || '<doc>' || {_NL} || '  <assembly>' || {_NL} || '    <name>' || assembly || '</name>' || {_NL} || '  </assembly>' || {_NL} || '  <members>' || {_NL}
        || string_agg('    ' || fragment, {_NL} ORDER BY type_name, fqn, r, o) || {_NL} || '  </members>' || {_NL} || '</doc>' || {_NL}) AS content_md5 FROM {_FRAGMENTS} f GROUP BY assembly""",
)
def export_xmldoc_files(spark, sf_dir):
    """One XML-doc file an assembly: types with their C# examples, properties, methods, values."""
    return filetree.digested(export.assembly_doc_parts(xml_fragments(spark, sf_dir))).select("path", "content_md5")


@query("example_exact", "SELECT r.ord, md5(e.content) AS content_md5 FROM [example_refs] r LEFT JOIN [examples] e ON e.url = r.url")
def example_exact(spark, sf_dir):
    """Contents by the URL as it stands; the ones with a leading slash miss."""
    return merge.example_exact(base(spark, sf_dir, "example_refs"), base(spark, sf_dir, "examples")).select("ord", F.md5("content").alias("content_md5"))


# --- indexes
_SHORT = "CASE WHEN length(description) > 100 THEN left(description, 100) || '...' ELSE description END"
_SECTION = f"'## ' || k || {_NL} || {_NL} || '**' || CAST(n AS STRING) || ' types**' || {_NL}"


@query(
    "index_by_category",
    f"""SELECT 'api/index/by_category.md' AS path, '# API Types by Functional Category' || {_NL} || {_NL} || 'This index organizes all API types by their functional categories.' || {_NL} || {_NL} || string_agg(s, {_NL} ORDER BY z, k) AS content FROM (
         SELECT k, z, {_SECTION} || {_NL} || entries || {_NL} AS s FROM (
           SELECT coalesce(category, 'Uncategorized') AS k, category IS NULL AS z, count(*) AS n,
                  string_agg({_ENTRY} || {_NL} || CASE WHEN category IS NOT NULL AND description <> '' THEN ' - ' || {_SHORT} || {_NL} ELSE '' END || CASE WHEN category IS NOT NULL THEN {_NL} ELSE '' END, {_NL} ORDER BY type_name, fqn) AS entries
           FROM {_CATEGORISED} t GROUP BY 1, 2))""",
)
def index_by_category(spark, sf_dir):
    return filetree.gathered(export.category_index_parts(categorised(spark, sf_dir)))


@query(
    "index_by_assembly",
    f"""SELECT 'api/index/by_assembly.md' AS path, '# API Types by Assembly' || {_NL} || {_NL} || 'This index organizes all API types by their .NET assembly.' || {_NL} || {_NL} || string_agg(s, {_NL} ORDER BY k) AS content FROM (
         SELECT k, {_SECTION} || {_NL} || '- **Regular Types**: ' || CAST(n - e AS STRING) || {_NL} || {_NL} || '- **Enumerations**: ' || CAST(e AS STRING) || {_NL} || {_NL} || {_NL} || entries || {_NL} AS s FROM (
           SELECT assembly AS k, count(*) AS n, count(*) FILTER (WHERE is_enum) AS e,
                  string_agg({_ENTRY} || CASE WHEN is_enum THEN ' (enum)' ELSE ' (' || CAST(n_properties AS STRING) || ' props, ' || CAST(n_methods AS STRING) || ' methods)' END || {_NL}, {_NL} ORDER BY type_name, fqn) AS entries
           FROM {_FULL} t GROUP BY 1))""",
)
def index_by_assembly(spark, sf_dir):
    return filetree.gathered(export.assembly_index_parts(full_types(spark, sf_dir)))


def _item(label: str, value: str, mark: str = "- **{}**: ") -> str:
    return f"'{mark.format(label)}' || CAST({value} AS STRING) || {_NL} || {_NL}"


_ALL_ITEMS = " || ".join(
    [
        _item("Total Types", "n"), _item("Regular Types (Interfaces/Classes)", "n - e", "  - {}: "), _item("Enumerations", "e", "  - {}: "), _item("Total Properties", "p"), _item("Total Methods", "m"),
        _item("Total Enumeration Members", "v"), _NL,
    ]
)


@query(
    "index_statistics",
    f"""WITH t AS (SELECT * FROM {_FULL} x),
        a AS (SELECT count(*) AS n, count(*) FILTER (WHERE is_enum) AS e, CAST(sum(n_properties) AS BIGINT) AS p, CAST(sum(n_methods) AS BIGINT) AS m, CAST(sum(n_enum_members) AS BIGINT) AS v FROM t),
        l AS (SELECT string_agg('| [' || type_name || '](../types/' || type_name || '/_overview.md) | ' || CAST(n_properties AS STRING) || ' | ' || CAST(n_methods AS STRING) || ' | ' || CAST(n_properties + n_methods AS STRING) || ' |' || {_NL} || {_NL}, '' ORDER BY n_properties + n_methods DESC, fqn) AS rows
              FROM (SELECT * FROM t WHERE NOT is_enum ORDER BY n_properties + n_methods DESC, fqn LIMIT 20)),
        k AS (SELECT string_agg('| ' || category || ' | ' || CAST(n AS STRING) || ' |' || {_NL} || {_NL}, '' ORDER BY n DESC, category) AS rows FROM (SELECT category, count(*) AS n FROM t WHERE category IS NOT NULL GROUP BY 1))
        SELECT 'api/index/statistics.md' AS path, '# API Documentation Statistics' || {_NL} || {_NL} || '## Overview' || {_NL} || {_NL} || {_ALL_ITEMS} || '## Largest Types by Member Count' || {_NL} || {_NL}
          || '| Type | Properties | Methods | Total |' || {_NL} || {_NL} || '|------|-----------|---------|-------|' || {_NL} || {_NL} || coalesce(l.rows, '') || {_NL} || {_NL} || '## Functional Categories by Type Count' || {_NL} || {_NL}
          || '| Category | Type Count |' || {_NL} || {_NL} || '|----------|------------|' || {_NL} || {_NL} || coalesce(k.rows, '') || {_NL} AS content FROM a, l, k""",
)
def index_statistics(spark, sf_dir):
    return export.statistics_page(full_types(spark, sf_dir))


def _stats_sql(files: str) -> str:
    """The README's line of numbers, over the types and the number of files."""
    count = lambda n: f"format('{{:,}}', {n})"
    return f"""'**Stats**: ' || {count('count(*) FILTER (WHERE NOT is_enum)')} || ' types, ' || {count('count(*) FILTER (WHERE is_enum)')} || ' enums, '
        || {count('CAST(coalesce(sum(n_properties + n_methods) FILTER (WHERE NOT is_enum), 0) AS BIGINT)')} || ' members, ' || {count('(SELECT count(*) FROM [examples] e)')} || ' examples (' || {count(files)} || ' files)'"""


@query("export_readme", f"SELECT 'README.md' AS path, {_stats_sql(f'(SELECT count(*) FROM {_EXAMPLES} x)')} AS stats FROM {_FULL} t")
def export_readme(spark, sf_dir):
    """The README's line of numbers; the rest is fixed text."""
    files = export.last_of_path(example_files(spark, sf_dir))
    page = export.readme_file(full_types(spark, sf_dir), base(spark, sf_dir, "examples"), files, "Reference")
    return page.select("path", F.get(F.split("content", "\n"), F.lit(2)).alias("stats"))


_TITLE = "Reference"
_EXPORTED = f"""(SELECT path, content FROM {_API} a UNION ALL SELECT path, content FROM {_EXAMPLES} x
  UNION ALL SELECT 'docs/' || path, '# ' || name || chr(10) FROM ({_GUIDE}) g JOIN [toc] t USING (url)
  UNION ALL SELECT path, content FROM ({ORACLES['index_by_category']}) c UNION ALL SELECT path, content FROM ({ORACLES['index_by_assembly']}) b UNION ALL SELECT path, content FROM ({ORACLES['index_statistics']}) s)"""
_WHOLE = f"""(SELECT path, content FROM {_EXPORTED} e
  UNION ALL SELECT 'README.md', '# {_TITLE}' || {_NL} || {_NL} || {_stats_sql(f'(SELECT count(*) FROM {_EXPORTED} x)')} || {_NL} || '{export.README}' FROM {_FULL} t)"""


def whole_export(spark, sf_dir) -> export.Export:
    members = enrich_members(spark, sf_dir).withColumn("params", F.array().cast(_NO_PARAMS))
    return export.Export(full_types(spark, sf_dir), members, enum_values(spark, sf_dir), base(spark, sf_dir, "examples"), example_categories(spark, sf_dir), guide_files(spark, sf_dir), _TITLE)


@query("export_whole_tree", f"""SELECT split_part(path, '/', 1) AS top, count(*) AS files, CAST(sum(strlen(content)) AS BIGINT) AS bytes,
  CAST(sum(CAST('0x' || substr(md5(path || ' ' || md5(content)), 1, 8) AS BIGINT)) AS BIGINT) AS digest FROM {_WHOLE} w GROUP BY 1""")
def export_whole_tree(spark, sf_dir):
    """An export with all its parts, by top directory: files, bytes, and a sum over paths and contents."""
    mark = F.conv(F.substring(F.md5(F.concat("path", F.lit(" "), "content_md5")), 1, 8), 16, 10).cast("long")
    listing = whole_export(spark, sf_dir).listing()
    return listing.groupBy(F.split_part("path", F.lit("/"), F.lit(1)).alias("top")).agg(n().alias("files"), F.sum("n_bytes").alias("bytes"), F.sum(mark).alias("digest"))


# --- links in pages
@query(
    "rewrite_links",
    """SELECT 'guide/a/p' || CAST(s_suppkey AS STRING) || '.md' AS path,
         'See [one](' || CASE WHEN s_suppkey % 3 = 0 THEN 'https://www.example.org/x' ELSE '../b/p' || CAST(s_suppkey AS STRING) || '.md' END || ') and [none](none.htm), [two](../b/p'
           || CAST(s_suppkey AS STRING) || '.md) [#](#top)' AS content, CAST(CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 2 END AS BIGINT) AS rewritten FROM supplier""",
)
def rewrite_links(spark, sf_dir):
    """Pages whose links lead to other pages by path, with .htm for .html, to other sites, or nowhere."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(c("s_suppkey").cast("string").alias("s"), (c("s_suppkey") % 3 == 0).alias("out"))
    first = F.when(c("out"), "https://www.example.org/x").otherwise(F.concat(F.lit("../t/"), "s", F.lit(".html?x=1#y")))
    content = F.concat(F.lit("See [one]("), first, F.lit(") and [none](none.htm), [two](/help/api/t/"), "s", F.lit(".htm) [#](#top)"))
    pages = suppliers.select(F.concat(F.lit("guide/a/p"), "s", F.lit(".md")).alias("path"), F.concat(F.lit("https://docs.example.com/help/api/s/"), "s", F.lit(".htm")).alias("base_url"), content.alias("content"))
    targets = suppliers.select(F.concat(F.lit("/help/api/t/"), "s", F.lit(".html")).alias("key"), F.concat(F.lit("guide/b/p"), "s", F.lit(".md")).alias("path"), F.lit(0).alias("ord"))
    return toc.rewritten_pages(pages, targets, urls.is_skipped_link)


@query("html_responses", "SELECT event_id, contains(lower(t), 'text/html') AS html FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'Text/HTML' WHEN 2 THEN 'application/json' ELSE '' END AS t FROM events)")
def html_responses(spark, sf_dir):
    kinds = F.array(F.lit("text/html; charset=utf-8"), F.lit("Text/HTML"), F.lit("application/json"), F.lit(None).cast("string"))
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.get(kinds, (c("event_id") % 4).cast("int")).alias("t"))
    return rows.select("event_id", urls.is_html(c("t")).alias("html"))


# --- checks
@query("files_by_extension", "SELECT 'html' AS extension, count(*) AS n, CAST(sum(b) AS BIGINT) AS bytes FROM (SELECT file_path, max(content_length) AS b FROM [crawl_log] l GROUP BY 1)")
def files_by_extension(spark, sf_dir):
    files = base(spark, sf_dir, "crawl_log").groupBy(c("file_path").alias("path")).agg(F.max("content_length").alias("bytes"))
    return checks.files_by_extension(files)


@query("first_log_rows", "SELECT ord, url, title FROM [crawl_log] l ORDER BY ord LIMIT 5")
def first_log_rows(spark, sf_dir):
    """The five first rows of a log: a summary's sample."""
    return checks.first_rows(base(spark, sf_dir, "crawl_log").select("ord", "url", "title"))


@query("hash_sample", "SELECT url FROM (SELECT DISTINCT url FROM [crawl_log] l) ORDER BY md5(url), url LIMIT 5")
def hash_sample(spark, sf_dir):
    """Five URLs to look at, the same in every run; the checks themselves read all."""
    return checks.hash_sample(base(spark, sf_dir, "crawl_log").select("url").distinct(), "url", 5)


_EXPECTED = ["html/", "html/view/", "html/none/", "metadata/manifest.json"]


@query(
    "existing_paths",
    "SELECT 'exists ' || e AS name, 'error' AS severity, have AS passed, CASE WHEN have THEN '' ELSE 'missing: ' || e END AS detail FROM (SELECT e, EXISTS (SELECT 1 FROM [crawl_log] l WHERE starts_with(file_path, e)) AS have FROM (SELECT unnest(['html/', 'html/view/', 'html/none/', 'metadata/manifest.json']) AS e))",
)
def existing_paths(spark, sf_dir):
    return checks.existing(base(spark, sf_dir, "crawl_log").select(c("file_path").alias("path")), _EXPECTED)


@query(
    "summary_keys",
    """SELECT 'keys of ' || CAST(s_suppkey AS STRING) AS name, 'warning' AS severity, s_suppkey % 3 = 0 AS passed,
         CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'missing keys: statistics' ELSE 'not a JSON object' END AS detail FROM supplier""",
)
def summary_keys(spark, sf_dir):
    whole, part = F.lit('{"statistics": {"n": 1}, "output_location": "x"}'), F.lit('{"output_location": null}')
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    documents = suppliers.select(c("s_suppkey").cast("string").alias("name"), F.when(c("s_suppkey") % 3 == 0, whole).when(c("s_suppkey") % 3 == 1, part).otherwise("{broken").alias("json"))
    return checks.required_keys(documents, ["statistics", "output_location"])


@query("guide_page_count", f"SELECT count(*) AS n FROM ({_GUIDE}) g")
def guide_page_count(spark, sf_dir):
    """Guide pages among the files of an export, examples left out."""
    guide = guide_files(spark, sf_dir).select(F.concat(F.lit("docs/"), "path").alias("path"))
    return checks.guide_pages(guide.unionAll(example_files(spark, sf_dir).select("path"))).agg(n().alias("n"))


@query("toc_inside_boundary", "SELECT 'inside the boundary' AS name, 'error' AS severity, count(*) FILTER (WHERE NOT starts_with(url, '/help/api/')) = 0 AS passed, CAST(count(*) FILTER (WHERE NOT starts_with(url, '/help/api/')) AS STRING) AS detail FROM [toc] t WHERE url <> ''")
def toc_inside_boundary(spark, sf_dir):
    """That a table of contents names pages of the crawl alone."""
    nodes = base(spark, sf_dir, "toc").where("url <> ''").select(urls.joined_url(F.lit(urls.SITE.base + "/"), c("url")).alias("url"))
    outside = F.count_if(~urls.in_boundary(c("url"), urls.SITE.root))
    return checks.check(nodes, "inside the boundary", outside == 0, outside)


@query(
    "boundary_by_branch",
    """SELECT 'inside the boundary: ' || n_name AS name, 'error' AS severity, count(*) FILTER (WHERE s_acctbal < 1000) = 0 AS passed, CAST(count(*) FILTER (WHERE s_acctbal < 1000) AS STRING) AS detail
       FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
)
def boundary_by_branch(spark, sf_dir):
    """The boundary for each branch of a table of contents, some of whose pages are elsewhere."""
    suppliers, nations = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "nation"))
    number = c("s_suppkey").cast("string")
    away = F.when(c("s_acctbal") < 0, F.concat(F.lit("https://www.example.org/help/api/"), number)).when(c("s_acctbal") < 1000, F.concat(F.lit("/help/other/"), number))
    url = urls.joined_url(F.lit(urls.SITE.base + "/help/api/toc.htm"), F.coalesce(away, F.concat(F.lit("guide/"), number, F.lit(".htm"))))
    pages = suppliers.join(nations, c("s_nationkey") == c("n_nationkey")).select("n_name", url.alias("url"))
    outside = F.count_if(~(urls.in_boundary(c("url"), urls.SITE.root) & urls.in_domain(c("url"), urls.SITE.host)))
    return checks.check_each(pages, "n_name", "inside the boundary:", outside == 0, outside)


@query(
    "stats_against_log",
    """SELECT name, 'error' AS severity, stated = counted AS passed, CAST(stated AS STRING) || ' stated, ' || CAST(counted AS STRING) || ' counted' AS detail FROM (
         SELECT unnest(['total', 'successful', 'failed', 'pages']) AS name, unnest([t, s, t - s, u]) AS stated, unnest([t, s, t - s, p]) AS counted FROM (
           SELECT count(*) AS t, count(*) FILTER (WHERE error IS NULL) AS s, count(DISTINCT url) AS u, count(DISTINCT url) FILTER (WHERE error IS NULL) AS p FROM [crawl_log] l))""",
)
def stats_against_log(spark, sf_dir):
    """The statistics file of a crawl, written, read back and held against its log; it counts pages that failed as pages."""
    log, good = base(spark, sf_dir, "crawl_log"), c("error").isNull()
    counts = [n().alias("total"), F.count_if(good).alias("successful"), F.count_if(~good).alias("failed")]
    folder = f"{shared_folder(spark)}/stats-{uuid.uuid4().hex}"
    filetree.write_tree(export.json_file(log.agg(*counts, F.countDistinct("url").alias("pages")), "metadata/crawl_stats.json"), folder)
    stated = readers.read_stats(spark, f"{folder}/metadata/crawl_stats.json", "total bigint, successful bigint, failed bigint, pages bigint, skipped bigint")
    return checks.stated_counts(stated, log.agg(*counts, F.countDistinct(F.when(good, c("url"))).alias("pages")))


@query("log_file_counts", """SELECT count(*) FILTER (WHERE error IS NULL) AS log_rows, count(*) FILTER (WHERE error IS NOT NULL) AS error_rows, count(DISTINCT file_path) FILTER (WHERE error IS NULL) AS files,
  count(*) FILTER (WHERE error IS NULL) = count(DISTINCT file_path) FILTER (WHERE error IS NULL) AS equal_counts FROM [crawl_log] l""")
def log_file_counts(spark, sf_dir):
    """Rows of the log and of the error log against files."""
    good = c("error").isNull()
    counted = base(spark, sf_dir, "crawl_log").agg(F.count_if(good).alias("log_rows"), F.count_if(~good).alias("error_rows"), F.countDistinct(F.when(good, c("file_path"))).cast("long").alias("files"))
    return counted.select("log_rows", "error_rows", "files", (c("log_rows") == c("files")).alias("equal_counts"))


def run_checks(spark, sf_dir, **limits) -> DataFrame:
    log = base(spark, sf_dir, "crawl_log").select("url", "error")
    return checks.crawl_run(log, base(spark, sf_dir, "example_refs").select("url"), boundary=urls.in_boundary(c("url"), urls.SITE.root), **limits)


def _run_sql(least_rows: int, least_percent: int) -> str:
    ok = "count(*) FILTER (WHERE error IS NULL)"
    return f"""SELECT 'rows' AS name, 'error' AS severity, {ok} >= {least_rows} AS passed, CAST({ok} AS STRING) AS detail FROM [crawl_log] l
      UNION ALL SELECT 'success rate', 'error', {ok} * 100 >= count(*) * {least_percent}, CAST(CAST(floor({ok} * 100 / greatest(count(*), 1)) AS BIGINT) AS STRING) FROM [crawl_log] l
      UNION ALL SELECT 'rows have a URL', 'error', count(*) FILTER (WHERE coalesce(url, '') = '') = 0, CAST(count(*) FILTER (WHERE coalesce(url, '') = '') AS STRING) FROM [crawl_log] l
      UNION ALL SELECT 'source URLs', 'error', count(DISTINCT url) > 0, CAST(count(DISTINCT url) AS STRING) FROM [example_refs] r
      UNION ALL SELECT 'inside the boundary', 'error', true, '0'"""


@query("run_guide_crawl", _run_sql(138, 95))
def run_guide_crawl(spark, sf_dir):
    """The guide's run: 138 rows at least."""
    return run_checks(spark, sf_dir)


@query("run_member_crawl", _run_sql(1000, 95))
def run_member_crawl(spark, sf_dir):
    """The members' run: 1,000 rows at least (a test run asks for 100)."""
    return run_checks(spark, sf_dir, least_rows=1000)


@query("run_example_crawl", _run_sql(1100, 90))
def run_example_crawl(spark, sf_dir):
    """The examples' run: 1,100 rows at least, and nine tenths of them good."""
    return run_checks(spark, sf_dir, least_rows=1100, least_percent=90)


_ALL_CHECKS = f"({_run_sql(138, 95)} UNION ALL ({ORACLES['existing_paths']}) UNION ALL ({ORACLES['summary_keys']}))"


def all_checks(spark, sf_dir) -> DataFrame:
    return checks.united([run_guide_crawl(spark, sf_dir), existing_paths(spark, sf_dir), summary_keys(spark, sf_dir)])


@query(
    "validation_verdict",
    f"SELECT bool_and(passed OR severity <> 'error') AS passed, count(*) AS checks, count(*) FILTER (WHERE severity = 'error' AND NOT passed) AS errors, count(*) FILTER (WHERE severity = 'warning' AND NOT passed) AS warnings FROM {_ALL_CHECKS} a",
)
def validation_verdict(spark, sf_dir):
    return checks.verdict(all_checks(spark, sf_dir))


def _failed_sql(severity: str) -> str:
    return f"coalesce(list(name || CASE WHEN detail <> '' THEN ': ' || detail ELSE '' END ORDER BY name || CASE WHEN detail <> '' THEN ': ' || detail ELSE '' END) FILTER (WHERE severity = '{severity}' AND NOT passed), [])"


@query(
    "validation_report",
    f"""SELECT CAST(to_json({{'statistics': {{'checks': count(*), 'passed': count(*) FILTER (WHERE passed)}}, 'errors': {_failed_sql('error')}, 'warnings': {_failed_sql('warning')}}}) AS VARCHAR) AS report FROM {_ALL_CHECKS} a""",
)
def validation_report(spark, sf_dir):
    return checks.report(all_checks(spark, sf_dir))
