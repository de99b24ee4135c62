"""Queries over crawled pages: scans, extraction, links, page parsers on synthetic pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import text, urls
from docweave.operators import guide, quality, toc
from docweave.plans.base import base
from docweave.plans.registry import query
from docweave.sources import html as parsers
from docweave.sources.links import links_to_see
from docweave.sources.tree import category_rows, example_text, to_markdown

c = F.col
B = "https://docs.example.com"


def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def site_links(spark, sf_dir, top: int = 20):
    """Flagship: absolute targets of all links in pages by how many pages link there."""
    href = F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]+)"'), 1))
    found = pages(spark, sf_dir).select("page_id", href.alias("href")).select("page_id", urls.absolute_url(c("href"), B).alias("target"))
    return found.groupBy("target").agg(F.count("*").cast("long").alias("links"), F.countDistinct("page_id").cast("long").alias("pages")).orderBy(F.desc("links"), "target").limit(top)


_HREFS = "(SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]+)\"', 1)) AS href FROM pages)"
query("top_link_targets", f"SELECT CASE WHEN starts_with(href, '/') THEN '{B}' || href WHEN starts_with(href, 'http') THEN href ELSE '{B}/' || href END AS target, count(*) AS links, count(DISTINCT page_id) AS pages FROM {_HREFS} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")(site_links)


@query("page_links", f"SELECT href, count(*) AS n FROM {_HREFS} GROUP BY href")
def page_links(spark, sf_dir):
    href = F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]+)"'), 1))
    return pages(spark, sf_dir).select(href.alias("href")).groupBy("href").agg(F.count("*").cast("long").alias("n"))


@query("scan_pages", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages WHERE html IS NOT NULL")
def scan_pages(spark, sf_dir):
    return pages(spark, sf_dir).where("html is not null").select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query("content_fingerprint", "SELECT page_id, sha256(html) AS content_hash, CAST(strlen(html) AS BIGINT) AS content_length FROM pages")
def content_fingerprint(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", F.sha2("html", 256).alias("content_hash"), F.octet_length("html").cast("long").alias("content_length"))


@query("page_title", "SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '<title>(.*?)</title>', 1)), ''), 'Untitled') AS title FROM pages")
def page_title(spark, sf_dir):
    title = text.utrim(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    return pages(spark, sf_dir).select("page_id", F.coalesce(F.nullif(title, F.lit("")), F.lit("Untitled")).alias("title"))


def next_data(html):
    """Content that a page carries as JSON in its data script; null where it doesn't."""
    script = F.regexp_extract(html, r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    return F.get_json_object(F.nullif(script, F.lit("")), "$.props.pageProps.helpContentData.helpText")


@query("next_data_extract", "SELECT page_id, sha256(html) AS content_hash, page_id % 7 <> 0 AS found FROM pages WHERE page_id % 7 <> 0 UNION ALL SELECT page_id, NULL, false FROM pages WHERE page_id % 7 = 0")
def next_data_extract(spark, sf_dir):
    payload = F.replace(F.to_json(F.struct(F.struct(F.struct(F.struct(c("html").alias("helpText")).alias("helpContentData")).alias("pageProps")).alias("props"))), F.lit("</"), F.lit("<\\/"))
    wrapped = F.when(c("page_id") % 7 != 0, F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), payload, F.lit("</script></html>"))).otherwise("<html></html>")
    found = pages(spark, sf_dir).select("page_id", wrapped.alias("page")).select("page_id", next_data(c("page")).alias("content"))
    return found.select("page_id", F.sha2("content", 256).alias("content_hash"), c("content").isNotNull().alias("found"))


@query(
    "page_issues",
    """SELECT url, CASE WHEN page_id % 3 = 0 THEN 'short content' ELSE 'no html' END AS issue FROM pages WHERE page_id % 3 < 2
       UNION ALL SELECT url, 'no html' FROM pages WHERE page_id % 3 = 0""",
)
def page_issues(spark, sf_dir):
    content = F.when(c("page_id") % 3 == 0, "short").when(c("page_id") % 3 == 1, F.repeat(F.lit("plain words "), F.lit(20))).otherwise(c("html"))
    return quality.page_issues(pages(spark, sf_dir).select("url", content.alias("content")))


# --- parsers on pages made of the corpus relations, against the relations themselves
def _cell(kind, inner):
    return F.concat(F.lit(f'<td class="{kind}">'), inner, F.lit("</td>"))


@query(
    "extract_members",
    """SELECT type_name, kind AS section, CAST(row_number() OVER (PARTITION BY fqn ORDER BY kind DESC, ord) - 1 AS BIGINT) AS ord, member AS name, '/api/' || member || '.html' AS url, fqn
       FROM [members] m""",
)
def extract_members(spark, sf_dir):
    row = F.concat(F.lit("<tr>"), _cell("MembersLinkCell", F.concat(F.lit('<a href="'), "member", F.lit('.html">'), "member", F.lit("</a>"))), _cell("MembersDescriptionCell", F.lit('<a href="x.html">other</a>')), F.lit("</tr>"))
    rows = base(spark, sf_dir, "members").select("fqn", "type_name", "kind", "ord", row.alias("row"))
    listed = lambda k: F.array_join(F.transform(F.filter("rows", lambda r: r["kind"] == k), lambda r: r["row"]), "")
    made = rows.groupBy("fqn").agg(F.max("type_name").alias("type_name"), F.array_sort(F.collect_list(F.struct("ord", "kind", "row"))).alias("rows"))
    page = F.concat(F.lit('<span id="pagetitle">'), "type_name", F.lit(" Interface Members</span><h1>Public Properties</h1><table>"), listed("property"), F.lit("</table><h1>Public Methods</h1><table>"), listed("method"), F.lit("</table><h1>See Also</h1>"))
    out = parsers.page_rows(made.select("fqn", page.alias("html"), F.lit("/api/").alias("prefix")), parsers.parse_members, parsers.MEMBERS_ROW, ["fqn"], prefix="prefix")
    return out.drop("error")


@query("extract_enum_members", "SELECT fqn, type_name, CAST(row_number() OVER (PARTITION BY fqn ORDER BY ord) - 1 AS BIGINT) AS ord, enum_member AS name, description FROM [enums] e")
def extract_enum_members(spark, sf_dir):
    row = F.concat(F.lit("<tr>"), _cell("MemberNameCell", F.concat(F.lit("<strong>"), "enum_member", F.lit("</strong>"))), _cell("DescriptionCell", c("description")), F.lit("</tr>"))
    made = base(spark, sf_dir, "enums").groupBy("fqn").agg(F.max("type_name").alias("t"), F.array_sort(F.collect_list(F.struct("ord", row.alias("row")))).alias("rows"))
    page = F.concat(F.lit('<span id="pagetitle">'), "t", F.lit(' Enumeration</span><h1>Members</h1><table class="FilteredItemListTable"><tr><th>Member</th></tr>'), F.array_join(F.transform("rows", lambda r: r["row"]), ""), F.lit("</table>"))
    return parsers.page_rows(made.select("fqn", page.alias("html")), parsers.parse_enum, parsers.ENUM_ROW, ["fqn"]).drop("error")


@query(
    "extract_type_info",
    """SELECT fqn, type_name AS name, description, CASE WHEN remarks = '' THEN '' ELSE remarks || ' at <see cref="' || fqn || '">' || type_name || '</see>' END AS remarks,
              'Use ' || type_name || '|VBA|/d/' || type_name || '_Example_VB.htm' AS example FROM [types] t""",
)
def extract_type_info(spark, sf_dir):
    remarks = F.when(c("remarks") == "", "").otherwise(F.concat(F.lit("<h1>Remarks</h1><div><p>"), "remarks", F.lit(' at <a href="Asm~'), "fqn", F.lit('.html">'), "type_name", F.lit("</a></p></div>")))
    page = F.concat(
        F.lit('<span id="pagetitle">'), "type_name", F.lit(" Interface</span><p>"), "description", F.lit("</p><h1>.NET Syntax</h1>code<h1>Example</h1>"),
        F.lit('<a href="'), "type_name", F.lit('_Example_VB.htm">Use '), "type_name", F.lit(' (VBA)</a><a href="A~B.html">no</a>'), remarks, F.lit("<h1>See Also</h1>more"),
    )
    made = base(spark, sf_dir, "types").select("fqn", page.alias("html"), F.lit("/d/").alias("prefix"))
    out = parsers.page_rows(made, parsers.parse_type, parsers.TYPE_ROW, ["fqn"], prefix="prefix")
    one = c("examples")[0]
    return out.select("fqn", "name", "description", "remarks", F.concat_ws("|", one["name"], one["language"], one["url"]).alias("example"))


@query(
    "extract_member_details",
    """SELECT ord, member AS name, string_split(fqn, '.')[-1] AS type_name, signature, description, CASE WHEN params = '' THEN '' ELSE 'a=first of ' || member || '|b=second' END AS parameters, returns, remarks
       FROM [details] d""",
)
def extract_member_details(spark, sf_dir):
    params = F.when(c("params") == "", "").otherwise(F.concat(F.lit("<h4>Parameters</h4><dl><dt><i>a</i></dt><dd>first of "), "member", F.lit("</dd><dt>b</dt><dd><p>second</p></dd></dl>")))
    returns = F.when(c("returns") == "", "").otherwise(F.concat(F.lit("<h4>Return Value</h4><div>"), "returns", F.lit("</div>")))
    linked = F.regexp_replace("remarks", r'<see cref="([^"]+)">([^<]+)</see>', '<a href="Asm~$1.html">$2</a>')
    remarks = F.when(c("remarks") == "", "").otherwise(F.concat(F.lit("<h1>Remarks</h1><div>"), linked, F.lit("</div>")))
    code = F.replace(F.replace("signature", F.lit("<"), F.lit("&lt;")), F.lit(", "), F.lit(",\n   "))
    page = F.concat(
        F.lit('<span id="pagetitle">'), "member", F.when(c("size") % 2 == 0, " Property (").otherwise(" Method ("), F.substring_index("fqn", ".", -1), F.lit(")</span><div>"), "description",
        F.lit('</div><h1>.NET Syntax</h1><div id="Syntax_CS"><table class="syntaxtable"><tr><td><pre>System.int '), code, F.lit("</pre></td></tr></table></div>"), params, returns, remarks, F.lit("<h1>See Also</h1>zz"),
    )
    out = parsers.page_rows(base(spark, sf_dir, "details").select("ord", page.alias("html")), parsers.parse_member, parsers.MEMBER_ROW, ["ord"])
    listed = F.array_join(F.transform("parameters", lambda p: F.concat(p["name"], F.lit("="), p["description"])), "|")
    return out.select("ord", "name", "type_name", "signature", "description", listed.alias("parameters"), "returns", "remarks")


_TYPE_OF = "string_split(fqn, '.')[-1]"


def _by_variant(other: str, **then: str) -> str:
    return "CASE ord % 6 " + " ".join(f"WHEN {k[1:]} THEN {v}" for k, v in then.items()) + f" ELSE {other} END"


@query(
    "extract_member_variants",
    f"""SELECT ord, {_by_variant("member", v5="NULL")} AS name, {_by_variant(_TYPE_OF, v5="NULL")} AS type_name, {_by_variant("member || '( int a )'", v4="''", v5="NULL")} AS signature,
         {_by_variant("'About ' || member || ' & more'", v5="NULL")} AS description, {_by_variant("''", v1="'a=|b=second <see cref=\"' || fqn || '\">' || member || '</see>|c=third'", v5="NULL")} AS parameters,
         {_by_variant("''", v3="'a' || CAST(ord AS STRING)", v5="NULL")} AS returns, {_by_variant("''", v2="'Mind ' || member || '.'", v5="NULL")} AS remarks, {_by_variant("NULL", v5="'ValueError: no member title'")} AS error FROM [details] d""",
)
def extract_member_variants(spark, sf_dir):
    """Member pages in other letters, without quotes, with tags left open, comments, scripts, odd lists, and without what a page should have."""
    kind = (c("ord") % 6).cast("int")
    when = lambda n, text: F.when(kind == n, text).otherwise("")
    title = F.concat("member", F.lit(" Method ("), F.substring_index("fqn", ".", -1), F.lit(")"))
    head = F.when(kind == 0, F.concat(F.lit("<SPAN ID=pagetitle>"), title, F.lit("</SPAN>"))).when(kind == 5, "<p>").otherwise(F.concat(F.lit("<script>if (a<b) '<span id=\"pagetitle\">x Method (y)'</script><span id='pagetitle'>"), title, F.lit("</span>")))
    about = F.concat(F.lit("<!-- no --><P>About <B>"), "member", F.lit("</B> &amp; more<BR></P>"))
    code = F.when(kind == 4, "<pre>void no( )</pre>").otherwise(F.concat(F.lit("<h1>.NET Syntax</h1><DIV id=Syntax_CS><table class='x syntaxtable'><tr><td><pre>void  "), "member", F.lit("(\n int a )</pre></td></tr></table></DIV>")))
    listed = F.concat(F.lit("<h4>Parameters</h4><dl><dt>a</dt><dt> b </dt><dd>second <a href='A~"), "fqn", F.lit(".html'>"), "member", F.lit("</a></dd><dt><i>c</i></dt><dd><p>third</p></dd></dl>"))
    remarks = F.concat(F.lit("<h1>Remarks</h1><div><div><p>Mind <i>"), "member", F.lit("</i>.</p></div></div>after"))
    values = F.concat(F.lit("<h4>Property Value</h4><div>a</div><h4>Return Value</h4><p>"), c("ord").cast("string"), F.lit("</p>"))
    page = F.concat(F.lit("<html>"), head, about, F.when(kind == 4, "<h1>Example</h1>").otherwise(""), code, when(1, listed), when(3, values), when(2, remarks), F.lit("<h1>See Also</h1>zz"))
    out = parsers.page_rows(base(spark, sf_dir, "details").select("ord", page.alias("html")), parsers.parse_member, parsers.MEMBER_ROW, ["ord"])
    shown = F.array_join(F.transform("parameters", lambda p: F.concat(p["name"], F.lit("="), p["description"])), "|")
    return out.select("ord", "name", "type_name", "signature", "description", shown.alias("parameters"), "returns", "remarks", "error")


@query(
    "extract_type_variants",
    f"""SELECT ord, type_name AS name, 'Of ' || namespace AS description, '/d/' || CASE ord % 6 WHEN 0 THEN type_name || '_Example_VB.htm' WHEN 1 THEN 'x/' || type_name || '_Example_CSharp.htm' WHEN 2 THEN 'Example_VBNET_' || type_name || '.htm'
           WHEN 3 THEN 'Example_' || type_name || '_CPP.htm' WHEN 4 THEN 'Example' || type_name || '_vb.htm' ELSE type_name || 'Example.htm' END AS url,
         {_by_variant("'Use ' || type_name", v4="'Use (' || type_name || ') (x'")} AS example, CASE ord % 6 WHEN 0 THEN 'any' WHEN 1 THEN 'C#' WHEN 2 THEN 'VB.NET' WHEN 3 THEN 'C++' WHEN 4 THEN 'VBA' ELSE 'Unknown' END AS language
       FROM [members] m""",
)
def extract_type_variants(spark, sf_dir):
    """Type pages of each kind; example links with and without their language, among links that aren't examples."""
    kind, name = (c("ord") % 6).cast("int"), c("type_name")
    href = (
        F.when(kind == 0, F.concat(name, F.lit("_Example_VB.htm"))).when(kind == 1, F.concat(F.lit("x/"), name, F.lit("_Example_CSharp.htm"))).when(kind == 2, F.concat(F.lit("Example_VBNET_"), name, F.lit(".htm")))
        .when(kind == 3, F.concat(F.lit("Example_"), name, F.lit("_CPP.htm"))).when(kind == 4, F.concat(F.lit("Example"), name, F.lit("_vb.htm"))).otherwise(F.concat(name, F.lit("Example.htm")))
    )
    words = F.when(kind == 0, F.concat(F.lit("Use "), name, F.lit(" ( any )"))).when(kind == 4, F.concat(F.lit("Use ("), name, F.lit(") (x"))).otherwise(F.concat(F.lit("Use <b>"), name, F.lit("</b>")))
    shown = F.when(kind % 3 == 0, " Interface").when(kind % 3 == 1, " Class").otherwise(" Enumeration")
    page = F.concat(
        F.lit("<body><span class=a id=pagetitle>"), name, shown, F.lit("</span><div>Of "), "namespace", F.lit("</div><h1>Members</h1><a href='no_Example.htm'>no</a><H1>Examples</H1><ul><li><a href='#Example.htm'>no</a><li><a href='Example.html'>no</a><li><a href=\""),
        href, F.lit("\">"), words, F.lit("</a></ul><h1>Accessors</h1><a href='Example.htm'>no</a>"),
    )
    made = base(spark, sf_dir, "members").select("ord", page.alias("html"), F.lit("/d/").alias("prefix"))
    out = parsers.page_rows(made, parsers.parse_type, parsers.TYPE_ROW, ["ord"], prefix="prefix")
    one = c("examples")[0]
    return out.where(F.size("examples") == 1).select("ord", "name", "description", one["url"].alias("url"), one["name"].alias("example"), one["language"].alias("language"))


@query("extract_categories", "SELECT category, type_fqn AS type_name, count(*) AS n FROM [categories] c GROUP BY 1, 2")
def extract_categories(spark, sf_dir):
    item = F.concat(F.lit('<li><a href="Asm~'), "type_fqn", F.lit('.html">x</a></li>'))
    made = base(spark, sf_dir, "categories").groupBy("category").agg(F.array_join(F.array_sort(F.collect_list(item)), "").alias("items"))
    page = F.concat(F.lit('<div><h4><a name="k">'), "category", F.lit("</a></h4><ul>"), "items", F.lit("</ul></div>"))
    out = parsers.page_rows(made.select(page.alias("html")), lambda html, _: category_rows(html), "ord bigint, category string, type_name string", [])
    return out.groupBy("category", "type_name").agg(F.count("*").cast("long").alias("n"))


@query("parse_example", "SELECT ord, 'Example ' || CAST(ord AS STRING) || chr(10) || 'Prose' || chr(10) || '<code>' || chr(10) || 'Dim a' || chr(10) || '    b = ' || CAST(ord AS STRING) || chr(10) || 'End' || chr(10) || '</code>' || chr(10) || 'After' AS content FROM [examples] e")
def parse_example(spark, sf_dir):
    page = F.concat(F.lit("<h1>Example "), "ord", F.lit('</h1><p>Prose</p><p class="APICODE">Dim  a<br>&nbsp;&nbsp;&nbsp; b   =  '), "ord", F.lit("</p><pre>End</pre><p>After</p>"))
    out = parsers.page_rows(base(spark, sf_dir, "examples").select("ord", page.alias("html")), lambda html, _: [{"content": example_text(html)}], "content string", ["ord"])
    return out.select("ord", "content")


@query("html_to_md")
def html_to_md(spark, sf_dir):
    return parsers.page_rows(pages(spark, sf_dir), lambda html, _: [{"markdown": to_markdown(html)}], "markdown string", ["page_id"]).select("page_id", "markdown")


_MD_PAGE = """'# ' || text || chr(10) || chr(10) || 'About **' || text || '** and [' || text || '](' || href || '), _see_ `x < ' || CAST(ord AS STRING) || '`.' || '  ' || chr(10) || 'Next & last' || chr(10) || chr(10)
  || '* one' || chr(10) || '  1. in ' || text || chr(10) || '* two' || chr(10) || chr(10) || '```' || chr(10) || 'a  b' || chr(10) || '  c' || CAST(ord AS STRING) || chr(10) || '```' || chr(10) || chr(10)
  || '## T' || chr(10) || chr(10) || 'k | ' || text || chr(10) || chr(10) || '![pic](p' || CAST(ord AS STRING) || '.png) open' || chr(10) || chr(10) || '---' || chr(10)"""


@query("page_markdown", f"SELECT ord, {_MD_PAGE} AS markdown FROM [links] l")
def page_markdown(spark, sf_dir):
    """Pages with each kind of element, tags left open and scripts between, as Markdown."""
    n = c("ord").cast("string")
    page = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><script>if (a<b) no()</script><h1> "), "text", F.lit("\n</h1><p>About <b>"), "text", F.lit("</b>\n and <a href='"), "href", F.lit("'>"), "text",
        F.lit("</a>, <i>see</i> <code>x &lt; "), n, F.lit("</code>.<br>Next &amp; last</p><ul><li>one<ol><li>in "), "text", F.lit("</li></ol></li><li>two</li></ul><pre>a  b\n  c"), n,
        F.lit("</pre><h2>T</h2><table><tr><td>k</td><td>"), "text", F.lit('</td></tr></table><!-- no --><p></p><div><img src="p'), n, F.lit('.png" alt=pic> open</div><hr></body>'),
    )
    out = parsers.page_rows(base(spark, sf_dir, "links").select("ord", page.alias("html")), lambda html, _: [{"markdown": to_markdown(html)}], "markdown string", ["ord"])
    return out.select("ord", "markdown")


@query(
    "links_to_see",
    """SELECT ord, 'see ' || CASE WHEN ord % 9 IN (0, 1, 4) THEN '<see cref="' || replace(substr(f, strpos(f, '~') + 1), '~', '.') || '">' || text || '</see>'
         WHEN ord % 9 = 2 THEN '<see cref="' || f || '">' || text || '</see>' WHEN ord % 9 = 3 THEN '<see href="https://docs.example.com/help/api/' || substr(href, 4) || '">' || text || '</see>'
         WHEN ord % 9 = 8 THEN '<see href="https://docs.example.com/help/api/reference/' || href || '">' || text || '</see>' ELSE text END || ' & more' AS html
       FROM (SELECT *, replace(replace(string_split(href, '/')[-1], '.html', ''), '.htm', '') AS f FROM [links] t)""",
)
def see_tags(spark, sf_dir):
    fragment = F.concat(F.lit('<p>see <a class="k" href="'), "href", F.lit('">'), "text", F.lit("</a>&nbsp;&amp; more</p>"))
    out = parsers.page_rows(base(spark, sf_dir, "links").select("ord", fragment.alias("html")), lambda html, _: [{"see": links_to_see(html)}], "see string", ["ord"])
    return out.select("ord", c("see").alias("html"))


@query(
    "url_join",
    """WITH u AS (SELECT page_id, 'https://docs.example.com/help/api/p' || CAST(page_id AS STRING) || '/page.htm?id=' || CAST(page_id AS STRING) AS base FROM pages)
       SELECT page_id, unnest([
         'https://docs.example.com/help/api/a/' || CAST(page_id AS STRING) || '.htm?x=1#y',
         'https://docs.example.com/help/api/p' || CAST(page_id AS STRING) || '/page.htm?q=' || CAST(page_id AS STRING),
         base || '#top', 'https://cdn.example.org/z', 'https://docs.example.com/up.htm', 'https://docs.example.com/help/api/p' || CAST(page_id AS STRING) || '/sub/',
         'https://docs.example.com/root/q.htm', 'mailto:p' || CAST(page_id AS STRING) || '@example.org']) AS target FROM u""",
)
def url_join(spark, sf_dir):
    """Links of every form joined with their page's URL."""
    number = c("page_id").cast("string")
    start = F.concat(F.lit(B + "/help/api/p"), number, F.lit("/page.htm?id="), number)
    forms = [
        F.concat(F.lit("../a/./"), number, F.lit(".htm?x=1#y")), F.concat(F.lit("?q="), number), F.lit("#top"), F.lit("//cdn.example.org/z"),
        F.lit("../../../../up.htm"), F.lit("sub/"), F.lit("/root/x/../q.htm"), F.concat(F.lit("mailto:p"), number, F.lit("@example.org")),
    ]
    made = pages(spark, sf_dir).select("page_id", start.alias("start"), F.explode(F.array(*forms)).alias("href"))
    return made.select("page_id", urls.joined_url(c("start"), c("href")).alias("target"))


# --- tables of contents
_WALK = """WITH RECURSIVE n AS (SELECT *, regexp_replace(regexp_replace(name, '[<>:"/\\\\|?*]', '_', 'g'), '^[. ]+|[. ]+$', '', 'g') AS safe FROM [toc] t),
  w AS (SELECT id, name, url, is_leaf, safe, 0 AS level, '' AS directory, '' AS inner_dir, name AS full_path FROM n WHERE parent_id = '-1'
    UNION ALL SELECT n.id, n.name, n.url, n.is_leaf, n.safe, w.level + 1, w.inner_dir, CASE WHEN n.is_leaf THEN w.inner_dir WHEN w.inner_dir = '' THEN n.safe ELSE w.inner_dir || '/' || n.safe END, w.full_path || ' > ' || n.name
    FROM n JOIN w ON n.parent_id = w.id) """


@query("toc_paths", _WALK + "SELECT id, CASE WHEN directory = '' THEN safe ELSE directory || '/' || safe END || '.md' AS path FROM w WHERE is_leaf AND url <> ''")
def toc_paths(spark, sf_dir):
    walk = toc.toc_walk(base(spark, sf_dir, "toc"), ("directory",)).where("is_leaf and url <> ''")
    return walk.select("id", F.concat(F.when(c("directory") == "", "").otherwise(F.concat("directory", F.lit("/"))), "safe", F.lit(".md")).alias("path"))


@query("toc_full_path", _WALK + "SELECT id, full_path FROM w")
def toc_full_path(spark, sf_dir):
    return toc.toc_walk(base(spark, sf_dir, "toc"), ("full_path",)).select("id", "full_path")


@query("toc_outline", _WALK + "SELECT id, CAST(level AS BIGINT) AS level, repeat('  ', level) || name AS line FROM w")
def toc_outline(spark, sf_dir):
    return toc.toc_walk(base(spark, sf_dir, "toc"), ("level",)).select("id", c("level").cast("long").alias("level"), F.concat(F.repeat(F.lit("  "), c("level")), "name").alias("line"))


@query("toc_leaves", "SELECT id, url FROM [toc] t WHERE is_leaf AND url <> ''")
def toc_leaves(spark, sf_dir):
    return base(spark, sf_dir, "toc").where("is_leaf and url <> ''").select("id", "url")


@query("toc_nodes", "SELECT id, parent_id, name, url, is_leaf FROM [toc] t")
def toc_nodes(spark, sf_dir):
    """Files of one node with its children each, put together again."""
    nodes = base(spark, sf_dir, "toc")
    child = F.struct(c("id"), c("parent_id").alias("parentId"), c("name"), c("url"), c("is_leaf").alias("isLeaf"))
    children = nodes.groupBy(c("parent_id").alias("owner")).agg(F.collect_list(child).alias("children"))
    files = nodes.where("not is_leaf").join(children, c("id") == c("owner")).select("ord", "id", c("parent_id").alias("parentId"), "name", "url", c("is_leaf").alias("isLeaf"), "children")
    return toc.toc_nodes(files)



@query("toc_urls", "SELECT url FROM [toc] t WHERE url <> ''")
def toc_urls(spark, sf_dir):
    """URLs of nested JSON of any depth, walked as variants: one explode a level."""
    from docweave.sources.json_tree import json_urls

    nodes = base(spark, sf_dir, "toc")
    leaf = nodes.where("is_leaf").groupBy(c("parent_id").alias("owner")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct("id", "url"))), ","), F.lit("]")).alias("kids"))
    inner = nodes.join(leaf, c("id") == c("owner")).select(F.concat(F.lit('{"id":"'), "id", F.lit('","children":'), "kids", F.lit("}")).alias("json"))
    return json_urls(inner.select("json")).select("url")


@query(
    "resolve_links",
    """SELECT ord, CASE WHEN ord % 4 = 3 THEN NULL ELSE 'p' || CAST(ord % 50 AS STRING) || '.md' END AS path FROM [links] t""",
)
def resolve_links(spark, sf_dir):
    """Links hit by the full URL, by the path, by the path with .html for .htm, or not at all."""
    links = base(spark, sf_dir, "links").select("ord")
    number = (c("ord") % 50).cast("string")
    url = (
        F.when(c("ord") % 4 == 0, F.concat(F.lit(B + "/full/"), number, F.lit(".htm")))
        .when(c("ord") % 4 == 1, F.concat(F.lit(B + "/path/"), number, F.lit(".htm?x=1#y")))
        .when(c("ord") % 4 == 2, F.concat(F.lit(B + "/long/"), number, F.lit(".htm")))
        .otherwise(F.concat(F.lit(B + "/none/"), number))
    )
    n = spark.range(50).select(c("id").cast("string").alias("n"), "id")
    keys = [F.concat(F.lit(B + "/full/"), "n", F.lit(".htm")), F.concat(F.lit("/path/"), "n", F.lit(".htm")), F.concat(F.lit("/long/"), "n", F.lit(".html"))]
    targets = n.select(F.explode(F.array(*keys)).alias("key"), F.concat(F.lit("p"), "n", F.lit(".md")).alias("path"), c("id").alias("ord"))
    return toc.resolve_links(links.select("ord", url.alias("url")), targets).select("ord", "path")


@query(
    "frontier_closure",
    """WITH RECURSIVE e AS (SELECT DISTINCT s_suppkey AS src, (s_suppkey * 7 + 3) % 97 AS dst FROM supplier),
       r AS (SELECT 0 AS node, 0 AS depth UNION SELECT e.dst, 0 FROM e JOIN r ON e.src = r.node) SELECT CAST(node AS BIGINT) AS node FROM (SELECT DISTINCT node FROM r)""",
)
def frontier_closure(spark, sf_dir):
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    edges = suppliers.select(c("s_suppkey").alias("src"), ((c("s_suppkey") * 7 + 3) % 97).alias("dst")).distinct()
    return toc.frontier_closure(spark.range(1).select(c("id").alias("node")), edges).select("node")


def guide_relations(spark, sf_dir):
    """A table of contents of the crawled pages, by language, and the pages at URLs that others' links lead to."""
    own = F.regexp_extract("html", r'<a href="(/[^"/]+)"', 1)
    lang = F.coalesce(F.nullif(F.regexp_extract("html", r'<html lang="([^"]+)"', 1), F.lit("")), F.lit("other"))
    title = F.coalesce(F.nullif(text.utrim(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit("")), F.lit("Untitled"))
    found = pages(spark, sf_dir).where("html is not null").select("page_id", "html", own.alias("url"), lang.alias("lang"), title.alias("title")).where("url <> ''")
    folders = found.select("lang").distinct().select(F.lit(1).alias("ord"), F.concat(F.lit("1."), "lang").alias("id"), F.lit("1").alias("parent_id"), F.concat(F.lit("Pages: "), "lang").alias("name"), F.lit("").alias("url"), F.lit(False).alias("is_leaf"))
    root = spark.range(1).select(F.lit(0).alias("ord"), F.lit("1").alias("id"), F.lit("-1").alias("parent_id"), F.lit("Root").alias("name"), F.lit("").alias("url"), F.lit(False).alias("is_leaf"))
    number = F.lpad(c("page_id").cast("string"), 12, "0")
    leaves = found.select(F.lit(2).alias("ord"), F.concat(F.lit("1."), "lang", F.lit("."), number).alias("id"), F.concat(F.lit("1."), "lang").alias("parent_id"), c("title").alias("name"), "url", F.lit(True).alias("is_leaf"))
    return root.unionAll(folders).unionAll(leaves), found.select(F.concat(F.lit(B), "url").alias("url"), "html", c("page_id").alias("ord"))


@query("guide_chain")
def guide_chain(spark, sf_dir):
    """Crawled pages as the files of a guide: converted, placed by the table of contents, links rewritten."""
    nodes, crawled = guide_relations(spark, sf_dir)
    return guide.guide_tree(nodes, crawled).select("path", "url", "rewritten", F.md5("content").alias("content_md5"))
