"""Column expressions over URLs, links and paths of a crawled site."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.columns import last, let


@dataclass(frozen=True)
class Site:
    """The crawled site: where it is, and below which path its reference and its own pages lie."""

    base: str = "https://docs.example.com"
    root: str = "/help/api/"
    reference: str = "reference/"

    @property
    def host(self) -> str:
        return self.base.split("//", 1)[1]


SITE = Site()
#: Fixed value: characters that saved paths can't have.
UNSAFE_PATH = r'[<>:"|?*]'
_QUERY = r"^[^?#]*\?([^#]*)"


def absolute_url(url: Column, base: str) -> Column:
    """A path of the site or a relative URL put on ``base``; full URLs stay."""
    return (
        F.when(url.startswith("/"), F.concat(F.lit(base), url))
        .when(url.startswith("http"), url)
        .otherwise(F.concat(F.lit(base + "/"), url))
    )


def url_path(url: Column) -> Column:
    """The path of a URL; by pattern where the URL can't be parsed."""
    by_pattern = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), by_pattern)


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def url_query(url: Column) -> Column:
    """The query of a URL, empty where there is none."""
    return F.regexp_extract(url, _QUERY, 1)


def _below_root(url: Column, site: Site) -> Column:
    stripped = F.regexp_replace(url_path(url), "^/+|/+$", "")
    root = site.root.strip("/") + "/"
    return F.when(stripped.startswith(root), F.substring(stripped, F.lit(len(root) + 1), F.length(stripped))).otherwise(stripped)


def _query_mark(url: Column) -> Column:
    return F.concat(F.lit("_"), F.left(F.md5(url_query(url)), F.lit(8)), F.lit(".html"))


def page_file_path(url: Column, site: Site = SITE, toc: bool = True) -> Column:
    """Where a page is saved; table-of-contents URLs name JSON files where ``toc``.

    A query's mark goes in before ``.htm`` and, in the result, before ``.html``
    again, so it stands twice.
    """
    path = _below_root(url, site)
    marked = F.replace(F.replace(path, F.lit(".htm"), _query_mark(url)), F.lit(".html"), _query_mark(url))
    named = F.when(url_query(url) != "", marked).otherwise(path)
    page = F.when(named.endswith(".html"), named).otherwise(F.concat(named, F.lit(".html")))
    if toc:
        number = F.regexp_extract(F.url_decode(F.regexp_extract(url_query(url), r"(?:^|&)queryParam=([^&]*)", 1)), r"id=(-?[\d.]+)", 1)
        node = F.when(number != "", F.concat(F.lit("expandToc_id_"), number, F.lit(".json"))).otherwise(
            F.concat(F.lit("expandToc_"), F.left(F.md5(url_query(url)), F.lit(8)), F.lit(".json"))
        )
        page = F.when(F.regexp_replace(url_path(url), "^/+|/+$", "") == "expandToc", node).otherwise(page)
    return F.regexp_replace(page, UNSAFE_PATH, "_")


def example_file_path(url: Column, site: Site = SITE) -> Column:
    """Where an example is saved: one query mark, and ``.htm`` stays without a query."""
    path = _below_root(url, site)
    stem = F.regexp_replace(path, r"\.html?$", "")
    plain = F.when(path.rlike(r"\.html?$"), path).otherwise(F.concat(path, F.lit(".html")))
    named = F.when(url_query(url) != "", F.concat(stem, _query_mark(url))).otherwise(plain)
    return F.regexp_replace(named, UNSAFE_PATH, "_")


def in_boundary(url: Column, root: str) -> Column:
    return url_path(url).startswith(root)


def in_domain(url: Column, domain: str) -> Column:
    """Whether a URL's host is the domain or below it."""
    host = url_host(url)
    return (host == domain) | host.endswith("." + domain)


def toc_expand_url(url: Column, base: str) -> Column:
    """The URL of the table of contents below a page: from the id in its query; null without one."""
    number = F.regexp_extract(url_query(url), r"(?:^|&)id=([^&]+)", 1)
    return F.when(number != "", F.concat(F.lit(base + "/expandToc?version=1&queryParam=?id="), number))


def href_to_cref(href: Column) -> Column:
    """The dotted name that a link to a type or member page stands for; null for other links."""

    def named(name: Column) -> Column:
        parts = F.split(name, "~")
        bare = ~href.contains("/") & ~href.contains("\\") & ~href.contains("..")
        return F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 2, F.size(parts) - 1), ".")).when(name.contains(".") & bare, name)

    base = last(F.split(F.regexp_replace(href, r"\\", "/"), "/"))
    return let(F.replace(F.replace(base, F.lit(".html"), F.lit("")), F.lit(".htm"), F.lit("")), named)


def href_to_url(href: Column, site: Site = SITE) -> Column:
    """A link of a reference page as a full URL; one leading ``../`` leads to the site's root."""
    up = F.concat(F.lit(site.base + site.root), F.substring(href, F.lit(4), F.length(href)))
    return (
        F.when(href.rlike("^https?://"), href)
        .when(href.startswith("../"), up)
        .otherwise(F.concat(F.lit(site.base + site.root + site.reference), href))
    )


def example_file_name(url: Column) -> Column:
    """Markdown file of an example URL."""
    return F.regexp_replace(last(F.split(url, "/")), r"(?i)\.(htm|html)$", ".md")


def example_link(url: Column, category: Column) -> Column:
    """Link from a type's overview to an example, by category directory."""
    from docweave.functions.text import category_dir_name

    return F.concat(F.lit("../../../docs/examples/"), category_dir_name(F.coalesce(category, F.lit("Other"))), F.lit("/"), example_file_name(url))


def is_skipped_link(url: Column, site: Site = SITE) -> Column:
    """Links that are left as they are: other hosts, reference pages, anchors, mail."""
    foreign = url.rlike("^https?://") & ~url.contains(site.host)
    return foreign | url.contains("/" + site.reference) | url.startswith("#") | url.startswith("mailto:")


def is_example_link(href: Column) -> Column:
    return href.contains("Example") & href.endswith(".htm") & ~href.startswith("#")


def href_type(href: Column) -> Column:
    """The dotted type name of a link to a type page: the second ``~`` part of its file name."""
    name = F.replace(last(F.split(href, "/")), F.lit(".html"), F.lit(""))
    part = F.split_part(name, F.lit("~"), F.lit(2))
    return F.when(part != "", part)


def relative_path(source: Column, target: Column) -> Column:
    """The path from the file ``source`` to the file ``target``."""

    def walked(both: Column) -> Column:
        here, there = both["here"], both["there"]
        same = F.zip_with(here, there, lambda a, b: F.coalesce(a == b, F.lit(False)))
        first = F.array_position(same, F.lit(False))
        shared = F.when(first > 0, first.cast("int") - 1).otherwise(F.least(F.size(here), F.size(there)))
        return let(shared, lambda n: F.array_join(F.concat(F.array_repeat(F.lit(".."), F.size(here) - n), F.slice(there, n + 1, F.size(there) - n)), "/"))

    parts = F.split(source, "/")
    return let(F.struct(F.slice(parts, 1, F.size(parts) - 1).alias("here"), F.split(target, "/").alias("there")), walked)


def link_candidates(url: Column) -> Column:
    """Keys under which a link's page may be indexed, best first."""
    path = url_path(url)
    query = url_query(url)
    with_query = F.when(url.startswith("http") & (query != ""), F.concat(path, F.lit("?"), query)).when(url.startswith("http"), path)
    return F.array(url, path, with_query, F.when(path.endswith(".htm"), F.concat(path, F.lit("l"))))


def _without_dots(path: Column) -> Column:
    """A path with ``.`` and ``..`` segments resolved; a last one of them leaves a slash."""

    def step(kept: Column, part: Column) -> Column:
        up = F.when(F.size(kept) > 1, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    parts = F.split(path, "/")
    walked = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.concat(F.array_join(walked, "/"), F.when(last(parts).isin(".", ".."), "/").otherwise(""))


def joined_url(base: Column, link: Column) -> Column:
    """The full URL of a link on the page ``base``."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"#.*$", "")
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    own, tail = F.regexp_extract(link, r"^([^?#]*)", 1), F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    return (
        F.when(F.coalesce(link, F.lit("")) == "", base)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(origin, "^([^:]*:)", 1), link))
        .when(link.startswith("#"), F.concat(page, link))
        .when(link.startswith("?"), F.concat(origin, path, link))
        .when(link.startswith("/"), F.concat(origin, _without_dots(own), tail))
        .otherwise(F.concat(origin, _without_dots(F.concat(folder, own)), tail))
    )


def is_html(content_type: Column) -> Column:
    """Whether a response is a page, by its content type; false where there is none."""
    return F.coalesce(F.lower(content_type).contains("text/html"), F.lit(False))
