"""The guide as one chain: crawled pages to Markdown files at their places, links between them made relative."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.urls import SITE, Site, is_skipped_link, url_path
from docweave.operators.storage import cut
from docweave.operators.toc import rewritten_pages, toc_walk
from docweave.sources.html import page_rows
from docweave.sources.tree import to_markdown


def guide_places(nodes: DataFrame, pages: DataFrame, site: Site = SITE) -> DataFrame:
    """url, path, ord and page of the leaves of a table of contents that have a page; ``page`` is the last one's ord.

    No content is read: only the URLs and ordinals of pages.
    """
    folder = F.when(F.col("directory") == "", "").otherwise(F.concat("directory", F.lit("/")))
    leaves = toc_walk(nodes, ("directory",)).where("is_leaf and url <> ''")
    placed = leaves.select(F.concat(F.lit(site.base), "url").alias("url"), F.concat(folder, "safe", F.lit(".md")).alias("path"), F.col("id").alias("ord"))
    return placed.join(pages.groupBy("url").agg(F.max("ord").alias("page")), "url")


def link_targets(places: DataFrame, site: Site = SITE) -> DataFrame:
    """(key, path, ord) under which links find the files of ``places``: the URL, without its host, and its path alone."""
    own = F.substring("url", F.lit(len(site.base) + 1), F.length("url"))
    return places.select(F.explode(F.array_distinct(F.array("url", own, url_path(F.col("url"))))).alias("key"), "path", "ord").where("key <> ''")


def guide_tree(nodes: DataFrame, pages: DataFrame, site: Site = SITE) -> DataFrame:
    """path, url, content and rewritten (number of links) of the guide's Markdown files.

    nodes: a table of contents (``toc_walk``), URLs without host; pages: full url, html,
    ord; of a URL's pages the last counts, and of the leaves at one path the last.
    A page that can't be converted has no file, though links to it still lead there.

    Places, winners and link targets are found from keys alone.  Then only the
    pages that make a file are converted, where they are read, and the Markdown
    moves twice: by URL to its place, by path to its links.
    """
    places = cut(guide_places(nodes, pages, site))
    winners = places.groupBy("path").agg(F.max_by(F.struct("url", "page"), "ord").alias("w")).select("path", "w.*")
    wanted = winners.select("url", F.col("page").alias("ord")).distinct()
    markdown = page_rows(pages.join(wanted, ["url", "ord"], "left_semi"), lambda html, _: [{"markdown": to_markdown(html)}], "markdown string", ["url", "ord"]).where("error is null")
    # Equal ordinals of one URL are one page: the greater text.
    texts = markdown.groupBy("url", F.col("ord").alias("page")).agg(F.max("markdown").alias("content"))
    files = cut(winners.join(texts, ["url", "page"]).select("path", F.col("url").alias("base_url"), "content"))
    made = rewritten_pages(files, link_targets(places, site), lambda link: is_skipped_link(link, site))
    return made.join(winners.select("path", "url"), "path").select("path", "url", "content", "rewritten")
