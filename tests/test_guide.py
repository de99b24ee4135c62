"""The guide from pages to rewritten files, against a plain walk with the standard library's URLs and paths."""

import hashlib
import posixpath
import re
from pathlib import Path
from urllib.parse import urljoin, urlparse

import pytest

from docweave.operators import guide
from docweave.plans.pages import guide_chain, guide_relations
from docweave.sources import filetree
from docweave.sources.tree import to_markdown

BASE = "https://docs.example.com"
DATA = "/root/testdata/sf0.001"


def plain_guide(nodes, pages):
    """{path: (url, content, rewritten)} of rows (id, parent_id, name, url, is_leaf) and (url, html, ord)."""
    html = {u: text for u, text, _ in sorted(pages, key=lambda p: p[2])}
    children = {}
    for n in sorted(nodes):
        children.setdefault(n[1], []).append(n)
    safe = lambda name: re.sub(r"^[. ]+|[. ]+$", "", re.sub(r'[<>:"/\\|?*]', "_", name))[:200]
    files, index, placed = {}, {}, []

    def walk(node, above):
        for child in children.get(node[0], []):
            if child[4] and child[3]:
                if BASE + child[3] in html:
                    placed.append((child[0], BASE + child[3], "/".join([*above, safe(child[2])]) + ".md"))
                walk(child, above)
            else:
                walk(child, above if child[4] else [*above, safe(child[2])])

    walk(next(n for n in nodes if n[1] == "-1"), [])
    for _, url, path in sorted(placed):
        files[path] = url
        for key in (url, url[len(BASE) :], urlparse(url).path):
            index[key] = path

    def found(url):
        u = urlparse(url)
        local = u.path + ("?" + u.query if u.query else "") if url.startswith("http") else None
        return next((index[k] for k in (url, u.path, local, u.path + "l" if u.path.endswith(".htm") else None) if k in index), None)

    out = {}
    for path, url in files.items():
        n = 0

        def link(m, path=path, url=url):
            nonlocal n
            words, to = m[1], m[2]
            if (re.match("https?://", to) and "docs.example.com" not in to) or "/reference/" in to or to.startswith(("#", "mailto:")):
                return m[0]
            target = found(urljoin(url, to))
            if target is None:
                return m[0]
            n += 1
            return f"[{words}]({re.sub(r'(?i)[.]html?$', '.md', posixpath.relpath(target, posixpath.dirname(path) or '.'))})"

        content = re.sub(r"\[([^\]]+)\]\(([^)]+)\)", link, to_markdown(html[url]))
        out[path] = (url, content, n)
    return out


NODES = [
    ("1", "-1", "Root", "", False), ("1.1", "1", "Start: here", "/help/start.htm", True), ("1.2", "1", "Deep?", "", False), ("1.2.1", "1.2", "Page", "/help/deep/page.htm?id=3", True),
    ("1.2.2", "1.2", "Inner", "", False), ("1.2.2.1", "1.2.2", "Leaf", "/help/deep/leaf.html", True), ("1.3", "1", "Same", "/help/a.htm", True), ("1.4", "1", "Same", "/help/b.htm", True),
    ("1.5", "1", "No page", "/help/none.htm", True), ("1.6", "1", "Bad", "/help/bad.htm", True),
]
PAGES = [
    ("/help/start.htm", '<h1>Start</h1><p><a href="deep/page.htm?id=3">p</a> <a href="/help/deep/page.htm">path</a> <a href="deep/leaf.htm#x">leaf</a> <a href="none.htm">none</a> <a href="#top">top</a> <a href="mailto:a@b.c">m</a> <a href="https://other.org/x">o</a> <a href="b.htm">b</a> <a href="a.htm">a</a></p>'),
    ("/help/deep/page.htm?id=3", '<p>old</p>'), ("/help/deep/page.htm?id=3", '<p><a href="../start.htm">s</a> <a href="leaf.html">l</a><a href="/reference/x.htm">r</a></p>'),
    ("/help/deep/leaf.html", '<p><a href="https://docs.example.com/help/start.htm">s</a><a href="?q=1">q</a></p>'), ("/help/a.htm", "<p>a</p>"), ("/help/b.htm", '<p>b <a href="start.htm">s</a></p>'), ("/help/unlisted.htm", "<p>u</p>"),
]


@pytest.fixture
def made(spark):
    nodes = spark.createDataFrame([(i, *n) for i, n in enumerate(NODES)], "ord int, id string, parent_id string, name string, url string, is_leaf boolean")
    pages = spark.createDataFrame([(BASE + u, h, i) for i, (u, h) in enumerate(PAGES)], "url string, html string, ord int")
    return guide.guide_tree(nodes, pages)


def test_small_guide(made):
    rows = {r.path: (r.url, r.content, r.rewritten) for r in made.collect()}
    assert rows == plain_guide(NODES, [(BASE + u, h, i) for i, (u, h) in enumerate(PAGES)])
    assert set(rows) == {"Start_ here.md", "Deep_/Page.md", "Deep_/Inner/Leaf.md", "Same.md"}
    assert rows["Start_ here.md"][1:] == ("# Start\n\n[p](Deep_/Page.md) [path](Deep_/Page.md) [leaf](Deep_/Inner/Leaf.md) [none](none.htm) [top](#top) [m](mailto:a@b.c) [o](https://other.org/x) [b](Same.md) [a](Same.md)\n", 5)
    assert rows["Same.md"][0].endswith("b.htm")


def test_files_on_disk(made, tmp_path):
    filetree.write_tree(made, str(tmp_path / "docs"))
    files = {str(f.relative_to(tmp_path / "docs")): f.read_text() for f in (tmp_path / "docs").rglob("*.md")}
    assert files == {r.path: r.content for r in made.collect()}


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
def test_guide_of_crawled_pages(spark):
    nodes, pages = guide_relations(spark, DATA)
    want = plain_guide([(r.id, r.parent_id, r.name, r.url, r.is_leaf) for r in nodes.collect()], [(r.url, r.html, r.ord) for r in pages.collect()])
    rows = guide_chain(spark, DATA).collect()
    assert {r.path: (r.url, r.content_md5, r.rewritten) for r in rows} == {p: (u, hashlib.md5(text.encode()).hexdigest(), n) for p, (u, text, n) in want.items()}
    assert sum(r.rewritten for r in rows) > len(rows) > 10
