import pytest

from docweave.operators import merge, toc


def test_details_go_to_properties_before_methods(spark):
    members = spark.createDataFrame([(1, "N.T", "X", "property"), (2, "N.T", "X", "method"), (3, "N.T", "Y", "method"), (4, "N.T", "Y", "method")], "ord int, fqn string, member string, kind string")
    fields = "ord int, fqn string, member string, description string, signature string, params string, returns string, remarks string"
    details = spark.createDataFrame([(1, "N.T", "X", "a", "s", "", "", ""), (2, "N.T", "X", "", "t", "", "", ""), (3, "N.T", "Y", "y", "", "", "", "r")], fields)
    rows = {r.ord: r for r in merge.enrich_members(members, details).collect()}
    assert (rows[1].description, rows[1].signature) == ("a", "t")  # the last value that isn't empty
    assert rows[2].description == "" and rows[3].remarks == rows[4].remarks == "r"


def test_example_lookup_takes_the_first_suffix(spark):
    refs = spark.createDataFrame([(1, "/api/long_name.htm"), (2, "b.htm"), (3, "none/of/these.htm")], "ord int, url string")
    examples = spark.createDataFrame([("x/api/long_name.htm", "one", 1), ("y/api/long_name.htm", "two", 2), ("site/b.htm", "three", 3)], "url string, content string, ord int")
    assert {r.ord: r.content for r in merge.example_lookup(refs, examples).collect()} == {1: "one", 2: "three", 3: None}


def test_example_category_ties(spark):
    refs = spark.createDataFrame([(1, "A", "/u"), (2, "B", "u"), (3, "C", "v")], "ord int, fqn string, url string")
    types = spark.createDataFrame([("A", "second"), ("B", "first"), ("C", None)], "fqn string, category string")
    assert {r.url: r.category for r in merge.example_category(refs, types).collect()} == {"u": "second", "v": "Other"}


def test_toc_order_and_paths(spark):
    nodes = spark.createDataFrame(
        [(0, "1", "-1", "Root", "", False), (1, "1.1", "1", "In: side", "", False), (2, "1.1.0", "1.1", "Leaf", "/l", True), (3, "1.1.1", "1.1", "Inner", "/i", False), (4, "1.1.1.0", "1.1.1", "Deep", "/d", True)],
        "ord int, id string, parent_id string, name string, url string, is_leaf boolean",
    )
    rows = {r.id: r for r in toc.toc_walk(nodes).collect()}
    assert rows["1.1.0"].directory == "In_ side" and rows["1.1.1.0"].directory == "In_ side/Inner"
    assert rows["1.1.1.0"].full_path == "Root > In: side > Inner > Deep" and rows["1"].level == 0


def test_frontier_reaches_a_cycle_once(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (9, 10)], "src long, dst long")
    rows = toc.frontier_closure(spark.createDataFrame([(1,)], "node long"), edges).collect()
    assert {(r.node, r.depth) for r in rows} == {(1, 0), (2, 1), (3, 2), (4, 3)}


NODE = "ord int, id string, parent_id string, name string, url string, is_leaf boolean"


def test_toc_of_any_depth(spark):
    from pyspark.sql import functions as F

    nodes = spark.range(130).select(F.col("id").cast("int").alias("ord"), F.col("id").cast("string").alias("id"), (F.col("id") - 1).cast("string").alias("parent_id"), F.concat(F.lit("n"), "id").alias("name"), F.lit("").alias("url"), F.lit(False).alias("is_leaf"))
    rows = {r.id: r for r in toc.toc_walk(nodes).collect()}
    assert len(rows) == 130 and rows["129"].level == 129 and rows["129"].directory.count("/") == 127


def test_toc_without_a_root_or_with_a_cycle(spark):
    with pytest.raises(ValueError, match="no root"):
        toc.toc_walk(spark.createDataFrame([(0, "1", "2", "a", "", False)], NODE))
    cycle = spark.createDataFrame([(0, "1", "-1", "Root", "", False), (1, "2", "1", "a", "", False), (2, "1", "2", "again", "", False), (3, "9", "-1", "second", "", False)], NODE)
    assert {r.id: r.level for r in toc.toc_walk(cycle).collect()} == {"1": 0, "2": 1}


def test_example_lookup_by_every_length(spark):
    import random

    random.seed(3)
    urls = ["".join(random.choice("ab/") for _ in range(random.randint(1, 22))).lstrip("/") or "a" for _ in range(160)]
    refs, examples = urls[:80], list(dict.fromkeys(urls[80:]))
    found = merge.example_lookup(spark.createDataFrame(list(enumerate(refs)), "ord int, url string"), spark.createDataFrame([(u, u, i) for i, u in enumerate(examples)], "url string, content string, ord int"))
    wanted = {i: r if r in examples else next((e for e in examples if e.endswith(r) or r.endswith(e)), None) for i, r in enumerate(refs)}
    assert {r.ord: r.content for r in found.collect()} == wanted and len(set(wanted.values())) > 10


def test_links_of_a_page_are_put_back(spark):
    from docweave.functions.urls import is_skipped_link

    content = "A [one](../t/1.htm#x) [x](y\\z) [gone](none.htm)\n[two](https://docs.example.com/help/api/t/1.htm) [see](https://example.org/a) ![i]() tail"
    pages = spark.createDataFrame([("g/a/p.md", "https://docs.example.com/help/api/s/p.htm", content), ("g/q.md", "https://docs.example.com/help/api/q.htm", "no links")], "path string, base_url string, content string")
    targets = spark.createDataFrame([("/help/api/t/1.htm", "g/b/one.html", 0)], "key string, path string, ord int")
    rows = {r.path: r for r in toc.rewritten_pages(pages, targets, is_skipped_link).collect()}
    assert rows["g/a/p.md"].content == content.replace("../t/1.htm#x", "../b/one.md").replace("https://docs.example.com/help/api/t/1.htm", "../b/one.md")
    assert rows["g/a/p.md"].rewritten == 2 and tuple(rows["g/q.md"]) == ("g/q.md", "no links", 0)
