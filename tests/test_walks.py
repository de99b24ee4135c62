"""Walks, lookups, closures and histograms at shapes that are hard: one ending, one chain, one message."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from docweave.operators import merge, quality, toc

NODE = "ord int, id string, parent_id string, name string, url string, is_leaf boolean"


def rows_out(df):
    """The largest number of rows that any operator of the plan that ran has given."""
    df.collect()
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        for inner in ("executedPlan", "plan"):
            if node.nodeName().startswith(("AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage", "TableCacheQueryStage")):
                try:
                    todo.append(getattr(node, inner)())
                except Exception:  # noqa: BLE001  each kind has one of them
                    continue
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            most = max(most, metric.get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return most


def test_lookup_of_urls_with_one_ending_is_linear(spark):
    n = 10_000
    refs = spark.range(n).select(F.col("id").alias("ord"), F.concat(F.lit("api/a"), "id", F.lit("_Example_CSharp.htm")).alias("url"))
    examples = spark.range(n).select(F.col("id").alias("ord"), F.concat(F.lit("api/b"), "id", F.lit("_Example_CSharp.htm")).alias("url"), F.lit("x").alias("content"))
    found = merge.example_lookup(refs, examples)
    # URLs have some thirty ends each, of which few are as long as a URL of the other side.
    assert rows_out(found) <= 40 * n
    assert found.where("content is not null").count() == 0


def test_lookup_both_ways(spark):
    random.seed(3)
    parts = ["a", "b", "ab", "/", "_x", ".htm", "/site/", "é"]
    make = lambda: "".join(random.choice(parts) for _ in range(random.randint(0, 7)))
    names = [(i, make(), f"content {i}") for i in range(150)]
    urls = [(i, make()) for i in range(200)]
    found = {r.ord: r.content for r in merge.example_lookup(spark.createDataFrame(urls, "ord int, url string"), spark.createDataFrame(names, "ord int, url string, content string")).collect()}
    first, last = {}, {}
    for i, u, text in names:
        first.setdefault(u, i)
        last[u] = text
    for i, url in urls:
        u = url.lstrip("/")
        near = [(o, f) for f, o in first.items() if u.endswith(f) or f.endswith(u)]
        assert found[i] == (last[u] if u in last else last[min(near)[1]] if near else None)


def test_chain_takes_rounds_in_the_logarithm_of_its_depth(spark, monkeypatch):
    n, rounds = 10_000, []
    monkeypatch.setattr(toc, "cut", lambda df, cut=toc.cut: rounds.append(1) or cut(df))
    chain = spark.range(n).select(F.col("id").cast("int").alias("ord"), F.col("id").cast("string").alias("id"), F.when(F.col("id") == 0, "-1").otherwise((F.col("id") - 1).cast("string")).alias("parent_id"), F.lit("n").alias("name"), F.lit("").alias("url"), F.lit(False).alias("is_leaf"))
    out = toc.toc_walk(chain, ("level",))
    assert out.agg(F.count("*"), F.max("level"), F.sum("level")).first()[:] == (n, n - 1, n * (n - 1) // 2)
    assert len(rounds) <= 15


def test_walk_against_parents(spark):
    random.seed(4)
    rows = [(0, "0", "-1", "Root", "", False), (1, "1", "-1", "Second root", "", False)]
    rows += [(i, str(i), str(random.choice([0, *range(max(2, i - 30), i), 900, i + 1] if i > 2 else [0])), random.choice(["a: b", "..", "", "Leaf?", " x "]), f"/u{i}", random.random() < 0.3) for i in range(2, 300)]
    nodes = spark.createDataFrame(rows, NODE)
    safe = {r.id: r.safe for r in nodes.select("id", toc.guide_file_name(F.col("name")).alias("safe")).collect()}
    by = {r[1]: r for r in rows}
    want = {}
    for r in rows:
        path, at = [], r
        while at is not None and at[1] != "0" and len(path) <= len(rows):
            path.append(at)
            at = by.get(at[2])
        if at is not None and at[1] == "0":
            above = [safe[p[1]] for p in path[:0:-1] if not p[5]]
            want[r[1]] = (len(path), "/".join(above).lstrip("/"), " > ".join(["Root", *[p[3] for p in path[::-1]]]))
    found = {r.id: (r.level, r.directory, r.full_path) for r in toc.toc_walk(nodes).collect()}
    assert found == want and 5 < len(found) < 300


def written_bytes(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))


def test_closure_writes_what_it_finds_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(toc, "shared_folder", lambda spark: str(tmp_path / "known"))
    n = 6
    nodes = spark.range(n * 2000)
    edges = nodes.select(F.col("id").alias("src"), (F.col("id") + 2000).alias("dst")).unionAll(nodes.select(F.col("id").alias("src"), F.col("id").alias("dst"))).unionAll(spark.createDataFrame([(5, None)], "src long, dst long"))
    out = toc.frontier_closure(spark.range(2000).withColumnRenamed("id", "node"), edges)
    assert out.agg(F.count("*"), F.countDistinct("node"), F.max("depth")).first()[:] == (2000 * (n + 1), 2000 * (n + 1), n)
    once = tmp_path / "once"
    out.write.partitionBy("depth").parquet(str(once))
    nodes, links = (sum(written_bytes(f) for f in (tmp_path / "known").glob(f"docweave_{kind}*")) for kind in ("known", "links"))
    assert nodes < 2 * written_bytes(once)  # what is known
    stored = tmp_path / "edges"
    edges.write.parquet(str(stored))
    assert links < 2 * written_bytes(stored)  # and the edges, once
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("docweave_known")]


def test_closure_against_steps(spark):
    random.seed(2)
    for size, many in ((60, 60), (40, 300)):
        edges = {(random.randrange(size), random.randrange(size)) for _ in range(many)}
        edges |= {(100 + i, 101 + i) for i in range(8)} | {(3, 100), (106, 103)}
        want, depth, now = {}, 0, {0, 3}
        while now:
            want |= dict.fromkeys(now, depth)
            now, depth = {b for a, b in edges if a in now} - set(want), depth + 1
        frame = spark.createDataFrame(sorted(edges), "src long, dst long")
        assert {r.node: r.depth for r in toc.frontier_closure(spark.createDataFrame([(0,), (3,), (3,)], "node long"), frame).collect()} == want


def test_closure_of_nothing(spark):
    none = spark.createDataFrame([], "node string")
    assert toc.frontier_closure(none, spark.createDataFrame([("a", "b")], "src string, dst string")).collect() == []
    assert toc.frontier_closure(spark.createDataFrame([("a",), (None,)], "node string"), spark.createDataFrame([], "src string, dst string")).collect() == [("a", 0)]


def test_histogram_of_one_hot_message(spark):
    log = spark.range(50_000, numPartitions=9).select(F.when(F.col("id") % 50 != 1, "hot").otherwise(F.concat(F.lit("rare "), (F.col("id") % 7).cast("string"))).alias("error"), (50_000 - F.col("id")).alias("ord"), F.concat(F.lit("u"), "id").alias("url"))
    log = log.unionAll(spark.createDataFrame([(None, 1, "fine"), ("hot", 2, None), ("hot", 2, "a")], "error string, ord long, url string"))
    out = quality.error_histogram(log, samples=3)
    assert "Window" not in out._jdf.queryExecution().toString()
    rows = {r.error: (r.n, r.urls) for r in out.collect()}
    everything = [r for r in log.where("error is not null").collect()]
    assert len(rows) == 8 and sum(n for n, _ in rows.values()) == len(everything)
    # Ordinals are 1 and up; of the second there are three rows: no URL, which takes a place but shows nothing, then "a".
    assert rows["hot"] == (sum(r.error == "hot" for r in everything), "u49999 a")
    rare = sorted((r.ord, r.url) for r in everything if r.error == "rare 1")
    assert rows["rare 1"] == (len(rare), " ".join(u for _, u in rare[:3]))


def test_histogram_of_no_errors(spark):
    assert quality.error_histogram(spark.createDataFrame([(None, 1, "u")], "error string, ord long, url string")).collect() == []
