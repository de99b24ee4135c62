"""Tables of contents: paths, outlines, link resolution and crawl frontiers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.text import guide_file_name, md_links, with_links
from docweave.functions.urls import joined_url, link_candidates, relative_path
from docweave.operators.storage import cut, shared_folder


def toc_nodes(files: DataFrame) -> DataFrame:
    """Nodes of table-of-contents files (id, parentId, name, url, isLeaf, children, ord).

    A file's own node replaces stubs, the last file winning; stubs only fill
    gaps, the first winning.
    """
    own = files.select("ord", F.lit(1).alias("own"), "id", F.col("parentId").alias("parent_id"), "name", "url", F.col("isLeaf").alias("is_leaf"))
    stubs = files.select("ord", F.inline("children")).select("ord", F.lit(0).alias("own"), "id", F.col("parentId").alias("parent_id"), "name", "url", F.col("isLeaf").alias("is_leaf"))
    rank = F.struct("own", F.when(F.col("own") == 1, F.col("ord")).otherwise(-F.col("ord")))
    row = F.struct("parent_id", "name", "url", "is_leaf")
    return own.unionAll(stubs).groupBy("id").agg(F.max_by(row, rank).alias("r")).select("id", "r.*")


def toc_root(nodes: DataFrame) -> DataFrame:
    """The first node with parent -1; a table of contents without one is an error."""
    roots = nodes.where("parent_id = '-1'")
    if roots.isEmpty():
        raise ValueError("no root: no node has the parent -1")
    row = F.struct(*[c for c in nodes.columns if c != "ord"])
    return roots.agg(F.min_by(row, "ord").alias("r")).select("r.*")


#: What ``toc_walk`` can carry along the way, by column.
WALKED = ("level", "directory", "full_path")


def toc_walk(nodes: DataFrame, want: tuple[str, ...] = WALKED) -> DataFrame:
    """id, name, url, is_leaf, safe and what ``want`` names of every node that the root reaches.

    ``level`` is the number of steps from the root, ``directory`` joins the file
    names of the inner nodes above, the root left out; ``full_path`` all names.
    Ids must differ (``toc_nodes`` makes them so).

    By pointer doubling: a node knows an ancestor and what stands between; each
    round it takes over that ancestor's own, twice as far, until the root is there.
    So a tree of depth d takes log2(d) rounds of one join.  A node whose ancestor
    is unknown goes; those that no round can end, as rounds reach farther than
    there are nodes, are on or below a cycle and go too.
    """
    named = nodes.withColumn("safe", guide_file_name(F.col("name")))
    root = toc_root(named).first()
    inner = F.when(F.col("is_leaf"), "").otherwise(F.concat(F.lit("/"), "safe"))
    # What a node adds for those below it, and what stands between it and its pointer (both ends left out).
    own = {"level": F.lit(1), "directory": inner, "full_path": F.concat(F.lit(" > "), "name")}
    adds, between = [own[c].alias(f"own_{c}") for c in want], [F.lit(0 if c == "level" else "").alias(c) for c in want]
    kept = ["id", "name", "url", "is_leaf", "safe"]
    rows = named.where((F.col("id") != root["id"]) & F.col("parent_id").isNotNull())
    state = cut(rows.select(*kept, F.col("parent_id").alias("up"), *adds, *between))
    limit = max(1, state.count()).bit_length()
    arrived = F.col("up") == root["id"]
    for _ in range(limit):
        if state.where(~arrived).isEmpty():
            break
        above = state.select(F.col("id").alias("up"), F.col("up").alias("_up"), *[F.col(c).alias(f"_{c}") for c in want], *[F.col(f"own_{c}").alias(f"_own_{c}") for c in want])
        farther = [(F.col(c) + F.col(f"_own_{c}") + F.col(f"_{c}") if c == "level" else F.concat(f"_{c}", f"_own_{c}", c)).alias(c) for c in want]
        moved = state.where(~arrived).join(above, "up").select(*kept, F.col("_up").alias("up"), *[f"own_{c}" for c in want], *farther)
        state = cut(state.where(arrived).unionByName(moved))
    ends = {
        "level": F.col("level") + 1,
        "directory": F.regexp_replace("directory", "^/+", ""),
        "full_path": F.concat(F.lit(root["name"]), F.col("full_path"), F.lit(" > "), F.col("name")),
    }
    begins = {"level": F.lit(0), "directory": F.lit(""), "full_path": F.lit(root["name"])}
    top = named.where(F.col("id") == root["id"]).limit(1).select(*kept, *[begins[c].alias(c) for c in want])
    return top.unionByName(state.where(arrived).select(*kept, *[ends[c].alias(c) for c in want]))


def rewritten_pages(pages: DataFrame, targets: DataFrame, skip: Callable[[Column], Column]) -> DataFrame:
    """``pages`` (path, base_url, content) with links to known pages made relative, and how many were.

    Links are taken out in order, resolved against ``targets`` (key, path, ord)
    and put back; a page without such a link keeps its content.
    """
    links = pages.select("path", "base_url", F.posexplode(md_links(F.col("content"))).alias("at", "link")).withColumn("ord", F.concat_ws("\x00", "path", "at"))
    wanted = links.where(~skip(F.col("link.url"))).select("ord", joined_url(F.col("base_url"), F.col("link.url")).alias("url"))
    found = resolve_links(wanted, targets).select("ord", F.col("path").alias("to"))
    relative = F.regexp_replace(relative_path(F.col("path"), F.col("to")), r"(?i)\.html?$", ".md")
    each = links.join(found, "ord", "left").withColumn("target", F.when(F.col("to").isNotNull(), relative))
    by_page = each.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "target"))).alias("made"), F.count("to").alias("rewritten"))
    joined = pages.join(by_page, "path", "left")
    content = F.when(F.coalesce("rewritten", F.lit(0)) > 0, with_links(F.col("content"), F.col("made.target"))).otherwise(F.col("content"))
    return joined.select("path", content.alias("content"), F.coalesce("rewritten", F.lit(0)).cast("long").alias("rewritten"))


def resolve_links(links: DataFrame, targets: DataFrame) -> DataFrame:
    """Links (url) with the path of their page: the best candidate key that ``targets`` (key, path, ord) has."""
    index = targets.groupBy("key").agg(F.max_by("path", "ord").alias("path"))
    keyed = links.select("*", F.posexplode(link_candidates(F.col("url"))).alias("_rank", "key")).where("key is not null")
    hits = keyed.join(index, "key").groupBy("ord").agg(F.min_by("path", "_rank").alias("path"))
    return links.join(hits, "ord", "left")


def frontier_closure(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """All nodes that edges (src, dst) reach from the seeds (node), with the least number of steps; null nodes are none.

    Semi-naive: each round joins only the nodes of the round before.  Edges are put
    into buckets by source once, and known nodes are a table in the same buckets to
    which a round appends its own.  So a round shuffles only what it finds: its
    nodes meet their edges, and what they find meets what is known, bucket by bucket.
    What is known is written once.
    """
    spark = seeds.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mark, kind = uuid.uuid4().hex, seeds.schema["node"].dataType
    known, links = f"docweave_known_{mark}", f"docweave_links_{mark}"
    folders = {t: f"{shared_folder(spark)}/{t}" for t in (known, links)}

    def store(rows: DataFrame, table: str, key: str, *parts: str) -> None:
        made = rows.write.mode("append").format("parquet").bucketBy(buckets, key).option("path", folders[table])
        (made.partitionBy(*parts) if parts else made).saveAsTable(table)

    try:
        whole = edges.select(F.col("src").cast(kind).alias("src"), F.col("dst").cast(kind).alias("dst")).where("src is not null and dst is not null")
        store(whole.repartition(buckets, "src"), links, "src")
        depth, found = 0, seeds.select("node").where("node is not null").distinct()
        while True:
            store(found.withColumn("depth", F.lit(depth)), known, "node", "depth")
            fresh = spark.table(known).where(F.col("depth") == depth).select("node")
            if fresh.isEmpty():
                break
            step = fresh.join(spark.table(links), F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
            depth, found = depth + 1, step.join(spark.table(known).select("node"), "node", "left_anti")
        schema = spark.table(known).schema
    finally:
        for table in (known, links):
            spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files of external tables stay
    return spark.read.schema(schema).parquet(folders[known])
