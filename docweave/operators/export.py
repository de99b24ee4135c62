"""Trees of files: rows of (path, content, ord) for the ``filetree`` sink, and files of a whole corpus.

Where two rows have one path, the later by ``ord`` is the one that a sink writes
(``last_of_path``).  Files that are one by nature (an assembly's XML docs, an index)
are rows of parts (path, ord, part), which the sink streams to them in order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import names, render, text, urls
from docweave.operators.storage import cut
from docweave.sources import filetree

_FILE = ["path", "content", "ord"]


def last_of_path(files: DataFrame) -> DataFrame:
    """path and content of the last row of each path."""
    return files.groupBy("path").agg(F.max_by("content", "ord").alias("content"))


def _folder(is_enum: Column, type_name: Column) -> Column:
    return F.concat(F.lit("api/"), F.when(is_enum, "enums").otherwise("types"), F.lit("/"), text.api_file_name(type_name), F.lit("/"))


def api_files(types: DataFrame, members: DataFrame, enum_members: DataFrame) -> DataFrame:
    """Files below api/: of each type an overview and one file for each property, method and value, in this order.

    types: fqn, type_name, assembly, namespace, category, description, remarks,
    is_enum, n_properties, n_methods, n_enum_members; members: fqn, ord, kind,
    member, description, signature, params, returns, remarks; enum_members: fqn,
    ord, member, description.
    """
    c = F.col
    keyed = types.select("fqn", "type_name", "assembly", "namespace", "category", _folder(c("is_enum"), c("type_name")).alias("folder"))

    def file(name: Column | str, content: Column, rank: Column, at: Column) -> list[Column]:
        named = F.lit(name) if isinstance(name, str) else text.api_file_name(name)
        return [F.concat("folder", named, F.lit(".md")).alias("path"), content.alias("content"), F.struct(c("fqn").alias("f"), rank.alias("r"), at.cast("long").alias("o")).alias("ord")]

    overview = render.overview_page(*[c(x) for x in ("type_name", "assembly", "namespace", "category", "description", "remarks", "n_properties", "n_methods", "n_enum_members")])
    page = render.member_page(*[c(x) for x in ("kind", "type_name", "member", "assembly", "namespace", "category", "description", "signature", "params", "returns", "remarks")])
    value = render.enum_page(*[c(x) for x in ("type_name", "member", "assembly", "namespace", "category", "description")])
    overviews = types.withColumn("folder", _folder(c("is_enum"), c("type_name"))).select(*file("_overview", overview, F.lit(0), F.lit(0)))
    pages = members.join(keyed, "fqn").select(*file(c("member"), page, F.when(c("kind") == "property", 1).otherwise(2), c("ord")))
    values = enum_members.join(keyed, "fqn").select(*file(c("member"), value, F.lit(3), c("ord")))
    return overviews.unionAll(pages).unionAll(values)


def example_files(examples: DataFrame, categories: DataFrame) -> DataFrame:
    """Files below docs/examples/, one directory a category; examples: ord, url, content; categories: url, category."""
    c = F.col
    code = text.first_code(c("content"))
    page = render.example_page(text.example_title(c("content")), c("url"), text.example_description(c("content")), code, text.fence_tag(names.detect_language(c("url"), code)))
    folder = text.category_dir_name(F.coalesce("category", F.lit("Other")))
    path = F.concat(F.lit("docs/examples/"), folder, F.lit("/"), urls.example_file_name(c("url")))
    return examples.join(categories.select("url", "category"), "url", "left").select(path.alias("path"), page.alias("content"), "ord")


def guide_files(walk: DataFrame, pages: DataFrame) -> DataFrame:
    """Files of the guide: pages (url, markdown) at the places of the leaves of a table of contents; leaves without a page go."""
    folder = F.when(F.col("directory") == "", "").otherwise(F.concat("directory", F.lit("/")))
    leaves = walk.where("is_leaf and url <> ''").select("url", F.concat(folder, "safe", F.lit(".md")).alias("path"), F.col("id").alias("ord"))
    return leaves.join(pages, "url").select("path", F.col("markdown").alias("content"), "ord")


def assembly_doc_parts(fragments: DataFrame) -> DataFrame:
    """One XML-doc file an assembly, as parts; fragments: assembly, ord (of any type that sorts), fragment."""
    path, kind = F.concat("assembly", F.lit(".xml")).alias("path"), fragments.schema["ord"].dataType
    edges = F.array(F.struct(F.lit(0).alias("r"), render.xml_doc_head(F.col("assembly")).alias("part")), F.struct(F.lit(2).alias("r"), F.lit(render.XML_DOC_FOOT).alias("part")))
    around = fragments.select("assembly").distinct().select(path, F.explode(edges).alias("e")).select("path", F.struct("e.r", F.lit(None).cast(kind).alias("o")).alias("ord"), "e.part")
    inner = fragments.select(path, F.struct(F.lit(1).alias("r"), F.col("ord").alias("o")).alias("ord"), F.concat(F.lit("    "), "fragment", F.lit("\n")).alias("part"))
    return around.unionAll(inner)


def _index_parts(types: DataFrame, key: Column, last: Column, head: Column, lines: Column, name: str, title: str, about: str) -> DataFrame:
    """api/index/<name>.md as parts: sections by name (those marked ``last`` behind the others), each with its types by name.

    ``head``: the lines of a section, over its numbers n and enums; ``lines``: those of a type.
    """
    keyed = types.select(key.alias("k"), last.alias("z"), "type_name", "fqn", "is_enum", lines.alias("lines"))
    sections = keyed.groupBy("k", "z").agg(F.count("*").alias("n"), F.count_if("is_enum").alias("enums"))

    def parts(df: DataFrame, rank: Column, part: Column, first: bool = False) -> DataFrame:
        at = {"z": F.col("z"), "k": F.col("k"), "r": rank, "t": F.lit(""), "f": F.lit("")} if not first else {"z": F.lit(False), "k": F.lit(""), "r": rank, "t": F.lit(""), "f": F.lit("")}
        if "type_name" in df.columns:
            at |= {"t": F.col("type_name"), "f": F.col("fqn")}
        order = F.struct(F.lit(0 if first else 1).alias("s"), *[c.alias(n) for n, c in at.items()])
        return df.select(F.lit(f"api/index/{name}.md").alias("path"), order.alias("ord"), part.alias("part"))

    top = parts(types.sparkSession.range(1), F.lit(0), F.lit(f"# {title}\n\n{about}\n"), first=True)
    around = sections.select("*", F.posexplode(F.array(F.concat(F.lit("\n"), F.array_join(head, "\n")), F.lit("\n"))).alias("at", "part"))
    inner = parts(keyed, F.lit(1), F.concat(F.lit("\n"), F.array_join("lines", "\n")))
    return top.unionAll(parts(around, F.col("at") * 2, F.col("part"))).unionAll(inner)


def category_index_parts(types: DataFrame) -> DataFrame:
    """api/index/by_category.md: types by category, those without one last."""
    entry = render.index_entry(F.col("type_name"), F.col("is_enum"))
    about = F.when(F.col("category").isNotNull() & render.some(F.col("description")), F.concat(F.lit(" - "), text.truncate_description(F.col("description"))))
    lines = F.when(F.col("category").isNull(), F.array(F.concat(entry, F.lit("\n")))).otherwise(F.array_compact(F.array(entry, about, F.lit("\n"))))
    head = F.array(F.concat(F.lit("## "), "k", F.lit("\n")), F.concat(F.lit("**"), F.col("n").cast("string"), F.lit(" types**\n")))
    return _index_parts(types, F.coalesce("category", F.lit("Uncategorized")), F.col("category").isNull(), head, lines, "by_category", "API Types by Functional Category", "This index organizes all API types by their functional categories.")


def assembly_index_parts(types: DataFrame) -> DataFrame:
    """api/index/by_assembly.md: types by assembly, with the numbers of their members."""
    counts = F.when(F.col("is_enum"), " (enum)\n").otherwise(F.concat(F.lit(" ("), F.col("n_properties").cast("string"), F.lit(" props, "), F.col("n_methods").cast("string"), F.lit(" methods)\n")))
    lines = F.array(F.concat(render.index_entry(F.col("type_name"), F.col("is_enum")), counts))
    number = lambda label, n: F.concat(F.lit(f"- **{label}**: "), n.cast("string"), F.lit("\n"))
    head = F.array(
        F.concat(F.lit("## "), "k", F.lit("\n")), F.concat(F.lit("**"), F.col("n").cast("string"), F.lit(" types**\n")),
        number("Regular Types", F.col("n") - F.col("enums")), F.concat(number("Enumerations", F.col("enums")), F.lit("\n")),
    )
    return _index_parts(types, F.col("assembly"), F.lit(False), head, lines, "by_assembly", "API Types by Assembly", "This index organizes all API types by their .NET assembly.")


def statistics_page(types: DataFrame, largest: int = 20) -> DataFrame:
    """api/index/statistics.md: totals, the ``largest`` types by members, and the categories by their number of types."""
    c = F.col
    totals = types.agg(F.count("*").alias("n"), F.count_if("is_enum").alias("e"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("n_properties", "n_methods", "n_enum_members")])
    size = (c("n_properties") + c("n_methods")).alias("m")
    top = types.where(~c("is_enum")).select("type_name", "fqn", "n_properties", "n_methods", size).orderBy(F.desc("m"), "fqn").limit(largest)
    row = F.concat(F.lit("| ["), "type_name", F.lit("](../types/"), "type_name", F.lit("/_overview.md) | "), F.concat_ws(" | ", *[c(k).cast("string") for k in ("n_properties", "n_methods", "m")]), F.lit(" |\n"))
    rows = top.agg(F.array_sort(F.collect_list(F.struct((-c("m")).alias("o"), "fqn", row.alias("line"))))["line"].alias("largest"))
    counted = types.where("category is not null").groupBy("category").agg(F.count("*").alias("k"))
    line = F.concat(F.lit("| "), "category", F.lit(" | "), c("k").cast("string"), F.lit(" |\n"))
    by_category = counted.agg(F.array_sort(F.collect_list(F.struct((-c("k")).alias("o"), "category", line.alias("line"))))["line"].alias("categories"))
    item = lambda label, n: F.concat(F.lit(f"- **{label}**: "), n.cast("string"), F.lit("\n"))
    sub = lambda label, n: F.concat(F.lit(f"  - {label}: "), n.cast("string"), F.lit("\n"))
    page = F.array_join(
        F.concat(
            F.array(
                F.lit("# API Documentation Statistics\n"), F.lit("## Overview\n"), item("Total Types", c("n")), sub("Regular Types (Interfaces/Classes)", c("n") - c("e")), sub("Enumerations", c("e")),
                item("Total Properties", c("n_properties")), item("Total Methods", c("n_methods")), F.concat(item("Total Enumeration Members", c("n_enum_members")), F.lit("\n")),
                F.lit("## Largest Types by Member Count\n"), F.lit("| Type | Properties | Methods | Total |\n"), F.lit("|------|-----------|---------|-------|\n"),
            ),
            "largest",
            F.array(F.lit("\n"), F.lit("## Functional Categories by Type Count\n"), F.lit("| Category | Type Count |\n"), F.lit("|----------|------------|\n")),
            "categories",
            F.array(F.lit("\n")),
        ),
        "\n",
    )
    return totals.crossJoin(rows).crossJoin(by_category).select(F.lit("api/index/statistics.md").alias("path"), page.alias("content"))  # one row each


#: What the README of an export says after its first lines, for a reader that searches the tree.
README = """
## Structure

- `api/types/{type}/_overview.md`: a type; beside it one file for each property and method
- `api/enums/{type}/_overview.md`: an enumeration; beside it one file for each value
- `api/index/`: types by category, by assembly, and statistics
- `docs/`: the guide; `docs/examples/`: examples by category

## Front matter

Overviews have `name`, `assembly`, `namespace`, `category`, `is_enum`, `property_count`, `method_count`, `enum_member_count`;
members have `type`, `member`, `kind` (method, property, enum_member), `assembly`, `namespace`, `category`.
References to types and members stand in double brackets.
"""


def readme_file(types: DataFrame, examples: DataFrame, files: DataFrame | int, title: str) -> DataFrame:
    """README.md of an export, with the numbers of what is in it; ``files``: the other files, or their number."""
    c, number = F.col, lambda n: F.format_number(n, 0)
    totals = types.agg(F.count_if(~c("is_enum")).alias("t"), F.count_if("is_enum").alias("e"), F.coalesce(F.sum(F.when(~c("is_enum"), c("n_properties") + c("n_methods"))), F.lit(0)).alias("m"))
    ones = totals.crossJoin(examples.agg(F.count("*").alias("x")))  # one row each
    ones = ones.withColumn("f", F.lit(files).cast("long")) if isinstance(files, int) else ones.crossJoin(files.agg(F.count("*").alias("f")))
    counts = F.format_string("**Stats**: %s types, %s enums, %s members, %s examples (%s files)\n", number(c("t")), number(c("e")), number(c("m")), number(c("x")), number(c("f")))
    return ones.select(F.lit("README.md").alias("path"), F.concat(F.lit(f"# {title}\n\n"), counts, F.lit(README)).alias("content"))


def type_files(types: DataFrame, members: DataFrame) -> DataFrame:
    """The one-file-per-type form: a page with all members; members: fqn, ord, kind, member, description, signature."""
    c = F.col
    nested = members.groupBy("fqn").agg(F.array_sort(F.collect_list(F.struct("ord", "kind", c("member").alias("name"), "description", "signature"))).alias("members"))
    none = F.array().cast(nested.schema["members"].dataType.simpleString())
    joined = types.join(nested, "fqn", "left").withColumn("members", F.coalesce("members", none))
    page = render.type_page(*[c(x) for x in ("type_name", "assembly", "namespace", "category", "description", "remarks", "members")])
    return joined.select(F.concat(F.lit("types/"), text.api_file_name(c("type_name")), F.lit(".md")).alias("path"), page.alias("content"), c("fqn").alias("ord"))


def json_file(row: DataFrame, path: str) -> DataFrame:
    """A one-row DataFrame as a JSON file: the statistics of a run, or its manifest."""
    return row.select(F.lit(path).alias("path"), F.to_json(F.struct(*row.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("content"))


def crawl_manifest(site: urls.Site, source: str | None = None, obey_robots: bool = True, delay: float = 0.1) -> dict[str, str]:
    """Options of a crawl as its manifest states them; a crawl of listed pages names their source and leaves robots aside."""
    listed = {"source": source} if source is not None else {}
    return {"base_url": site.base, "boundary": site.root, "obey_robots": str(obey_robots and source is None).lower(), "download_delay": str(delay), **listed}


@dataclass(frozen=True)
class Export:
    """What a whole export is made of: the relations of ``api_files``, ``example_files`` and ``guide_files``."""

    types: DataFrame
    members: DataFrame
    enum_members: DataFrame
    examples: DataFrame
    example_categories: DataFrame
    guide: DataFrame
    title: str

    def trees(self) -> DataFrame:
        """path and content of API, examples, guide (below docs/) and statistics."""
        placed = self.guide.select(F.concat(F.lit("docs/"), "path").alias("path"), "content", F.col("ord").cast("string").alias("ord"))
        trees = [last_of_path(f) for f in (api_files(self.types, self.members, self.enum_members), example_files(self.examples, self.example_categories), placed)]
        return trees[0].unionByName(trees[1]).unionByName(trees[2]).unionByName(statistics_page(self.types))

    def parts(self) -> DataFrame:
        """The indexes as parts."""
        return category_index_parts(self.types).unionAll(assembly_index_parts(self.types))

    def listing(self) -> DataFrame:
        """path, n_bytes and content_md5 of all files, README included; they are made once, and their digests stored to be counted."""
        made = cut(filetree.listed(self.trees()).unionAll(filetree.digested(self.parts())))
        return made.unionAll(filetree.listed(readme_file(self.types, self.examples, made, self.title)))

    def write(self, root: str) -> int:
        """Write the export afresh below ``root``; the number of its files.  The README takes the others' number from the sink."""
        filetree.write_tree(self.trees(), root, mode="overwrite")
        n = filetree.files_written(root)
        filetree.write_parts(self.parts(), root)
        n += filetree.files_written(root)
        filetree.write_tree(readme_file(self.types, self.examples, n, self.title), root)
        return n + 1
