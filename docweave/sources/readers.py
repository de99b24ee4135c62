"""Scans of a documentation corpus: page files, row XML, TOC files, crawl logs, page snapshots.

Schemas are declared, never inferred; every scan carries the source path, so
that order can be made explicit where it matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from docweave.functions.text import clean_text, utrim
from docweave.sources import walk

CRAWL_LOG = "url string, file_path string, content_hash string, content_length bigint, status_code int, title string"
CRAWL_ERRORS = "url string, error string"
TOC_NODE = "id string, parentId string, name string, url string, isLeaf boolean"
TOC_FILE = f"{TOC_NODE}, children array<struct<{TOC_NODE.replace(' string', ':string').replace(' boolean', ':boolean')}>>"
_LINK = "struct<Name:string,Url:string>"
XML_ROWS = {
    # What the files hold: row tag and schema.
    "members": ("Type", f"Name string, Assembly string, Namespace string, PublicProperties struct<Property:array<{_LINK}>>, PublicMethods struct<Method:array<{_LINK}>>"),
    "types": ("Type", "Name string, Assembly string, Namespace string, Description string, Remarks string, Examples struct<Example:array<struct<Name:string,Language:string,Url:string>>>"),
    "details": ("Member", "Assembly string, Type string, Name string, Signature string, Description string, Parameters struct<Parameter:array<struct<Name:string,Description:string>>>, Returns string, Remarks string"),
    "enums": ("Enum", "Name string, Assembly string, Namespace string, Members struct<Member:array<struct<Name:string,Description:string>>>"),
    "examples": ("Example", "Url string, Content string"),
}


def _pages(spark: SparkSession, path: str, pattern: str, first: int, last: int | None) -> DataFrame:
    """Pages in folders ``first`` to ``last`` levels below a path."""
    roots = walk.folders(spark, path)
    if roots:
        return walk.files(spark, roots, pattern, first, last)
    # Files named one by one, missing paths, and file systems that only Spark reaches: the driver lists all.
    reader = spark.read.option("pathGlobFilter", pattern)
    if last is None:
        reader = reader.option("recursiveFileLookup", "true")
    files = reader.text(path.rstrip("/") + "/*/" * first if first else path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("html"))


def read_pages(spark: SparkSession, path: str, pattern: str = "*.html", recursive: bool = True) -> DataFrame:
    """One row for each page file: path, file_name, html. Predicates on names belong before any parser."""
    return _pages(spark, path, pattern, 0, None if recursive else 0)


def read_members_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_pages(spark, path, "*_members_*.html")


def read_one_level(spark: SparkSession, path: str) -> DataFrame:
    """Pages exactly one directory deep."""
    return _pages(spark, path, "*.html", 1, 1)


def read_example_pages(spark: SparkSession, path: str, htm_only: bool = True) -> DataFrame:
    """Example pages; saved .html twins only on request.  Their order is that of ``path``; contents aren't sorted."""
    return read_pages(spark, path, "*.htm" if htm_only else "*.{htm,html}")


def relative_key(path: Column, root: str) -> Column:
    """Path below ``root`` with forward slashes: the key of an example."""
    return F.replace(F.regexp_replace(path, "^.*" + root.rstrip("/").rsplit("/", 1)[-1] + "/", ""), F.lit("\\"), F.lit("/"))


def read_xml(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Row XML of one kind with its declared schema; malformed rows keep their text in ``_corrupt_record``."""
    tag, schema = XML_ROWS[kind]
    options = {"rowTag": tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return spark.read.format("xml").options(**options).schema(f"{schema}, _corrupt_record string").load(path)


def in_file_order(rows: DataFrame) -> DataFrame:
    """Rows of a scan with ``ord``: by file name, and as they stand in a file (which one task reads)."""
    return rows.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row")).alias("ord"))


def members_rows(members: DataFrame) -> DataFrame:
    """ord, fqn, assembly, namespace, type_name, kind, member, url of a members scan; rows lacking a name part go."""
    known = members.where("Name <> '' and Assembly <> '' and Namespace <> ''")
    ids = [F.concat_ws(".", "Namespace", "Name").alias("fqn"), F.col("Assembly").alias("assembly"), F.col("Namespace").alias("namespace"), F.col("Name").alias("type_name")]
    parts = [known.select(*ids, F.lit(k).alias("kind"), F.posexplode(f"{outer}.{inner}").alias("pos", "m")) for k, outer, inner in (("property", "PublicProperties", "Property"), ("method", "PublicMethods", "Method"))]
    return parts[0].unionAll(parts[1]).select("fqn", "assembly", "namespace", "type_name", "kind", "pos", F.col("m.Name").alias("member"), F.col("m.Url").alias("url"))


def _named(rows: DataFrame, *names: str) -> DataFrame:
    """Rows that have all of these parts of their name."""
    return rows.where(" and ".join(f"trim(coalesce({n}, '')) <> ''" for n in names))


def types_rows(types: DataFrame) -> DataFrame:
    """fqn, assembly, namespace, type_name, description, remarks, examples of a types scan; examples lacking a part go."""
    listed = F.filter(F.coalesce("Examples.Example", F.array().cast("array<struct<Name:string,Language:string,Url:string>>")), lambda e: e["Name"].isNotNull() & e["Language"].isNotNull() & e["Url"].isNotNull())
    return _named(types, "Name", "Namespace").select(
        F.concat_ws(".", F.trim("Namespace"), F.trim("Name")).alias("fqn"), F.trim("Assembly").alias("assembly"), F.trim("Namespace").alias("namespace"), F.trim("Name").alias("type_name"),
        clean_text(F.col("Description")).alias("description"), clean_text(F.col("Remarks")).alias("remarks"), listed.alias("examples"),
    )


def details_rows(details: DataFrame) -> DataFrame:
    """fqn, member, description, signature, params, returns, remarks of a details scan.

    Rows lacking the type, its namespace or the member go; params are (name,
    description) in order, those without a name left out.
    """
    params = F.transform(F.coalesce("Parameters.Parameter", F.array().cast("array<struct<Name:string,Description:string>>")), lambda p: F.struct(utrim(F.coalesce(p["Name"], F.lit(""))).alias("name"), clean_text(p["Description"]).alias("description")))
    kept = ["ord"] if "ord" in details.columns else []
    return _named(details, "Type", "Name").where(F.trim("Type").contains(".")).select(
        *kept, F.trim("Type").alias("fqn"), F.trim("Name").alias("member"), clean_text(F.col("Description")).alias("description"), utrim(F.coalesce("Signature", F.lit(""))).alias("signature"),
        F.filter(params, lambda p: p["name"] != "").alias("params"), clean_text(F.col("Returns")).alias("returns"), clean_text(F.col("Remarks")).alias("remarks"),
    )


def enums_rows(enums: DataFrame) -> DataFrame:
    """fqn, assembly, namespace, type_name, pos, member, description of an enumerations scan; an enumeration without members is one row with a null member."""
    named = _named(enums, "Name", "Assembly", "Namespace").select(
        F.concat_ws(".", F.trim("Namespace"), F.trim("Name")).alias("fqn"), F.trim("Assembly").alias("assembly"), F.trim("Namespace").alias("namespace"), F.trim("Name").alias("type_name"),
        F.filter(F.coalesce("Members.Member", F.array().cast("array<struct<Name:string,Description:string>>")), lambda m: F.trim(F.coalesce(m["Name"], F.lit(""))) != "").alias("m"),
    )
    return named.select("fqn", "assembly", "namespace", "type_name", F.posexplode_outer("m").alias("pos", "m")).select(
        "fqn", "assembly", "namespace", "type_name", "pos", F.trim("m.Name").alias("member"), F.when(F.col("m").isNotNull(), clean_text(F.col("m.Description"))).alias("description")
    )


def examples_rows(examples: DataFrame, order: str = "ord") -> DataFrame:
    """url and content of an examples scan; of rows with one URL the last by ``order``."""
    rows = examples.where("Url is not null and Content is not null").select(F.trim("Url").alias("url"), "Content", order)
    return rows.groupBy("url").agg(F.max_by("Content", order).alias("content"))


def example_urls(types: DataFrame) -> DataFrame:
    """Distinct, trimmed example URLs of a types scan."""
    return types.select(F.explode("Examples.Example").alias("e")).select(F.trim("e.Url").alias("url")).where("url <> ''").distinct()


def read_toc(spark: SparkSession, path: str) -> DataFrame:
    """Nodes with their direct children, in file-name order."""
    files = spark.read.schema(TOC_FILE).option("multiLine", "true").option("pathGlobFilter", "expandToc_id_*.json").json(path)
    named = files.withColumn("_file", F.col("_metadata.file_name"))
    order = named.select("_file").distinct().withColumn("ord", F.expr("row_number() over (order by _file)").cast("long"))  # one row a TOC file
    return named.join(order, "_file").drop("_file")


def read_crawl_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CRAWL_LOG).json(path)


def read_stats(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").json(path)


class _Part(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__(first)
        self.first, self.last = first, last


class SnapshotSource(DataSource):
    """``format("page_snapshot")``: fetches URLs from a folder of saved pages in place of the network.

    Options: path (the folder), urls (lines), partitions, domain (others are error
    rows), html_only (other content types are error rows), retries of reads that
    fail for a passing reason.  Each URL gives one row; the interface is what a
    live fetcher would have.
    """

    @classmethod
    def name(cls) -> str:
        return "page_snapshot"

    def schema(self) -> str:
        return "url string, status_code int, content_type string, content string, error string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SnapshotReader(self.options)


class _SnapshotReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.urls = [u for u in options.get("urls", "").splitlines() if u]
        self.parts = int(options.get("partitions", "4"))
        self.domain, self.html_only = options.get("domain", ""), options.get("html_only", "false").lower() == "true"
        self.retries = int(options.get("retries", "3"))

    def partitions(self) -> list[_Part]:
        step = max(1, -(-len(self.urls) // self.parts))
        return [_Part(i, min(i + step, len(self.urls))) for i in range(0, len(self.urls), step)]

    def read(self, partition: _Part):
        for url in self.urls[partition.first : partition.last]:
            yield self.fetched(url)

    def fetched(self, url: str) -> tuple:
        """(url, status, content type, content, error) of one page."""
        from mimetypes import guess_type
        from pathlib import Path
        from urllib.parse import urlparse

        parsed = urlparse(url)
        host = (parsed.hostname or "").lower()
        if self.domain and host != self.domain and not host.endswith("." + self.domain):
            return url, None, None, None, "domain not allowed"
        kind = guess_type(parsed.path)[0] or "text/html"
        if self.html_only and kind != "text/html":
            return url, 200, kind, None, "not HTML"
        for tried in range(self.retries + 1):
            try:
                return url, 200, kind, Path(self.root, parsed.path.strip("/")).read_text(encoding="utf-8"), None
            except FileNotFoundError as failed:
                return url, 404, None, None, type(failed).__name__
            except OSError as failed:
                if tried == self.retries:
                    return url, 503, None, None, type(failed).__name__
        return url, None, None, None, "not tried"
