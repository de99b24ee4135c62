"""Queries over files: row XML written, read and normalised again, and XML docs made from such files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import render
from docweave.operators import checks, export, merge
from docweave.operators.storage import cut, shared_folder
from docweave.plans.base import base
from docweave.plans.export import _XML_PROSE
from docweave.plans.facts import _NL, _XML_REMARKS, c
from docweave.plans.registry import query
from docweave.sources import filetree, readers, xml_rows
from docweave.streaming import resume

FILES = 4


def scanned(rows: DataFrame, kind: str, root: str, key: Column | str, row: Column, ord: Column | str = "ord") -> DataFrame:
    """Rows of one kind written as XML files to the shared folder, and the scan of these files."""
    spark = rows.sparkSession
    folder = f"{shared_folder(spark)}/xml-{uuid.uuid4().hex}"
    named = rows.select((F.col(key) if isinstance(key, str) else key).alias("key"), (F.col(ord) if isinstance(ord, str) else ord).alias("ord"), row.alias("row"))
    filetree.write_parts(xml_rows.file_parts(named, root, kind, FILES), folder)
    return readers.in_file_order(readers.read_xml(spark, f"{folder}/{kind}-*.xml", kind))


def members_file(spark, sf_dir) -> DataFrame:
    """A file of types with the names and links of their members."""
    listed = lambda k: F.transform(F.filter("m", lambda m: m["kind"] == k), lambda m: F.struct(m["member"].alias("name"), m["url"].alias("url")))
    types = base(spark, sf_dir, "members").groupBy("fqn").agg(*[F.max(x).alias(x) for x in ("type_name", "assembly", "namespace")], F.array_sort(F.collect_list(F.struct("ord", "kind", "member", "url"))).alias("m"))
    row = xml_rows.members_row(c("type_name"), c("assembly"), c("namespace"), listed("property"), listed("method"))
    return scanned(types, "members", "Types", "fqn", row, "fqn")


@query(
    "xml_members",
    "SELECT fqn, assembly, namespace, type_name, kind, CAST(row_number() OVER (PARTITION BY fqn, kind ORDER BY ord) - 1 AS INTEGER) AS pos, member, url FROM [members] m",
)
def xml_members(spark, sf_dir):
    """Members through their file: written, read, normalised."""
    return readers.members_rows(members_file(spark, sf_dir))


def types_file(spark, sf_dir) -> DataFrame:
    """A file of types with descriptions, remarks and their examples."""
    refs = base(spark, sf_dir, "example_refs").groupBy("fqn").agg(F.array_sort(F.collect_list(F.struct("ord", "name", "language", "url"))).alias("examples"))
    types = base(spark, sf_dir, "types").join(refs, "fqn", "left")
    examples = F.transform(F.coalesce("examples", F.array().cast(refs.schema["examples"].dataType)), lambda e: F.struct(e["name"].alias("name"), e["language"].alias("language"), e["url"].alias("url")))
    row = xml_rows.type_row(c("type_name"), c("assembly"), c("namespace"), c("description"), examples, c("remarks"))
    return scanned(types, "types", "Types", "fqn", row)


@query(
    "xml_types",
    """SELECT t.fqn, assembly, namespace, type_name, description, remarks, coalesce(e.examples, '') AS examples FROM [types] t
       LEFT JOIN (SELECT fqn, string_agg(name || '~' || language || '~' || url, '|' ORDER BY ord) AS examples FROM [example_refs] r GROUP BY fqn) e ON e.fqn = t.fqn""",
)
def xml_types(spark, sf_dir):
    """Types through their file."""
    listed = F.array_join(F.transform("examples", lambda e: F.concat_ws("~", e["Name"], e["Language"], e["Url"])), "|")
    return readers.types_rows(types_file(spark, sf_dir)).withColumn("examples", listed)


def details_file(spark, sf_dir) -> DataFrame:
    """A file of member details; methods have parameters, one of them without a description."""
    about = F.array(
        F.struct(F.lit("a").alias("name"), F.concat(F.lit("First of <see cref=\"T:"), "fqn", F.lit("\">"), "member", F.lit("</see>")).alias("description")),
        F.struct(F.lit("b").alias("name"), F.lit("x & y < z").alias("description")), F.struct(F.lit("c").alias("name"), F.lit("").alias("description")),
    )
    rows = base(spark, sf_dir, "details").withColumn("parameters", F.when(c("params") != "", about).otherwise(F.array().cast("array<struct<name:string,description:string>>")))
    assembly = F.regexp_extract("fqn", r"^(\w+\.\w+)", 1)
    row = xml_rows.member_row(assembly, c("fqn"), c("member"), c("signature"), c("description"), c("parameters"), c("returns"), c("remarks"))
    return scanned(rows, "details", "Members", "fqn", row)


_PARAM = "'First of <see cref=\"T:' || {t}fqn || '\">' || {t}member || '</see>'"


@query(
    "xml_details",
    f"SELECT fqn, member, description, signature, CASE WHEN params = '' THEN '' ELSE 'a=' || {_PARAM.format(t='')} || '|b=x & y < z|c=' END AS params, returns, remarks FROM [details] d",
)
def xml_details(spark, sf_dir):
    """Details through their file."""
    listed = F.array_join(F.transform("params", lambda p: F.concat(p["name"], F.lit("="), p["description"])), "|")
    return readers.details_rows(details_file(spark, sf_dir)).withColumn("params", listed).drop("ord")


def enums_file(spark, sf_dir) -> DataFrame:
    """A file of enumerations with their values."""
    enums = base(spark, sf_dir, "enums").groupBy("fqn").agg(*[F.max(x).alias(x) for x in ("type_name", "assembly", "namespace")], F.array_sort(F.collect_list(F.struct("ord", c("enum_member").alias("name"), "description"))).alias("m"))
    row = xml_rows.enum_row(c("type_name"), c("assembly"), c("namespace"), F.transform("m", lambda m: F.struct(m["name"].alias("name"), m["description"].alias("description"))))
    return scanned(enums, "enums", "EnumMembers", "fqn", row, "fqn")


@query("xml_enums", "SELECT fqn, assembly, namespace, type_name, CAST(row_number() OVER (PARTITION BY fqn ORDER BY ord) - 1 AS INTEGER) AS pos, enum_member AS member, description FROM [enums] e")
def xml_enums(spark, sf_dir):
    """Enumerations through their file."""
    return readers.enums_rows(enums_file(spark, sf_dir))


def examples_file(spark, sf_dir) -> DataFrame:
    """A file of examples; every URL stands twice, with and without blanks around it, the later with its content."""
    rows = base(spark, sf_dir, "examples")
    old = rows.select("url", "ord", F.lit(0).alias("turn"), F.concat(F.lit(" "), "url", F.lit(" ")).alias("shown"), F.lit("old").alias("content"))
    twice = old.unionAll(rows.select("url", "ord", F.lit(1), c("url"), "content"))
    return scanned(twice, "examples", "Examples", "url", xml_rows.example_row(c("shown"), c("content")), F.struct("ord", "turn"))


@query("xml_examples", "SELECT url, md5(trim(content, chr(9) || chr(10) || chr(13) || ' ')) AS content_md5 FROM [examples] e")
def xml_examples(spark, sf_dir):
    """Examples through their file; the last of a URL counts."""
    return readers.examples_rows(examples_file(spark, sf_dir)).select("url", F.md5(F.regexp_replace("content", r"^[\t\n\r ]+|[\t\n\r ]+$", "")).alias("content_md5"))


_LAST = """(SELECT fqn, member, arg_max(description, ord) FILTER (WHERE description <> '') AS description, arg_max(params, ord) FILTER (WHERE params <> '') AS params,
  arg_max(returns, ord) FILTER (WHERE returns <> '') AS returns, arg_max(remarks, ord) FILTER (WHERE remarks <> '') AS remarks FROM [details] d GROUP BY fqn, member)"""
_KIND = "(SELECT m.* REPLACE (min(size) OVER (PARTITION BY fqn, member, url) AS size), (kind = 'property') = bool_or(kind = 'property') OVER (PARTITION BY fqn, member) AS t FROM [members] m)"
_FULL_MEMBERS = f"""(SELECT m.ord, m.assembly, m.type_name, m.fqn, m.member, m.kind, size, row_number() OVER (PARTITION BY m.fqn, m.kind ORDER BY m.ord) - 1 AS pos,
  coalesce(CASE WHEN t THEN l.description END, '') AS description, coalesce(CASE WHEN t THEN l.params END, '') AS params,
  coalesce(CASE WHEN t THEN l.returns END, '') AS returns, coalesce(CASE WHEN t THEN l.remarks END, '') AS remarks
  FROM {_KIND} m LEFT JOIN {_LAST} l ON m.fqn = l.fqn AND m.member = l.member)"""
_AVAILABLE = "CASE WHEN size % 6 = 0 THEN '<availability>Release &lt; ' || CAST(size AS STRING) || '</availability>' ELSE '' END"
_MEMBER = f"""'<member name="' || CASE WHEN kind = 'property' THEN 'P:' ELSE 'M:' END || fqn || '.' || member || '"><summary>'
  || CASE WHEN description <> '' THEN description WHEN kind = 'property' THEN 'Gets or sets ' || member || '.' ELSE member || ' method.' END || '</summary>'
  || CASE WHEN params = '' THEN '' ELSE '<param name="a">' || {_PARAM.format(t='')} || '</param><param name="b">x &amp; y &lt; z</param><param name="c"></param>' END
  || CASE WHEN returns = '' THEN '' WHEN kind = 'property' THEN '<value>' || returns || '</value>' ELSE '<returns>' || returns || '</returns>' END
  || CASE WHEN remarks = '' THEN '' ELSE '<remarks>' || {_NL} || {_XML_REMARKS} || {_NL} || '</remarks>' END || {_AVAILABLE} || '</member>'"""
_DESCRIBED = "(SELECT fqn, max(nullif(description, '')) AS description, max(nullif(remarks, '')) AS remarks FROM [types] t GROUP BY fqn)"
_KNOWN = """(SELECT fqn, min(assembly) AS assembly, min(type_name) AS type_name FROM (SELECT fqn, assembly, type_name FROM [members] m UNION ALL SELECT fqn, assembly, type_name FROM [types] t UNION ALL SELECT fqn, assembly, type_name FROM [enums] e) GROUP BY fqn)"""
_TYPE = "'<member name=\"T:' || k.fqn || '\">' || " + _XML_PROSE.format(x="d.description", t="summary", b="''") + " || " + _XML_PROSE.format(x="d.remarks", t="remarks", b=_NL) + " || '</member>'"
_FROM_XML = f"""(SELECT k.assembly, k.type_name, k.fqn, 0 AS r, 0 AS o, {_TYPE} AS fragment FROM {_KNOWN} k LEFT JOIN {_DESCRIBED} d ON d.fqn = k.fqn
  UNION ALL SELECT assembly, type_name, fqn, CASE WHEN kind = 'property' THEN 1 ELSE 2 END, pos, {_MEMBER} FROM {_FULL_MEMBERS} m
  UNION ALL SELECT assembly, type_name, fqn, 3, row_number() OVER (PARTITION BY fqn ORDER BY ord) - 1, '<member name="F:' || fqn || '.' || enum_member || '"><summary>' || CASE WHEN description <> '' THEN description ELSE enum_member END || '</summary></member>' FROM [enums] e)"""


@query(
    "xmldoc_from_xml",
    f"""SELECT assembly || '.xml' AS path, CAST(count(*) FILTER (WHERE r > 0) AS BIGINT) AS n_members, md5('<?xml version="1.0" ?>' || {_NL} || '<doc>' || {_NL} || '  <assembly>' || {_NL} || '    <name>' || assembly || '</name>' || {_NL} || '  </assembly>' || {_NL} || '  <members>' || {_NL}
        || string_agg('    ' || fragment, {_NL} ORDER BY type_name, fqn, r, o) || {_NL} || '  </members>' || {_NL} || '</doc>' || {_NL}) AS content_md5 FROM {_FROM_XML} f GROUP BY assembly""",
)
def xmldoc_from_xml(spark, sf_dir):
    """XML docs made from the extraction files: scans, normalisers, merges, fragments with parameters and availability, whole files."""
    # Each file is parsed once, though several merges read it.
    members, enums = cut(readers.members_rows(members_file(spark, sf_dir))), cut(readers.enums_rows(enums_file(spark, sf_dir)))
    types, details = readers.types_rows(types_file(spark, sf_dir)), readers.details_rows(details_file(spark, sf_dir))
    merged = merge.merge_types(members.withColumn("ord", c("pos")), types.withColumn("ord", F.lit(0)), enums.withColumn("ord", c("pos")))
    keyed = merged.select("fqn", "assembly", "type_name")
    sizes = base(spark, sf_dir, "members").groupBy("fqn", "member", "url").agg(F.min("size").alias("size"))
    full = merge.enrich_members(members.withColumn("ord", F.struct("pos", "url")), details, ("description", "params", "returns", "remarks")).select("*", "ord.*").join(sizes, ["fqn", "member", "url"])
    available = F.when(c("size") % 6 == 0, F.concat(F.lit("Release < "), c("size").cast("string")))
    doc_id = F.concat(F.when(c("kind") == "property", "P:").otherwise("M:"), "fqn", F.lit("."), "member")
    none = F.array().cast("array<struct<name:string,description:string>>")
    member = render.xml_member(doc_id, c("kind"), c("member"), c("description"), c("params"), c("returns"), c("remarks"), available)
    value = render.xml_member(F.concat(F.lit("F:"), "fqn", F.lit("."), "member"), F.lit("field"), c("member"), c("description"), none, F.lit(""), F.lit(""))

    def fragment(rows: DataFrame, rank: Column, at: Column, text: Column) -> DataFrame:
        return rows.select("assembly", F.struct("type_name", "fqn", rank.alias("r"), at.cast("long").alias("o")).alias("ord"), text.alias("fragment"))

    of_type = fragment(merged, F.lit(0), F.lit(0), render.xml_type(F.concat(F.lit("T:"), "fqn"), c("description"), c("remarks"), F.array().cast("array<string>")))
    of_member = fragment(full.join(keyed, "fqn"), F.when(c("kind") == "property", 1).otherwise(2), c("pos"), member)
    of_value = fragment(enums.where("member is not null").select("fqn", "pos", "member", "description").join(keyed, "fqn"), F.lit(3), c("pos"), value)
    fragments = of_type.unionAll(of_member).unionAll(of_value)
    counts = fragments.groupBy(F.concat("assembly", F.lit(".xml")).alias("path")).agg(F.count_if(c("ord.r") > 0).cast("long").alias("n_members"))
    return filetree.digested(export.assembly_doc_parts(fragments)).select("path", "content_md5").join(counts, "path")


# --- page files and the crawl log
@query(
    "page_file_scans",
    """WITH f AS (SELECT CASE WHEN ord % 2 = 0 THEN 'one/' || file_name ELSE 'two/deep/' || file_name END AS path, file_name, CAST(max(ord) AS STRING) AS html FROM [files] t GROUP BY 1, 2)
       SELECT 'html' AS scan, file_name, html, path FROM f WHERE ends_with(file_name, '.html')
       UNION ALL SELECT 'members', file_name, html, path FROM f WHERE regexp_matches(file_name, '_members_.*\\.html$')
       UNION ALL SELECT 'one level', file_name, html, path FROM f WHERE ends_with(file_name, '.html') AND starts_with(path, 'one/')
       UNION ALL SELECT 'examples', file_name, html, path FROM f WHERE ends_with(file_name, '.htm')
       UNION ALL SELECT 'examples and twins', file_name, html, path FROM f""",
)
def page_file_scans(spark, sf_dir):
    """A tree of page files, one a row, and each of the scans over it."""
    folder = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    path = F.when(c("ord") % 2 == 0, F.concat(F.lit("one/"), "file_name")).otherwise(F.concat(F.lit("two/deep/"), "file_name"))
    filetree.write_tree(base(spark, sf_dir, "files").select(path.alias("path"), c("ord").cast("string").alias("content"), "ord"), folder, mode="overwrite", order="ord")
    scans = {
        "html": readers.read_pages(spark, folder), "members": readers.read_members_pages(spark, folder), "one level": readers.read_one_level(spark, folder),
        "examples": readers.read_example_pages(spark, folder), "examples and twins": readers.read_example_pages(spark, folder, htm_only=False),
    }
    below = F.regexp_extract(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), r"/pages-[0-9a-f]+/(.*)$", 1)
    found = [df.select(F.lit(name).alias("scan"), "file_name", "html", below.alias("path")) for name, df in scans.items()]
    return checks.united(found)


@query(
    "crawl_log_stream",
    """WITH l AS (SELECT url, error FROM [crawl_log] t),
         good AS (SELECT DISTINCT url, '<html><title> ' || url || ' </title></html>' AS content FROM l WHERE error IS NULL)
       SELECT 'log' AS kind, url, sha256(content) AS mark, url AS title, CAST(strlen(content) AS BIGINT) AS n FROM good
       UNION ALL SELECT 'error', url, error, NULL, count(*) FROM l WHERE error IS NOT NULL GROUP BY url, error""",
)
def crawl_log_stream(spark, sf_dir):
    """Pages land in two turns; the second run has lost the first one's checkpoint and goes on from its log. Errors land once."""
    folder = f"{shared_folder(spark)}/crawl-{uuid.uuid4().hex}"
    rows = base(spark, sf_dir, "crawl_log").select("ord", "url", c("status").alias("status_code"), F.when(c("error").isNull(), F.concat(F.lit("<html><title> "), "url", F.lit(" </title></html>"))).alias("content"), "error")
    for turn in range(2):
        landing = f"{folder}/landing-{turn}"
        rows.where(c("ord") % 2 == turn).drop("ord").write.json(landing)
        for running in resume.start_log(resume.landed_pages(spark, landing), f"{folder}/log", f"{folder}/state-{turn}", f"{folder}/errors"):
            running.awaitTermination()
    log = readers.read_crawl_log(spark, f"{folder}/log").select(F.lit("log").alias("kind"), "url", c("content_hash").alias("mark"), "title", c("content_length").alias("n"))
    errors = spark.read.schema(readers.CRAWL_ERRORS).json(f"{folder}/errors").groupBy("url", "error").agg(F.count("*").alias("n"))
    return log.unionAll(errors.select(F.lit("error").alias("kind"), "url", c("error").alias("mark"), F.lit(None).cast("string").alias("title"), "n"))
