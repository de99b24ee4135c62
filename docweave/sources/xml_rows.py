"""Row XML as text: writers of the extraction files, with empty elements left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.render import escaped
from docweave.functions.text import cdata


def element(tag: str, value: Column, marked: bool = False, indent: int = 8) -> Column:
    """One element, null where its value is empty; ``marked`` wraps the value in CDATA."""
    body = cdata(value) if marked else escaped(value)
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{' ' * indent}<{tag}>"), body, F.lit(f"</{tag}>")))


def nested(tag: str, item: str, values: Column, fields: dict[str, str], indent: int = 8) -> Column:
    """A list of records as elements within ``tag``, null where the list is empty."""
    pad = " " * indent
    record = lambda v: F.concat(
        F.lit(f"{pad}    <{item}>\n"),
        F.array_join(F.array_compact(F.array(*[element(t, v[f], indent=indent + 8) for f, t in fields.items()])), "\n"),
        F.lit(f"\n{pad}    </{item}>"),
    )
    listed = F.array_join(F.transform(values, record), "\n")
    return F.when(F.size(values) > 0, F.concat(F.lit(f"{pad}<{tag}>\n"), listed, F.lit(f"\n{pad}</{tag}>")))


def xml_row(tag: str, *elements: Column) -> Column:
    """A row of a file: its elements that aren't null, four spaces a level."""
    return F.concat(F.lit(f"    <{tag}>\n"), F.array_join(F.array_compact(F.array(*elements)), "\n"), F.lit(f"\n    </{tag}>"))


def xml_file(root: str, rows: Column) -> Column:
    """A whole file from an array of rows in order."""
    return F.concat(F.lit(f'<?xml version="1.0" ?>\n<{root}>\n'), F.array_join(rows, "\n"), F.lit(f"\n</{root}>\n"))


def file_parts(rows: DataFrame, root: str, name: str, files: int = 1) -> DataFrame:
    """Files of rows as parts (path, ord, part) for the file sink; rows: key, ord (of any type that sorts), row.

    Rows lie in ``files`` files by a hash of their key, in the order of ``ord``; so
    rows of one key keep their order, and files are written and read in parallel.
    """
    number = F.pmod(F.xxhash64("key"), F.lit(files)).cast("int")
    kind = rows.schema["ord"].dataType
    path = lambda n: F.concat(F.lit(f"{name}-"), n.cast("string"), F.lit(".xml")).alias("path")
    edges = F.array(F.struct(F.lit(0).alias("r"), F.lit(f'<?xml version="1.0" ?>\n<{root}>\n').alias("part")), F.struct(F.lit(2).alias("r"), F.lit(f"</{root}>\n").alias("part")))
    around = rows.sparkSession.range(files).select(path(F.col("id")), F.explode(edges).alias("e")).select("path", F.struct("e.r", F.lit(None).cast(kind).alias("o")).alias("ord"), "e.part")
    inner = rows.select(path(number), F.struct(F.lit(1).alias("r"), F.col("ord").alias("o")).alias("ord"), F.concat("row", F.lit("\n")).alias("part"))
    return around.unionAll(inner)


def members_row(name: Column, assembly: Column, namespace: Column, properties: Column, methods: Column) -> Column:
    """A type with the names and links of its members; either list may be empty."""
    fields = {"name": "Name", "url": "Url"}
    return xml_row("Type", element("Name", name), element("Assembly", assembly), element("Namespace", namespace), nested("PublicProperties", "Property", properties, fields), nested("PublicMethods", "Method", methods, fields))


def type_row(name: Column, assembly: Column, namespace: Column, description: Column, examples: Column, remarks: Column) -> Column:
    fields = {"name": "Name", "language": "Language", "url": "Url"}
    return xml_row("Type", element("Name", name), element("Assembly", assembly), element("Namespace", namespace), element("Description", description, True), nested("Examples", "Example", examples, fields), element("Remarks", remarks, True))


def member_row(assembly: Column, type_name: Column, name: Column, signature: Column, description: Column, parameters: Column, returns: Column, remarks: Column) -> Column:
    fields = {"name": "Name", "description": "Description"}
    return xml_row(
        "Member", element("Assembly", assembly), element("Type", type_name), element("Name", name), element("Signature", signature), element("Description", description, True),
        nested("Parameters", "Parameter", parameters, fields), element("Returns", returns, True), element("Remarks", remarks, True),
    )


def enum_row(name: Column, assembly: Column, namespace: Column, members: Column) -> Column:
    return xml_row("Enum", element("Name", name), element("Assembly", assembly), element("Namespace", namespace), nested("Members", "Member", members, {"name": "Name", "description": "Description"}))


def example_row(url: Column, content: Column) -> Column:
    return xml_row("Example", element("Url", url), element("Content", content, True))
