"""Column expressions over page file names: identities, kinds, languages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.columns import last, let

#: Beginnings of the file names of pages that describe no type.
SPECIAL_PAGES = ("functionalcategories", "releasenotes", "help_list")


def _identity(assembly: Column, dotted: Column) -> Column:
    """(assembly, namespace, type) from an assembly and a dotted name; without a dot the assembly is the namespace."""
    has_dot = dotted.contains(".")
    namespace = F.when(has_dot, F.regexp_replace(dotted, r"\.[^.]*$", "")).otherwise(assembly)
    return F.struct(assembly.alias("assembly"), namespace.alias("namespace"), last(F.split(dotted, r"\.")).alias("type_name"))


def file_identity(name: Column) -> Column:
    """(assembly, namespace, type_name) of a type or member page; nulls without a ``~``."""
    part = F.split_part(name, F.lit("~"), F.lit(2))
    dotted = F.when(part.contains("_"), F.substring_index(part, "_", 1)).otherwise(F.replace(part, F.lit(".html"), F.lit("")))
    return F.when(name.contains("~"), let(dotted, lambda d: _identity(F.split_part(name, F.lit("~"), F.lit(1)), d)))


def members_file_identity(name: Column) -> Column:
    """(assembly, namespace, type_name) of a members page: the name ends at ``_members_``."""
    dotted = F.substring_index(F.split_part(name, F.lit("~"), F.lit(2)), "_members_", 1)
    return F.when(name.contains("~"), let(dotted, lambda d: _identity(F.split_part(name, F.lit("~"), F.lit(1)), d)))


def enum_file_identity(name: Column) -> Column:
    """(assembly, namespace, type_name) of an enumeration page; extensions and hashes may be doubled."""

    def of(stem: Column) -> Column:
        rest = F.substring(stem, F.locate("~", stem) + 1, F.length(stem))
        plain = F.struct(F.lit("").alias("assembly"), F.lit("").alias("namespace"), stem.alias("type_name"))
        return F.when(stem.contains("~"), _identity(F.split_part(stem, F.lit("~"), F.lit(1)), rest)).otherwise(plain)

    bare = F.regexp_replace(F.regexp_replace(name, r"(\.(html|htmll|htm))+$", ""), r"(_[0-9a-f]{8})+$", "")
    return let(bare, of)


def member_name(name: Column) -> Column:
    return F.replace(F.split_part(name, F.lit("~"), F.lit(3)), F.lit(".html"), F.lit(""))


def _tildes(name: Column) -> Column:
    return F.length(name) - F.length(F.replace(name, F.lit("~"), F.lit("")))


def _special(lowered: Column) -> Column:
    out = F.lit(False)
    for start in SPECIAL_PAGES:
        out = out | lowered.startswith(start)
    return out


def is_type_file(name: Column) -> Column:
    low = F.lower(name)
    return ~low.contains("_members_") & ~low.contains("_namespace_") & ~_special(low) & low.contains(".html") & (_tildes(name) == 1)


def is_member_file(name: Column) -> Column:
    low = F.lower(name)
    return ~low.contains("_members_") & ~_special(low) & low.contains(".html") & (_tildes(name) == 2)


def is_enum_file(name: Column) -> Column:
    low = F.lower(name)
    plain = ~low.contains("_members_") & ~low.contains("_namespace_") & ~_special(low)
    return plain & name.contains("~") & enum_file_identity(name)["type_name"].endswith("_e")


def infer_language(name: Column) -> Column:
    """Language of an example from its file name."""
    low = F.lower(name)
    return (
        F.when(low.contains("vbnet") | low.contains("_net.htm"), "VB.NET")
        .when(low.contains("_vb.htm") | low.contains("vba"), "VBA")
        .when(low.contains("csharp") | low.contains("_cs.htm"), "C#")
        .when(low.contains("cpp"), "C++")
        .otherwise("Unknown")
    )


def detect_language(url: Column, code: Column) -> Column:
    """Language of an example's code from its URL, else from key words."""
    low = F.lower(url)
    return (
        F.when(low.contains("csharp") | low.contains("_cs."), "C#")
        .when(low.contains("vba"), "VBA")
        .when(low.contains("vbnet") | low.contains("_vb."), "VB.NET")
        .when(low.contains("cpp"), "C++")
        .when(low.contains("python") | low.contains("_py."), "Python")
        .when(code.contains("using System") | code.contains("namespace "), "C#")
        .when(code.contains("Dim ") & code.contains("As "), "VBA")
        .when(code.contains("#include"), "C++")
        .otherwise("text")
    )


def example_link_parts(text: Column, href: Column) -> Column:
    """(name, language) of an example link: "Name (Language)", else the language of the file name."""
    from docweave.functions.text import utrim

    pattern = r"(?s)^(.+?)\s*\(([^)]+)\)\s*$"
    named = text.rlike(pattern)
    return F.struct(
        F.when(named, utrim(F.regexp_extract(text, pattern, 1))).otherwise(utrim(text)).alias("name"),
        F.when(named, utrim(F.regexp_extract(text, pattern, 2))).otherwise(infer_language(href)).alias("language"),
    )


def member_title_parts(title: Column) -> Column:
    """(member, kind, type_name) of a page title "Member Method (Type)"; nulls where it isn't one."""
    pattern = r"^(.+?)\s+(Method|Property)\s+\((.+?)\)"
    part = lambda i: F.regexp_extract(title, pattern, i)
    return F.when(title.rlike(pattern), F.struct(part(1).alias("member"), part(2).alias("kind"), part(3).alias("type_name")))


def type_title(title: Column) -> Column:
    """Type name of a page title: the kind goes wherever it stands."""
    from docweave.functions.text import utrim

    out = title
    for kind in (" Interface", " Class", " Enumeration"):
        out = F.replace(out, F.lit(kind), F.lit(""))
    return utrim(out)
