"""Markdown and XML-doc pages as column expressions: one string a row, omitting what is empty."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.text import cdata, clean_text, simplify_see


def lines(*parts: Column | str | None) -> Column:
    """The parts that aren't null, one a line."""
    return F.array_join(F.array_compact(F.array(*[F.lit(p) if isinstance(p, str) else p for p in parts if p is not None])), "\n")


def shown_if(condition: Column, *parts: Column | str) -> Column:
    return F.when(condition, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))


def some(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def prose(value: Column) -> Column:
    return simplify_see(clean_text(value))


def front_matter(fields: dict[str, Column], category: Column) -> list[Column]:
    rows = [F.lit("---")] + [F.concat(F.lit(f"{k}: "), v.cast("string")) for k, v in fields.items()]
    return [*rows, shown_if(some(category), "category: ", category)]


def section(title: str, value: Column) -> list[Column]:
    return [shown_if(some(value), f"{title}\n"), shown_if(some(value), prose(value), "\n")]


def member_page(kind: Column, type_name: Column, member: Column, assembly: Column, namespace: Column, category: Column, description: Column, signature: Column, params: Column, returns: Column, remarks: Column) -> Column:
    """Page of a property or method; ``params`` is an array of (name, description)."""
    listed = F.transform(params, lambda p: F.concat(F.lit("- **"), p["name"], F.lit("**: "), F.when(some(p["description"]), prose(p["description"])).otherwise("No description"), F.lit("\n")))
    return lines(
        *front_matter({"type": type_name, "member": member, "kind": kind, "assembly": assembly, "namespace": namespace}, category),
        "---\n",
        F.concat(F.lit("# "), type_name, F.lit("."), member, F.lit("\n")),
        shown_if(some(description), prose(description), "\n"),
        shown_if(some(signature), "**Signature**: `", signature, "`\n"),
        F.when(F.size(params) > 0, F.concat(F.lit("## Parameters\n\n"), F.array_join(listed, "\n"), F.lit("\n"))),
        *section("## Returns", returns),
        *section("## Remarks", remarks),
    )


def enum_page(type_name: Column, member: Column, assembly: Column, namespace: Column, category: Column, description: Column) -> Column:
    return lines(
        *front_matter({"type": type_name, "member": member, "kind": F.lit("enum_member"), "assembly": assembly, "namespace": namespace}, category),
        "---\n",
        F.concat(F.lit("# "), type_name, F.lit("."), member, F.lit("\n")),
        shown_if(some(description), prose(description), "\n"),
    )


def overview_page(type_name: Column, assembly: Column, namespace: Column, category: Column, description: Column, remarks: Column, n_properties: Column, n_methods: Column, n_enum: Column) -> Column:
    """Overview of a type: metadata, description, remarks, member counts."""
    head = front_matter({"name": type_name, "assembly": assembly, "namespace": namespace}, category)
    is_enum = F.when(n_enum > 0, "True").otherwise("False")
    counts = {"is_enum": is_enum, "property_count": n_properties, "method_count": n_methods, "enum_member_count": n_enum}
    named = ((n_properties, "Properties"), (n_methods, "Methods"), (n_enum, "Enumeration Members"))
    return lines(
        *head,
        *[F.concat(F.lit(f"{k}: "), v.cast("string")) for k, v in counts.items()],
        "---\n",
        F.concat(F.lit("# "), type_name, F.lit("\n")),
        F.concat(F.lit("**Assembly**: "), assembly, F.lit("  ")),
        F.concat(F.lit("**Namespace**: "), namespace),
        shown_if(some(category), "  \n**Category**: ", category),
        "\n",
        *section("## Description", description),
        *section("## Remarks", remarks),
        "## Members\n",
        *[shown_if(n > 0, f"- **{label}**: ", n.cast("string"), "\n") for n, label in named],
    )


def type_page(type_name: Column, assembly: Column, namespace: Column, category: Column, description: Column, remarks: Column, members: Column) -> Column:
    """The one-page form of a type; ``members`` is an array of (kind, name, description, signature) in order."""

    def listed(kind: str, title: str) -> Column:
        own = F.filter(members, lambda m: m["kind"] == kind)
        item = lambda m: lines(
            F.concat(F.lit("### "), m["name"], F.lit("\n")),
            shown_if(some(m["description"]), clean_text(m["description"]), "\n"),
            shown_if(some(m["signature"]), "**Signature**: `", m["signature"], "`\n"),
        )
        return F.when(F.size(own) > 0, F.concat(F.lit(f"## {title}\n\n"), F.array_join(F.transform(own, item), "\n")))

    return lines(
        F.concat(F.lit("# "), type_name, F.lit("\n")),
        F.concat(F.lit("**Assembly**: "), assembly, F.lit("  ")),
        F.concat(F.lit("**Namespace**: "), namespace, F.lit("\n")),
        shown_if(some(category), "**Category**: ", category, "\n"),
        shown_if(some(description), "## Description\n"),
        shown_if(some(description), clean_text(description), "\n"),
        shown_if(some(remarks), "## Remarks\n"),
        shown_if(some(remarks), clean_text(remarks), "\n"),
        listed("enum_member", "Enumeration Members"),
        listed("property", "Properties"),
        listed("method", "Methods"),
    )


def example_page(title: Column, url: Column, description: Column, code: Column, fence: Column) -> Column:
    return lines(
        F.when(some(title), F.concat(F.lit("# "), title, F.lit("\n"))).otherwise("# Code Example\n"),
        F.concat(F.lit("**Source**: `"), url, F.lit("`\n")),
        shown_if(some(description), "## Description\n"),
        shown_if(some(description), description, "\n"),
        shown_if(some(code), "## Code\n"),
        shown_if(some(code), "```", fence, "\n", code, "\n```\n"),
    )


def escaped(value: Column) -> Column:
    """Text as XML content."""
    out = value
    for character, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(character), F.lit(entity))
    return out


def member_summary(kind: Column, name: Column, summary: Column) -> Column:
    """The summary of a member, or the placeholder of its kind."""
    placeholder = F.when(kind == "property", F.concat(F.lit("Gets or sets "), name, F.lit("."))).when(kind == "method", F.concat(name, F.lit(" method."))).otherwise(name)
    return F.when(some(summary), summary).otherwise(placeholder)


#: What a text without brackets and ampersands may still not have in XML: a section's end, and characters that XML lacks.
_NOT_XML = r"\]\]>|[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]"


@cache
def _checker(each: bool) -> Callable[..., Column]:
    """A vectorised check of fragments by an incremental XML parser that knows namespaces; null where there is nothing to check."""

    def check(texts: pd.Series) -> pd.Series:
        from xml.parsers import expat  # here, as executors get this function by value

        def parses(text: str | None) -> bool | None:
            if text is None:
                return None
            parser = expat.ParserCreate(namespace_separator=" ")
            try:
                for piece, last in (("<r>", False), (text, False), ("</r>", True)):
                    parser.Parse(piece, last)
            except (expat.ExpatError, UnicodeEncodeError):
                return False
            return True

        return pd.Series([([parses(x) for x in t] if t is not None else None) if each else parses(t) for t in texts], dtype=object)

    return F.pandas_udf(check, "array<boolean>" if each else "boolean")


def _marked(value: Column) -> Column:
    """The text where only a parser can tell whether it is XML; null elsewhere, so that it isn't sent to one."""
    return F.when(value.rlike("[<&]"), value)


def well_formed(value: Column) -> Column:
    """Whether a text is an XML fragment, as a parser takes it: tags, attributes, prefixes, references, comments, sections."""
    return F.coalesce(_checker(False)(_marked(value)), ~value.rlike(_NOT_XML))


def well_formed_each(values: Column) -> Column:
    """``well_formed`` of each text of an array."""
    return F.zip_with(_checker(True)(F.transform(values, _marked)), values, lambda parsed, v: F.coalesce(parsed, ~v.rlike(_NOT_XML)))


def xml_content(value: Column, fits: Column | None = None) -> Column:
    """Text as the content of an element: fragments (``fits``) stay as they are, anything else is escaped whole."""
    return F.when(well_formed(value) if fits is None else fits, value).otherwise(escaped(value))


def xml_code(code: Column) -> Column:
    """A <code> element whose text stays as it is, in CDATA."""
    return F.concat(F.lit("<code>"), cdata(code), F.lit("</code>"))


def xml_example(content: Column) -> Column:
    """An <example> element: prose escaped, code blocks in CDATA; null for no content."""
    prose_parts, blocks = F.split(content, r"(?is)<code>.*?</code>"), F.regexp_extract_all(content, F.lit(r"(?is)<code>(.*?)</code>"), 1)
    merged = F.zip_with(prose_parts, blocks, lambda text, code: F.concat(escaped(text), F.when(F.coalesce(code, F.lit("")) != "", xml_code(code)).when(code == "", "<code/>").otherwise("")))
    return F.when(some(content), F.concat(F.lit("<example>"), F.array_join(merged, ""), F.lit("</example>")))


def _xml_section(tag: str, value: Column, around: str = "") -> Column:
    return F.when(some(value), F.concat(F.lit(f"<{tag}>{around}"), xml_content(value), F.lit(f"{around}</{tag}>"))).otherwise("")


def xml_type(doc_id: Column, description: Column, remarks: Column, examples: Column) -> Column:
    """The <member> element of a type; ``examples`` are the contents of its C# examples in order."""
    listed = F.array_join(F.array_compact(F.transform(examples, xml_example)), "")
    return F.concat(F.lit('<member name="'), escaped(doc_id), F.lit('">'), _xml_section("summary", description), _xml_section("remarks", remarks, "\n"), listed, F.lit("</member>"))


def xml_member(doc_id: Column, kind: Column, name: Column, summary: Column, params: Column, result: Column, remarks: Column, availability: Column | None = None) -> Column:
    """One <member> element: summary, params, value or returns, remarks, availability, in this order."""
    tag = F.when(kind == "property", "value").otherwise("returns")
    about = F.transform(params, lambda p: F.coalesce(p["description"], F.lit("")))
    inner = F.zip_with(about, well_formed_each(about), xml_content)
    listed = F.zip_with(params, inner, lambda p, x: F.concat(F.lit('<param name="'), escaped(p["name"]), F.lit('">'), x, F.lit("</param>")))
    available = F.lit("") if availability is None else F.when(some(availability), F.concat(F.lit("<availability>"), escaped(availability), F.lit("</availability>"))).otherwise("")
    text = F.when(some(summary), xml_content(summary)).otherwise(escaped(member_summary(kind, name, summary)))
    return F.concat(
        F.lit('<member name="'), escaped(doc_id), F.lit('"><summary>'), text, F.lit("</summary>"),
        F.array_join(listed, ""),
        F.when(some(result), F.concat(F.lit("<"), tag, F.lit(">"), xml_content(result), F.lit("</"), tag, F.lit(">"))).otherwise(""),
        _xml_section("remarks", remarks, "\n"),
        available,
        F.lit("</member>"),
    )


def xml_doc_head(assembly: Column) -> Column:
    """What stands before the <member> elements of an XML-doc file; each of them is a line, indented by four."""
    return F.concat(F.lit('<?xml version="1.0" ?>\n<doc>\n  <assembly>\n    <name>'), escaped(assembly), F.lit("</name>\n  </assembly>\n  <members>\n"))


XML_DOC_FOOT = "  </members>\n</doc>\n"


def index_entry(type_name: Column, is_enum: Column) -> Column:
    """A list item that links to the overview of a type."""
    return F.concat(F.lit("- ["), type_name, F.lit("](../"), F.when(is_enum, "enums").otherwise("types"), F.lit("/"), type_name, F.lit("/_overview.md)"))
