"""Column expressions over documentation text: white space, references, code, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.columns import let

#: Fence tags by language name; any other language is plain text.
FENCE_TAGS = {"C#": "csharp", "VBA": "vba", "VB.NET": "vbnet", "C++": "cpp", "Python": "python"}
#: Fixed value: characters that file names can't have.
UNSAFE_NAME = r'[<>:"/\\|?*]'


def utrim(value: Column) -> Column:
    """White space of any script off both ends (``trim`` knows the plain space only)."""
    return F.regexp_replace(value, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def clean_text(value: Column) -> Column:
    """Text without CDATA marks and outer white space; null gives an empty string."""
    return utrim(F.replace(F.replace(F.coalesce(value, F.lit("")), F.lit("<![CDATA["), F.lit("")), F.lit("]]>"), F.lit("")))


def simplify_see(value: Column) -> Column:
    """Cross references as [[Text]]; self-closing ones show the last part of the name."""
    paired = F.regexp_replace(F.coalesce(value, F.lit("")), r'<see cref="[^"]+">([^<]+)</see>', "[[$1]]")
    return F.regexp_replace(paired, r'<see cref="(?:[^"]*\.)?([^".]*)"\s*/>', "[[$1]]")


def cdata(value: Column) -> Column:
    """``value`` as a CDATA section; an end mark inside it is divided between two sections."""
    return F.concat(F.lit("<![CDATA["), F.replace(value, F.lit("]]>"), F.lit("]]]]><![CDATA[>")), F.lit("]]>"))


#: A Markdown link: its words and its target.
MD_LINK = r"\[([^\]]+)\]\(([^)]+)\)"


def md_links(content: Column) -> Column:
    """(text, url) of the Markdown links in order."""
    texts, urls = (F.regexp_extract_all(content, F.lit(MD_LINK), k) for k in (1, 2))
    return F.zip_with(texts, urls, lambda t, u: F.struct(t.alias("text"), u.alias("url")))


def with_links(content: Column, targets: Column) -> Column:
    """``content`` with the targets of its links in order replaced; a null target leaves its link as it is."""
    between = F.split(content, MD_LINK)
    linked = F.zip_with(md_links(content), targets, lambda link, to: F.concat(F.lit("["), link["text"], F.lit("]("), F.coalesce(to, link["url"]), F.lit(")")))
    return F.array_join(F.zip_with(between, linked, lambda text, link: F.concat(text, F.coalesce(link, F.lit("")))), "")


def fence_tag(language: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in FENCE_TAGS.items() for x in pair])
    return F.coalesce(F.element_at(pairs, language), F.lit("text"))


def truncate_description(value: Column, length: int = 100) -> Column:
    return F.when(F.length(value) > length, F.concat(F.left(value, F.lit(length)), F.lit("..."))).otherwise(value)


def guide_file_name(value: Column, length: int = 200) -> Column:
    """File name of a guide page: unsafe characters replaced, dots and spaces off the ends, cut."""
    return F.left(F.regexp_replace(F.regexp_replace(value, UNSAFE_NAME, "_"), r"^[. ]+|[. ]+$", ""), F.lit(length))


def api_file_name(value: Column) -> Column:
    """File name of an API page: unsafe characters and spaces replaced."""
    return F.replace(F.regexp_replace(value, UNSAFE_NAME, "_"), F.lit(" "), F.lit("_"))


def category_dir_name(value: Column) -> Column:
    """Directory of a category: unsafe characters (the path separator too) replaced."""
    return F.regexp_replace(value, UNSAFE_NAME, "_")


def first_code(content: Column) -> Column:
    """The first code block, trimmed; empty where there is none."""
    return utrim(F.regexp_extract(F.coalesce(content, F.lit("")), r"(?is)<code>(.*?)</code>", 1))


def example_title(content: Column) -> Column:
    return utrim(F.get(F.split(utrim(F.coalesce(content, F.lit(""))), "\n"), F.lit(0)))


def example_description(content: Column) -> Column:
    """The trimmed lines after the first and before the first code block that aren't blank."""
    text = F.coalesce(content, F.lit(""))
    has_code = text.rlike(r"(?is)<code>.*?</code>")
    before = F.when(has_code, F.regexp_extract(text, r"(?is)^(.*?)<code>.*?</code>", 1)).otherwise(utrim(text))
    return let(F.split(before, "\n"), lambda lines: F.array_join(F.filter(F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), utrim), lambda x: x != ""), "\n"))


def example_segments(content: Column) -> Column:
    """Alternating (kind, text) parts of an example in order: text, code, text ...; blank texts are left out."""
    text = F.coalesce(content, F.lit(""))
    codes = F.regexp_extract_all(text, F.lit(r"(?is)<code>(.*?)</code>"), 1)
    texts = F.split(F.regexp_replace(text, r"(?is)<code>.*?</code>", "\x01"), "\x01")
    merged = F.flatten(
        F.zip_with(
            texts,
            codes,
            lambda t, c: F.array(F.struct(F.lit("text").alias("kind"), utrim(t).alias("text")), F.struct(F.lit("code").alias("kind"), c.alias("text"))),
        )
    )
    return F.filter(merged, lambda p: p["text"].isNotNull() & ((p["kind"] == "code") | (p["text"] != "")))
