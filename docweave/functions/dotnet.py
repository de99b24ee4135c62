"""Column expressions over .NET signatures and documentation ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.columns import let
from docweave.functions.text import utrim

#: Language aliases of the framework's types.
ALIASES = {
    "int": "Int32", "uint": "UInt32", "short": "Int16", "ushort": "UInt16", "long": "Int64", "ulong": "UInt64", "byte": "Byte", "sbyte": "SByte",
    "bool": "Boolean", "char": "Char", "float": "Single", "double": "Double", "decimal": "Decimal", "string": "String", "object": "Object", "void": "Void",
}


def _looked_up(name: Column, prefix: str) -> Column:
    pairs = F.create_map(*[F.lit(x) for alias, full in ALIASES.items() for x in (prefix + alias, "System." + full)])
    return F.coalesce(F.element_at(pairs, name), name)


def dotnet_type(name: Column) -> Column:
    """System.int and its like as the framework names them; others unchanged."""
    return _looked_up(name, "System.")


def clean_signature(signature: Column) -> Column:
    """White space collapsed, and the return type before the name dropped."""
    one_line = F.regexp_replace(utrim(signature), r"(?U)\s+", " ")
    return F.regexp_replace(one_line, r"^[\w.\[\]<>,\s]+?\s+(.+)$", "$1")


def param_type(parameter: Column) -> Column:
    """Type of one parameter: all but its name, aliases resolved, ``@`` where passed by reference."""
    trimmed = utrim(parameter)
    by_reference = trimmed.rlike("^(out|ref|in) ")

    def typed(tokens: Column) -> Column:
        kept = F.when(F.size(tokens) > 1, F.array_join(F.slice(tokens, 1, F.size(tokens) - 1), " ")).otherwise(F.get(tokens, F.lit(0)))
        return F.concat(dotnet_type(kept), F.when(by_reference, "@").otherwise(""))

    bare = utrim(F.when(by_reference, F.regexp_replace(trimmed, r"^(out|ref|in)\s+", "")).otherwise(trimmed))
    return F.when(bare != "", let(F.split(bare, r"\s+"), typed))


def signature_params(signature: Column) -> Column:
    """Parameter types of a signature, null without any: its first parentheses, split at commas outside <>."""
    inner = utrim(F.regexp_extract(F.coalesce(signature, F.lit("")), r"\((.*?)\)", 1))

    def joined(pieces: Column) -> Column:
        # A piece belongs to the one before while that has more < than >.
        start = F.array().cast("array<string>")
        depth = lambda s: F.length(F.regexp_replace(s, "[^<]", "")) - F.length(F.regexp_replace(s, "[^>]", ""))
        return F.aggregate(
            pieces,
            start,
            lambda out, piece: F.when(
                (F.size(out) > 0) & (depth(F.element_at(out, -1)) > 0),
                F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.concat(F.element_at(out, -1), F.lit(","), piece))),
            ).otherwise(F.concat(out, F.array(piece))),
        )

    types = F.filter(F.transform(joined(F.split(inner, ",")), param_type), lambda t: t.isNotNull())
    return F.when(inner != "", let(types, lambda t: F.when(F.size(t) > 0, t)))


def encoded_param_type(name: Column) -> Column:
    """A parameter type as ids write it: base, pointer, array, by-reference mark."""
    trimmed = utrim(name)
    by_reference = trimmed.rlike("^(ref|out|in) ")
    bare = F.when(by_reference, F.regexp_replace(trimmed, r"^(ref|out|in)\s+", "")).otherwise(trimmed)
    array = F.regexp_extract(bare, r"(\[[,\d:]*\])$", 1)
    scalar = F.regexp_replace(bare, r"\[[,\d:]*\]$", "")
    pointer = F.when(scalar.endswith("*"), "*").otherwise("")
    base = F.when(scalar.endswith("*"), utrim(F.regexp_replace(scalar, r"\*$", ""))).otherwise(scalar)
    return F.concat(_looked_up(base, ""), pointer, array, F.when(by_reference, "@").otherwise(""))


def doc_id(prefix: str, namespace: Column, type_name: Column, member: Column | None = None, params: Column | None = None) -> Column:
    """A documentation id: T, P, M, F or E, the dotted name, and parameter types in parentheses."""
    parts = [F.lit(prefix + ":"), namespace, F.lit("."), type_name]
    if member is not None:
        parts += [F.lit("."), member]
    if params is not None:
        listed = F.concat(F.lit("("), F.array_join(params, ","), F.lit(")"))
        parts.append(F.when(F.coalesce(F.size(params), F.lit(0)) > 0, listed).otherwise(""))
    return F.concat(*parts)
