"""Nested JSON of any depth as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators.storage import cut


def json_urls(documents: DataFrame, column: str = "json", children: str = "children", field: str = "url") -> DataFrame:
    """``field`` of every object reached through ``children``; one explode for each level of nesting."""
    level = documents.select(F.parse_json(column).alias("node"))
    found = None
    while True:
        value = F.try_variant_get("node", f"$.{field}", "string")
        here = level.select(value.alias(field)).where(F.coalesce(field, F.lit("")) != "")
        found = here if found is None else found.unionAll(here)
        level = cut(level.select(F.explode(F.try_variant_get("node", f"$.{children}", "array<variant>")).alias("node")))
        if level.isEmpty():
            return found
