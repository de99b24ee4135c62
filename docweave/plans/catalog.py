"""All queries of the engine, registered by importing the modules that define them."""

from docweave.plans import export, facts, files, pages, scalars
from docweave.plans.registry import ORACLES, QUERIES

flagship = pages.site_links

__all__ = ["ORACLES", "QUERIES", "export", "facts", "files", "flagship", "pages", "scalars"]
