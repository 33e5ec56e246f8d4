"""All registered queries."""

from __future__ import annotations

from docweave.plans import (  # noqa: F401  (they register their queries)
    catalog_profile, catalog_search, catalog_sync, catalog_tables, catalog_text,
)
from docweave.plans.registry import QUERIES

__all__ = ["QUERIES"]
