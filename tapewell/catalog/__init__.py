"""Every registered query, by name."""

from __future__ import annotations

from tapewell.catalog.base import Query
from tapewell.catalog.feeds import FEED_QUERIES
from tapewell.catalog.lake import LAKE_QUERIES
from tapewell.catalog.marts import MART_QUERIES
from tapewell.catalog.quality import QUALITY_QUERIES

QUERIES: dict[str, Query] = {**MART_QUERIES, **QUALITY_QUERIES, **FEED_QUERIES, **LAKE_QUERIES}
