"""Registered queries (``QUERIES``) and their DuckDB oracle SQL (``ORACLE``)."""

from lakeward.catalog import analytics, core, reports, streams, upkeep  # noqa: F401
from lakeward.catalog.common import ORACLE, QUERIES  # noqa: F401
