"""Retail analytics as Spark jobs."""

from basketry.session import build_session
from basketry.sources.catalog import Catalog

__all__ = ["Catalog", "build_session"]
