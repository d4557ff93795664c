"""Readers, the table catalogue and the Parquet sink."""

from basketry.sources.catalog import Catalog
from basketry.sources.delimited import path_exists, read_delimited, typed
from basketry.sources.sink import write_table

__all__ = ["Catalog", "path_exists", "read_delimited", "typed", "write_table"]
