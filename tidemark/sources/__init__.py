from tidemark.sources.catalog import (
    catalog_overview,
    compare_counts,
    ctas,
    register_views,
    schema_overview,
    with_cached_view,
)
from tidemark.sources.readers import (
    RESCUED as RESCUED_COLUMN,
)
from tidemark.sources.readers import (
    Tables,
    read_binary,
    read_csv,
    read_glob,
    read_json,
    read_rescued,
    read_table,
)
from tidemark.sources.writers import split_by_key, with_ingestion_ts, write_csv, write_table

__all__ = [
    "RESCUED_COLUMN",
    "Tables",
    "catalog_overview",
    "compare_counts",
    "ctas",
    "read_binary",
    "read_csv",
    "read_glob",
    "read_json",
    "read_rescued",
    "read_table",
    "register_views",
    "schema_overview",
    "split_by_key",
    "with_cached_view",
    "with_ingestion_ts",
    "write_csv",
    "write_table",
]
