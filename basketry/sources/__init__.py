"""Scans and sinks: Parquet (lake layers), CSV (extracts), JDBC (source database)."""

from basketry.sources.csv import read_csv, write_csv
from basketry.sources.drift import common_schema, common_type, read_drifted
from basketry.sources.jdbc import (
    INFORMATION_SCHEMA_KEYS,
    INFORMATION_SCHEMA_TABLES,
    Partitioning,
    balanced_ranges,
    discover_partitioning,
    ingest_all,
    jdbc_options,
    key_columns,
    list_tables,
    read_query,
    read_ranges,
    read_table,
    target_folder,
)
from basketry.sources.layout import write_clustered
from basketry.sources.parquet import load_gold, read_parquet, union_frames, write_parquet

__all__ = [
    "INFORMATION_SCHEMA_KEYS",
    "INFORMATION_SCHEMA_TABLES",
    "Partitioning",
    "balanced_ranges",
    "common_schema",
    "common_type",
    "discover_partitioning",
    "ingest_all",
    "jdbc_options",
    "key_columns",
    "list_tables",
    "load_gold",
    "read_csv",
    "read_drifted",
    "read_parquet",
    "read_query",
    "read_ranges",
    "read_table",
    "target_folder",
    "union_frames",
    "write_clustered",
    "write_csv",
    "write_parquet",
]
