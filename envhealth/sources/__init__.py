"""Scans. Every reader takes a path or a glob of a directory and returns a DataFrame."""

from .arrays import read_array_records, read_array_texts
from .footprint import footprint, require_input
from .landing import (
    landing_query,
    landing_report,
    read_csv_drop,
    read_envelopes,
    read_records,
    split_corrupt,
)
from .manifest import extend_manifest, packed, read_listed, read_manifest
from .tables import partition_path, read_documents, read_positioned, read_table

__all__ = [
    "footprint",
    "extend_manifest",
    "landing_query",
    "landing_report",
    "packed",
    "partition_path",
    "read_array_records",
    "read_array_texts",
    "read_csv_drop",
    "read_documents",
    "read_envelopes",
    "read_listed",
    "read_manifest",
    "read_positioned",
    "read_records",
    "read_table",
    "require_input",
    "split_corrupt",
]
