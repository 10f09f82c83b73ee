"""Writers. Executors write in parallel; nothing is merged into one file."""

from .delivery import dead_letters, deliver, delivered, read_outcomes
from .documents import publish, published_count, write_bulk, write_documents
from .tables import audit, write_raw_json, write_table
from .versions import read_current, refresh, remove_old, versions

__all__ = [
    "audit",
    "dead_letters",
    "deliver",
    "delivered",
    "publish",
    "published_count",
    "read_current",
    "read_outcomes",
    "refresh",
    "remove_old",
    "versions",
    "write_bulk",
    "write_documents",
    "write_raw_json",
    "write_table",
]
