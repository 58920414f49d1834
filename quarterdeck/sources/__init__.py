"""Readers for delimited text, JSON documents, tables and landing folders."""

from quarterdeck.sources.delimited import (
    RESCUED,
    file_headers,
    read_by_header,
    read_delimited,
    read_delimited_set,
    read_with_rescue,
    write_delimited,
)
from quarterdeck.sources.documents import explode_records, read_documents
from quarterdeck.sources.tables import (
    file_ranges,
    files_touched,
    landing_inventory,
    qualified,
    read_as_of,
    read_table,
    snapshots,
)

__all__ = [
    "RESCUED",
    "explode_records",
    "file_headers",
    "file_ranges",
    "files_touched",
    "landing_inventory",
    "qualified",
    "read_as_of",
    "read_by_header",
    "read_delimited",
    "read_delimited_set",
    "read_documents",
    "read_table",
    "read_with_rescue",
    "snapshots",
    "write_delimited",
]
