"""Landed API responses, tabular dumps, event logs and the RAW tables they become."""

from pitchflow.sources.envelope import (
    ENDPOINTS,
    EndpointSpec,
    envelope_errors,
    merge_pages,
    page_errors,
    page_status,
    read_envelope,
    read_landed,
)
from pitchflow.sources.ledger import LedgerLoad
from pitchflow.sources.log import LOG_SCHEMA, append_log, read_log, write_log
from pitchflow.sources.raw import (
    SOURCES,
    SourceSpec,
    append_raw,
    export_json,
    raw_rows,
    read_raw,
    resolve_source,
    marked_freshness,
    source_freshness,
)
from pitchflow.sources.tabular import read_csv_payload, read_tabular_payload

__all__ = [
    "LedgerLoad",
    "ENDPOINTS",
    "LOG_SCHEMA",
    "SOURCES",
    "append_log",
    "EndpointSpec",
    "SourceSpec",
    "append_raw",
    "envelope_errors",
    "export_json",
    "merge_pages",
    "page_errors",
    "page_status",
    "raw_rows",
    "read_csv_payload",
    "read_envelope",
    "read_landed",
    "read_log",
    "read_raw",
    "read_tabular_payload",
    "resolve_source",
    "marked_freshness",
    "source_freshness",
    "write_log",
]
