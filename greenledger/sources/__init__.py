"""Sources and sinks."""

from .raw import RAW_COLUMNS, SOURCE_FILES, ingest_raw, ingest_sources, source_counts

__all__ = ["RAW_COLUMNS", "SOURCE_FILES", "ingest_raw", "ingest_sources", "source_counts"]
