"""The file ingest as an incremental stream."""
