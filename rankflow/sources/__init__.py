"""Table schemas, file scans and sinks, table mappings and the shared work folder."""
