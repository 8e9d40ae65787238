"""Sessions, lineage cuts and the registry of named queries."""
