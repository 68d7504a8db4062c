"""lociq.sources subpackage."""
