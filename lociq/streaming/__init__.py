"""lociq.streaming subpackage."""
