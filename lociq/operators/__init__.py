"""lociq.operators subpackage."""
