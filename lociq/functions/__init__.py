"""lociq.functions subpackage."""
