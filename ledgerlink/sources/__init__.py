"""Named sources, staging, stored tables and sinks."""
