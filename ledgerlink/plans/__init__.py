"""Whole runs: stage, clean, deduplicate, reconcile, derive, segment, export."""
