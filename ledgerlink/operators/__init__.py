"""Relational operators: clean, deduplicate, reconcile, revenue, segment, mutate."""
