"""Reusable table operators: deduplicate, merge, as-of read, incremental load, layout, retention, quality."""
