"""Incremental runs: what was seen stays seen, by checkpoint."""
