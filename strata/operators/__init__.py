"""Reusable DataFrame operators: keep-first dedupe, ranking, merges."""
