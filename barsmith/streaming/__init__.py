"""Incremental (micro-batch) refresh of the daily fact."""
