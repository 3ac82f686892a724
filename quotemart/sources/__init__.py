"""Readers of landing files, table snapshots and source databases."""
