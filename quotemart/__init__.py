"""Spark jobs that turn company, market and daily-bar feeds into a star-schema warehouse."""
