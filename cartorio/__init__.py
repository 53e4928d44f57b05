"""Spark jobs for public court and administrative records."""
