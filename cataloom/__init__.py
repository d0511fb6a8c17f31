"""Catalogue analytics on Spark: clean, normalise, refresh, search, rank, profile."""
