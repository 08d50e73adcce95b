"""Adapters from source tables, landing folders and stored tables."""
