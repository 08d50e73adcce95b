"""Whole jobs: features, training, scoring, loads and the query catalog."""
