"""Measure specifications and the pipelines that run them."""
