"""Operators for training-data pipelines, each over any table with an id and a text column."""
