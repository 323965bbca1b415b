"""Operators for training-data pipelines: cleaning, extraction, filters, joins, models, shards."""
