"""Operators of a training-data pipeline: filters, joins, scoring, encoding, output."""
