"""Operators over DataFrames: checks, joins, splits, features, models, metrics, rankings."""
